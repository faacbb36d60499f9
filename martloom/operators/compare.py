"""Run-over-run comparison of metrics (G3, G4, G7) and of whole reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from martloom.functions.money import difference_percent
from martloom.operators.latest import latest_per_key


def latest_metrics(history: DataFrame) -> DataFrame:
    """The most recent stored value of every metric, for all metrics in one pass."""
    return latest_per_key(
        history.select("METRIC_NAME", "RUN_VERSION", "METRIC_VALUE", "METRIC_COUNT", "RUN_DATE", "LOADDATETIME"),
        ["METRIC_NAME"], ["RUN_DATE", "LOADDATETIME", "RUN_VERSION"],
    )


def compare_metrics(current: DataFrame, history: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Add previous version and value, difference, percent, and whether the change exceeds the tolerance.

    ``current`` has ``name, category, value, count``. Without a previous run everything is NULL and the flag false; a
    previous value of 0 gives a difference but no percent.
    """
    previous = latest_metrics(history).select(
        F.col("METRIC_NAME").alias("name"),
        F.col("RUN_VERSION").alias("previous_version"),
        F.coalesce("METRIC_VALUE", F.lit(0)).alias("previous_value"),
    )
    percent = difference_percent(F.col("value"), F.col("previous_value"))
    return (
        current.join(previous, "name", "left")
        .withColumn("difference", F.col("value") - F.col("previous_value"))
        .withColumn("difference_pct", percent)
        .withColumn("out_of_tolerance", F.coalesce(F.abs("difference_pct") > tolerance * 100, F.lit(False)))
    )


def diff_rows(before: DataFrame, after: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """(keys, change, changed_columns) for rows that were added, removed or changed.

    Rows are matched on ``keys`` with NULL equal to NULL; ``keys`` must be unique on both sides (see the unique-key
    gate). Values are compared NULL-safely.
    """
    columns = list(columns or [c for c in before.columns if c not in keys])
    quoted = [F.col(f"`{k}`") for k in keys]

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(
            F.struct(*quoted).alias("_key"), F.struct(*[F.col(f"`{c}`") for c in columns]).alias(name)
        )

    both = side(before, "_old").join(side(after, "_new"), "_key", "full_outer")
    changed = F.filter(
        F.array(
            *[
                F.when(~F.col("_old").getField(c).eqNullSafe(F.col("_new").getField(c)), F.lit(c))
                for c in columns
            ]
        ),
        lambda item: item.isNotNull(),
    )
    kind = (
        F.when(F.col("_old").isNull(), "added")
        .when(F.col("_new").isNull(), "removed")
        .when(F.size("_changed") > 0, "changed")
    )
    return (
        both.withColumn("_changed", changed)
        .withColumn("change", kind)
        .filter("change IS NOT NULL")
        .select(
            "_key.*",
            "change",
            F.when(F.col("change") == "changed", F.array_join("_changed", ",")).alias("changed_columns"),
        )
    )
