"""Latest row per key (W2, T2) and position inside a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """Keep, for each key, the row with the greatest ``newest`` columns, compared left to right.

    NULL is the smallest value, so a row without a time never wins over one that has it. This is an aggregate with
    map-side combine, not a window: a key that holds a third of all rows is reduced to one row per input partition
    before anything is shuffled.
    """
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*newest)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, "_best.*").select(*df.columns)


def _piece(value: Column, cuts: Sequence[int], first: int = 0) -> Column:
    """How many of the ascending cuts lie below the value, by halving."""
    if not cuts:
        return F.lit(first)
    middle = len(cuts) // 2
    return F.when(value > cuts[middle], _piece(value, cuts[middle + 1 :], first + middle + 1)).otherwise(_piece(value, cuts[:middle], first))


# Numbers that groups are hashed to, and how many rows of one number a single task may sort.
_NUMBERS, MOST_IN_A_WINDOW = 1 << 16, 1 << 18


def position_in_group(
    df: DataFrame, group: Sequence[str], day: str, tie: str, name: str, pieces: int | None = None, most: int = MOST_IN_A_WINDOW
) -> DataFrame:
    """1-based position of each row in its group by (``day`` ascending with NULL last, ``tie``), a unique number.

    Rows are counted by a hash of their group, which combines on the map side to at most _NUMBERS rows. Groups whose hash has
    up to ``most`` rows are numbered by a window. The others, which alone can be large, are cut into pieces; with ``pieces``
    given all groups are.
    """
    if pieces:
        return _position_by_pieces(df, group, day, tie, name, pieces)
    number = F.pmod(F.xxhash64(*group), F.lit(_NUMBERS))
    # At most one number for each ``most`` rows.
    crowded = [r["n"] for r in df.groupBy(number.alias("n")).count().filter(F.col("count") > most).select("n").collect()]
    window = Window.partitionBy(*group).orderBy(F.col(day).asc_nulls_last(), F.col(tie))
    if not crowded:
        return df.withColumn(name, F.row_number().over(window))
    small, large = df.filter(~number.isin(crowded)), df.filter(number.isin(crowded))
    return small.withColumn(name, F.row_number().over(window)).unionByName(_position_by_pieces(large, group, day, tie, name))


def _position_by_pieces(df: DataFrame, group: Sequence[str], day: str, tie: str, name: str, pieces: int | None = None) -> DataFrame:
    """Rows are numbered inside (group, day, piece) and shifted by the group's rows before that. Pieces are ranges of ``tie``
    between sampled quantiles, so a day of any number of rows falls into pieces of about equal size whatever the ids look
    like. The shift is a prefix sum in two levels: over the pieces of a day, and over the days of a group. So no task holds
    more than a piece of rows, a day's pieces or a group's days, however large the group is. Keys are structs because structs
    compare NULL fields as equal: rows with a NULL group form one group, as in a window.
    """
    pieces = pieces or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / pieces for i in range(1, pieces)]
    # At most one number per piece.
    cuts = sorted(set(df.agg(F.percentile_approx(tie, shares)).first()[0] or ())) if shares else []
    df = df.withColumn("_day", F.struct(*group, day)).withColumn("_piece", _piece(F.col(tie), cuts))
    per_piece = df.groupBy("_day", "_piece").agg(F.count(F.lit(1)).alias("_rows"))
    per_day = per_piece.groupBy("_day").agg(F.sum("_rows").alias("_rows"))
    days = (
        Window.partitionBy(*[F.col(f"_day.{c}") for c in group]).orderBy(F.col(f"_day.{day}").asc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = Window.partitionBy("_day").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    day_shift = per_day.select("_day", F.coalesce(F.sum("_rows").over(days), F.lit(0)).alias("_days"))
    shift = (
        per_piece.select("_day", "_piece", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_pieces"))
        .join(day_shift, "_day").select("_day", "_piece", (F.col("_pieces") + F.col("_days")).alias("_shift"))
    )
    within = Window.partitionBy("_day", "_piece").orderBy(F.col(tie))
    return (
        df.join(shift, ["_day", "_piece"])
        .withColumn(name, (F.row_number().over(within) + F.col("_shift")).cast("int"))
        .drop("_day", "_piece", "_shift")
    )
