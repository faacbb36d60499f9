"""Write modes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from martloom import schemas
from martloom.sinks.versions import Accept, VersionedTable


# How many tasks share the rows of a month.
FILES_A_MONTH = 8


def with_audit(df: DataFrame, at: datetime | None = None) -> DataFrame:
    """K7: load and update time, the same for every row of a run."""
    now = F.current_timestamp() if at is None else F.lit(at)
    return df.withColumn("LoadDateTime", now).withColumn("UpdatedDateTime", now)


def write_full(df: DataFrame, path: str, *observed, accept: Accept | None = None) -> int:
    """K1: replace the table; returns the number of rows written.

    Readers see the old table until all rows are stored and ``accept`` has let them pass. What loads that ended early have
    left, and versions that nobody reads any more, are removed first. A load may read the table that it replaces.
    """
    table = VersionedTable(df.sparkSession, path)
    table.sweep()
    return table.replace(df, *observed, accept=accept)


def replace_run(df: DataFrame, path: str, run: Mapping[str, object]) -> int:
    """Store the rows of one run, named by the columns and values ``run``; the same run again replaces them, also by nothing."""
    table = VersionedTable(df.sparkSession, path)
    table.sweep()
    return table.replace_parts(df, list(run), [tuple(run.values())])


def append(df: DataFrame, path: str) -> int:
    """Add rows."""
    return VersionedTable(df.sparkSession, path).add(df)


def write_period(
    df: DataFrame, path: str, start: date, end: date, tenant_ids: Sequence[int], *observed, accept: Accept | None = None
) -> int:
    """K2: replace one period of the given tenants and leave everything else; running it again changes nothing.

    A tenant without rows has none for the period afterwards.
    """
    table = VersionedTable(df.sparkSession, path)
    table.sweep()
    return table.replace_parts(df, schemas.PERIOD_COLUMNS, [(start, end, t) for t in tenant_ids], *observed, accept=accept)


def months_between(first: date, last: date) -> list[date]:
    """First days of all months that the window touches; none for an inverted window."""
    out, at = [], date(first.year, first.month, 1)
    while at <= last and first <= last:
        out.append(at)
        at = date(at.year + at.month // 12, at.month % 12 + 1, 1)
    return out


def write_months(
    df: DataFrame, path: str, day: str, first: date | None, last: date | None, *observed, accept: Accept | None = None,
    spread: str, months: Sequence[date] | None = None, laid_out: bool = False,
) -> int:
    """K1 for a table kept by month of ``day``: replace the whole window, or with ``months`` only those.

    Rows are dealt by month and a few ranges of ``spread``, so that a month is a few files; ``laid_out`` rows are in order of
    the day already. A load that replaces the window drops all months outside it.
    """
    table = VersionedTable(df.sparkSession, path)
    table.sweep()
    whole = months is None
    named = months_between(first, last) if whole else list(months)
    rows = df.withColumn("PostedMonth", F.trunc(F.col(day), "month"))
    if not laid_out:
        rows = rows.repartition("PostedMonth", F.pmod(F.xxhash64(spread), F.lit(FILES_A_MONTH)))
    if not whole:
        return table.replace_parts(rows, ["PostedMonth"], [(m,) for m in named], *observed, accept=accept)
    parts, seen = table.stage(rows, *observed, by=["PostedMonth"], parts=[(m,) for m in named])
    if accept:
        accept(seen, table.rows_of(parts, df))
    table.publish(parts)
    return seen["rows"]


def missing_rows(rows: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """K4: the rows whose key the target does not have."""
    return rows.join(target.select(*keys), list(keys), "left_anti")


def insert_missing(rows: DataFrame, target: DataFrame, path: str, keys: Sequence[str]) -> int:
    """K4: append only rows with new keys."""
    return append(missing_rows(rows, target, keys), path)


def stamp_run(df: DataFrame, version: str, run_date: date, description: str) -> DataFrame:
    """Put the run's version, date and description in front of a report's columns."""
    return df.select(
        F.lit(version).alias("RUN_VERSION"),
        F.lit(run_date).cast("date").alias("RUN_DATE"),
        F.lit(description).alias("RUN_DESCRIPTION"),
        *[F.col(f"`{c}`") for c in df.columns],
    )


def empty(spark: SparkSession, table: str) -> DataFrame:
    """A mart table without rows."""
    return spark.createDataFrame([], schemas.ddl(schemas.MART[table]))
