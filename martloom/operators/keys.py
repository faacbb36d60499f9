"""Surrogate keys (K5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from martloom.session import cut_lineage

# monotonically_increasing_id() puts the partition number above these bits and the row number below.
_ROW_BITS = 33


def dense_key(df: DataFrame, name: str, order_by: Sequence[str]) -> DataFrame:
    """Number rows 1..n in the order of ``order_by`` without sorting everything in one task.

    The rows are range-partitioned and sorted, numbered inside each partition, and written once to the shared
    checkpoint folder. The offsets added to them come from one count per partition, so the side that is broadcast has
    one row per partition whatever the table's size. Because the numbers are read back from storage, a lost executor
    cannot change them. ``order_by`` should be a unique key; then the result does not depend on the input's layout.
    """
    position = cut_lineage(
        df.repartitionByRange(*[F.col(c).asc_nulls_last() for c in order_by])
        .sortWithinPartitions(*[F.col(c).asc_nulls_last() for c in order_by])
        .withColumn("_pos", F.monotonically_increasing_id())
    ).withColumn("_part", F.shiftright("_pos", _ROW_BITS))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        position.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    row = F.col("_pos").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        position.join(F.broadcast(offsets), "_part")
        .withColumn(name, (F.col("_offset") + row + 1).cast("bigint"))
        .drop("_pos", "_part", "_offset")
    )


def stable_key(
    df: DataFrame, name: str, natural: Sequence[str], known: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """``df`` with a key per natural key that never changes, and the members that got a new one.

    ``known`` has the natural keys and numbers handed out so far, those of deleted members included; they keep theirs. New
    members are numbered from the highest one on, in the order of their natural keys. Only natural keys are sorted and
    numbered. NULL is a value of a natural key like any other.
    """
    members = df.select(*natural).distinct()
    if known is None:
        fresh, highest = dense_key(members, name, natural), 0
    else:
        known = known.select(*natural, name)
        highest = known.agg(F.max(name)).first()[0] or 0
        fresh = dense_key(members.join(known, _same(members, known, natural), "left_anti"), name, natural)
    fresh = fresh.select(*natural, (F.col(name) + highest).alias(name))
    every = fresh if known is None else known.unionByName(fresh)
    numbered = every.select(*[F.col(c).alias(f"_key_{c}") for c in natural], name)
    same = [F.col(c).eqNullSafe(F.col(f"_key_{c}")) for c in natural]
    return df.join(numbered, same).drop(*[f"_key_{c}" for c in natural]), fresh


def _same(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> list:
    return [left[c].eqNullSafe(right[c]) for c in columns]


def unique_key(df: DataFrame, name: str) -> DataFrame:
    """A unique, unordered number per row, assigned while the rows are written: no shuffle, gaps allowed.

    Meant for a fact's own key, which no other table refers to. Must stay the last step before the write: nothing may
    be shuffled after it, or a repeated task could hand out a number twice.
    """
    return df.withColumn(name, F.monotonically_increasing_id() + 1)


def clustered(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Order rows across and within files, so that a scan filtered on the first column skips whole files.

    The further columns split the rows of a value that many rows share.
    """
    return df.repartitionByRange(*columns).sortWithinPartitions(*columns)
