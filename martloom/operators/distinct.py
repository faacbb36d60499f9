"""Distinct counts without an exchange of every row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from martloom.session import cut_lineage

# Places on which the ids of a group are marked; neighbouring ids have different ones.
_WORDS, _BITS = 4, 64


def _marks(column: str) -> list[Column]:
    place = F.pmod(F.col(column).cast("bigint"), F.lit(_WORDS * _BITS))
    bit = F.expr(f"shiftleft(1L, CAST(pmod(CAST(`{column}` AS bigint), {_BITS}) AS int))")
    return [F.bit_or(F.when(F.floor(place / _BITS) == w, bit)).alias(f"_word{w}") for w in range(_WORDS)]


def sums_with_distinct(df: DataFrame, keys: Sequence[str], id_column: str, name: str, *sums: Column, ids: DataFrame | None = None) -> DataFrame:
    """``sums`` per key, and under ``name`` the number of distinct whole numbers in ``id_column`` (NULL does not count).

    Next to the sums, each key marks its ids on places that its rows' ids have in small bit words, which combine on the
    map side like any sum. A key with as many marks as ids has no id twice, since equal ids share a place: its plain count
    is exact. Where a key's ids lie closer together than there are places, different ids have different places and the marks are
    the count, whatever repeats. Only the other keys are stored and counted again, if there are any, by an exchange of
    just their distinct ids. A plain distinct count exchanges every (key, id). ``ids`` may give the keys and ids of ``df`` in a
    cheaper way, such as the table from before its lookups.
    """
    number = F.col(id_column).cast("bigint")
    ends = [F.min(number).alias("_low"), F.max(number).alias("_high")]
    marked = df.groupBy(*keys).agg(*sums, *_marks(id_column), F.count(id_column).alias(name), *ends)
    marks = sum((F.bit_count(F.coalesce(F.col(f"_word{w}"), F.lit(0).cast("bigint"))) for w in range(_WORDS)), F.lit(0)).cast("bigint")
    near = F.coalesce(F.try_subtract("_high", "_low") < _WORDS * _BITS, F.lit(False))
    words = [f"_word{w}" for w in range(_WORDS)]
    judged = marked.withColumn("_unsure", ~near & (marks < F.col(name))).withColumn(name, F.when(near, marks).otherwise(F.col(name)))
    judged = judged.drop(*words, "_low", "_high")
    unsure = cut_lineage(judged.filter("_unsure").select(*keys))
    if unsure.isEmpty():
        # Known before the ids are read, so they are not.
        unsure = F.broadcast(unsure)
    ids = (df if ids is None else ids).select(*keys, id_column)
    met = [ids[k].eqNullSafe(unsure[k]) for k in keys]
    again = ids.join(unsure, met, "left_semi").distinct().groupBy(*keys).agg(F.count(id_column).alias("_exact"))
    again = again.select(*[F.col(k).alias(f"_again_{k}") for k in keys], "_exact")
    same = [F.col(k).eqNullSafe(F.col(f"_again_{k}")) for k in keys]
    return judged.join(again, [F.col("_unsure"), *same], "left").withColumn(name, F.coalesce("_exact", name)).drop(
        "_unsure", "_exact", *[f"_again_{k}" for k in keys]
    )
