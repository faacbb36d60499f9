"""Distinct sorted lists as text (A12), several at once and together with sums."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

# Piece of a list's text that is built apart from the others: whole numbers by range, texts by leading characters.
# Either way a piece holds neighbours, so pieces in order give the whole list in order.
ID_CHUNK = 1 << 16
TEXT_CHUNK = 8


@dataclass(frozen=True)
class Listed:
    """A list of ``value``s in ascending order: whole numbers by size, anything else as text."""

    value: Column
    numeric: bool
    chunk: int | None = None

    def item(self, name: str) -> Column:
        number = self.value.cast("bigint") if self.numeric else F.lit(None).cast("bigint")
        text = F.lit(None).cast("string") if self.numeric else self.value.cast("string")
        width = self.chunk or (ID_CHUNK if self.numeric else TEXT_CHUNK)
        return F.struct(
            F.lit(name).alias("name"),
            F.floor(number / F.lit(width)).alias("number_chunk"),
            F.substring(text, 1, width).alias("text_chunk"),
            number.alias("number"),
            text.alias("text"),
        )


def listagg_distinct(
    df: DataFrame,
    keys: Sequence[str],
    lists: Mapping[str, Listed],
    separator: str = ", ",
    where: Column | None = None,
    sums: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per key with a text per entry of ``lists`` and a sum per entry of ``sums``, in one pass over ``df``.

    Only rows that satisfy ``where`` are listed (all rows are summed); a key without such a row gets NULL, a key whose
    listed values are all NULL an empty text. Duplicates are removed and values sorted per (key, piece); only finished
    pieces meet in the key's single row, so the work for a key with very many rows is spread. The text itself is the
    feature and is kept whole.
    """
    sums = dict(sums or {})
    keep = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    first = next(iter(lists))
    exploded = df.select(
        *keys,
        keep.alias("_keep"),
        *[value.alias(f"_sum_{alias}") for alias, value in sums.items()],
        F.explode(F.array(*[listed.item(name) for name, listed in lists.items()])).alias("_item"),
    ).select(
        *keys,
        "_keep",
        F.col("_item.name").alias("_name"),
        # Rows that are only summed share one piece.
        F.when(F.col("_keep"), F.struct("_item.number_chunk", "_item.text_chunk")).alias("_piece"),
        F.when(
            F.col("_keep"), F.col("_item.number").isNotNull() | F.col("_item.text").isNotNull()
        ).alias("_filled"),
        F.struct("_item.number", "_item.text").alias("_value"),
        *[F.when(F.col("_item.name") == first, F.col(f"_sum_{alias}")).alias(f"_sum_{alias}") for alias in sums],
    )
    pieces = exploded.groupBy(*keys, "_name", "_piece").agg(
        F.array_sort(F.collect_set(F.when(F.col("_filled"), F.col("_value")))).alias("_sorted"),
        F.bool_or("_keep").alias("_keep"),
        *[F.sum(f"_sum_{alias}").alias(f"_sum_{alias}") for alias in sums],
    ).withColumn(
        "_text",
        F.array_join(
            F.transform("_sorted", lambda v: F.coalesce(v["text"], v["number"].cast("string"))), separator
        ),
    )

    def joined(name: str) -> Column:
        mine = (F.col("_name") == name) & F.col("_keep")
        texts = F.array_sort(F.collect_list(F.when(mine & (F.size("_sorted") > 0), F.struct("_piece", "_text"))))
        text = F.array_join(F.transform(texts, lambda p: p["_text"]), separator)
        return F.when(F.bool_or(mine), text).alias(name)

    return pieces.groupBy(*keys).agg(
        *[joined(name) for name in lists], *[F.sum(f"_sum_{alias}").alias(alias) for alias in sums]
    )
