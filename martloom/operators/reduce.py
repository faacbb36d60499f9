"""Leave out early what an exact join would drop later."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

# Up to so many keys are broadcast, one number each: some sixty bytes a key where they are looked up, 120 MB in all.
MOST_KEYS = 1 << 21


def only_with(df: DataFrame, keys: DataFrame, on: Sequence[str], most: int = MOST_KEYS) -> DataFrame:
    """The rows of ``df`` whose ``on`` may be among ``keys``, if the keys are counted to be few; otherwise ``df`` as it is.

    Meant below a sum or join whose result is joined to the keys anyway, so all forms lead to the same rows: a key is broadcast
    as a single hash, and rows that share one by chance, or are NULL like a key, stay. With more keys than that, sums that combine
    on the map side are the better first step. The keys are read twice; they should be stored.
    """
    shape = {c: df.schema[c].dataType for c in on}
    wanted = keys.select(F.xxhash64(*[F.col(c).try_cast(kind) for c, kind in shape.items()]).alias("_wanted")).distinct()
    if wanted.count() > most:
        return df
    return df.join(F.broadcast(wanted), F.xxhash64(*[df[c] for c in on]) == F.col("_wanted"), "left_semi")
