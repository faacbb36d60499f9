"""Helpers shared by the text operators: tables, stored intermediate results, and words of whole texts as arrays."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from martloom.session import scratch_path

# A task looks at so many bytes of text at a time; one longer text is a block of its own.
BLOCK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the folder all executors share and read back: cuts the lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    # Small row groups: a writer holds one in memory.
    df.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_with(df: DataFrame, name: str, *measures: Column) -> tuple[DataFrame, dict]:
    """``stored``, and sums over the rows that are taken while they are written; ``rows`` is always among them."""
    seen = Observation()
    kept = stored(df.observe(seen, F.count(F.lit(1)).alias("rows"), *measures), name)
    return kept, seen.get


ROW_GROUP_BYTES = 16 << 20
# Bytes that Spark hands to a Python worker at a time, so that neither side holds a large batch of long texts.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20
_UNSET = "67108864b"


def map_batches(df: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` with batches of bounded size; a size that the session sets itself stays."""
    conf = df.sparkSession.conf
    if conf.get(BATCH_SETTING, _UNSET) == _UNSET:
        conf.set(BATCH_SETTING, str(BATCH_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The default pool of a worker keeps freed memory.
        pa.set_memory_pool(pa.system_memory_pool())
        return function(batches)

    return df.mapInArrow(run, schema)


def text_blocks(batch: pa.RecordBatch, column: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of up to ``limit`` bytes of text, at least one row each."""
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    low = 0
    while low < len(ends):
        base = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield batch.slice(low, high - low)
        low = high


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and the offsets of its rows; NULL counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


# Words of letters, digits and everything beyond ASCII, with A-Z lower-cased.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True
# Words between white space.
DARK = np.ones(256, bool)
DARK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

_STEP = 0x9E3779B97F4A7C15
_STEP_INVERSE = pow(_STEP, -1, 1 << 64)
_BYTE_CODES = np.random.default_rng(20).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values over all bits."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    if n:
        steps[0] = 1
    return np.multiply.accumulate(steps)


_POWER_TABLES: dict[str, np.ndarray] = {}


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWER_TABLES.get("up", ())) < n:
        size = max(n, BLOCK_BYTES + 1)
        _POWER_TABLES.update(up=_powers(_STEP, size), down=_powers(_STEP_INVERSE, size))
    return _POWER_TABLES["up"], _POWER_TABLES["down"]


@dataclass
class Words:
    """Words of a block of texts, in order: byte range in ``data``, row, and for each row its first word."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    first: np.ndarray  # rows + 1 entries

    @property
    def rows(self) -> int:
        return len(self.first) - 1

    def hashes(self) -> np.ndarray:
        """A 64-bit value for each word, equal for equal words in every block and process."""
        up, down = power_tables(len(self.data) + 1)
        sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(_BYTE_CODES[self.data] * up[: len(self.data)], out=sums[1:])
        return mix((sums[self.end] - sums[self.start]) * down[self.start])


def scan_words(column: pa.Array, is_word: np.ndarray = ALNUM, lower: bool = True) -> Words:
    data, offsets = text_bytes(column)
    if lower:
        data = LOWER[data]
    inside = is_word[data]
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    edges = offsets[:-1][np.diff(offsets) > 0]
    begins[edges] = inside[edges]
    lasts = offsets[1:][np.diff(offsets) > 0] - 1
    stops[lasts] = inside[lasts]
    start, end = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    first = np.searchsorted(start, offsets)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(data, start, end, row, first)


def runs_of_words(hashes: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words that lie in one row, and the index of each run's first word."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total = total * np.uint64(_STEP) + hashes[j : j + n]
    at = np.flatnonzero(row[:n] == row[k - 1 :])
    return mix(total[at]), at


def packed(docs: DataFrame, keep: tuple[str, ...] | None, **columns: str) -> tuple[DataFrame, str]:
    """The columns ``keep`` (or all) as one struct ``row``, beside the named columns, and the type of ``row``.

    Names of the given columns cannot clash with an operator's own that way.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in keep or docs.columns]).alias("row")
    df = docs.select(row, *[F.col(f"`{given}`").alias(name) for name, given in columns.items()])
    return df, df.schema["row"].dataType.simpleString()


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once; inside a lambda, an outer expression would be computed for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
