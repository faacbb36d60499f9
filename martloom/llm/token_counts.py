"""Token counts without token ids.

1. One pass cuts every text into pre-tokens and sums how often each distinct one occurs, per task and then over all tasks.
2. The pieces of each distinct pre-token are counted once; the result is a stored table (pre-token, occurrences, pieces).
3. A second pass has the frequencies of the pre-tokens of each text and joins them to the table. The FREQUENT most frequent
   rows of the table are on every executor, and almost all text consists of these: they are joined and summed where the text
   is. What a text has beside them leaves as (text, pre-token, frequency), once for all copies of a text, and is joined to
   the whole table by a shuffle; the sums come back to their texts. So the join covers every distinct pre-token, however
   many there are, and moves only the rare ones.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import map_batches, packed, stored, text_blocks
from martloom.llm.pretokens import Pieces, plain_rows

LIMIT = 2048
# Rows of the table that every executor holds, and the longest pre-token among them.
FREQUENT, LONGEST = 1 << 17, 64
# Distinct pre-tokens that a task sums up at a time.
_HELD = 1 << 18


def _cuts(column: pa.Array, pieces: Pieces) -> Iterator[tuple[int, str, list[str] | None]]:
    """Each text with its pre-tokens; None where the library has to encode the whole text."""
    for i, (text, plain) in enumerate(zip(column.to_pylist(), plain_rows(column), strict=True)):
        yield i, text, pieces.cut(text, plain) if text else []


def _distinct(tokenizer):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, held = Pieces(tokenizer.value), Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["pretoken", "n"])

        for batch in batches:
            for block in text_blocks(batch, "text"):
                for _, _, cut in _cuts(block.column("text"), pieces):
                    held.update(cut or ())
                    if len(held) >= _HELD:
                        yield out()
                        held.clear()
        if held:
            yield out()

    return run


def _sizes(tokenizer):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(tokenizer.value)
        for batch in batches:
            sizes = [pieces.size(t) for t in batch.column("pretoken").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("pretoken"), batch.column("n"), pa.array(sizes, pa.int64())], ["pretoken", "n", "pieces"])

    return run


_RARE = pa.list_(pa.struct([("pretoken", pa.string()), ("n", pa.int64())]))


def _joined(tokenizer, frequent):
    """Per text the sum over its frequent pre-tokens, and the frequencies of all others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, table = Pieces(tokenizer.value), frequent.value
        for batch in batches:
            for block in text_blocks(batch, "text"):
                known, rare = [], []
                for _, text, cut in _cuts(block.column("text"), pieces):
                    total, others = (len(pieces.whole(text)), []) if cut is None else (0, [])
                    for pretoken, n in Counter(cut or ()).items():
                        size = table.get(pretoken)
                        if size is None:
                            others.append({"pretoken": pretoken, "n": n})
                        else:
                            total += n * size
                    known.append(total)
                    rare.append(others)
                yield pa.RecordBatch.from_arrays([block.column("row"), pa.array(known, pa.int64()), pa.array(rare, _RARE)], ["row", "known", "rare"])

    return run


def pretoken_table(docs: DataFrame, tokenizer, text: str = "text") -> DataFrame:
    """(pretoken, n, pieces): every distinct pre-token, its occurrences in all texts, and the number of its pieces."""
    counts = map_batches(docs.select(F.col(text).alias("text")), _distinct(tokenizer), "pretoken string, n bigint")
    counts = counts.groupBy("pretoken").agg(F.sum("n").alias("n"))
    return stored(map_batches(counts, _sizes(tokenizer), "pretoken string, n bigint, pieces bigint"), "pretokens")


def count_tokens(
    docs: DataFrame, tokenizer_path: str, text: str = "text", limit: int = LIMIT, keep: tuple[str, ...] | None = None, frequent: int = FREQUENT
) -> DataFrame:
    """``row`` (the columns ``keep``, or all, as a struct), ``n_bytes``, ``n_tokens`` and ``over_limit``.

    The count is what the library gives without begin, end or added special tokens; special strings inside a text are
    special tokens, and such texts are encoded by the library. NULL counts as empty: no bytes, no tokens. Repeated rows get
    equal counts. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as file:
        tokenizer = spark.sparkContext.broadcast(file.read())
    given, kind = packed(docs, keep, text=text)
    given = given.select("row", F.coalesce("text", F.lit("")).alias("text"))
    table = pretoken_table(given, tokenizer)
    most = table.where(F.length("pretoken") <= LONGEST).orderBy(F.desc("n"), "pretoken").limit(frequent).select("pretoken", "pieces").collect()
    shared = spark.sparkContext.broadcast({r["pretoken"]: r["pieces"] for r in most})
    # Two hashes name a text; copies share their sums.
    name = F.struct(F.xxhash64("text").alias("a"), F.xxhash64(F.lit("text"), "text").alias("b"))
    whole = F.struct("row", name.alias("name"), F.octet_length("text").cast("bigint").alias("n_bytes"))
    schema = f"row struct<row: {kind}, name: struct<a: bigint, b: bigint>, n_bytes: bigint>, known bigint, rare array<struct<pretoken: string, n: bigint>>"
    counted = stored(map_batches(given.select(whole.alias("row"), "text"), _joined(tokenizer, shared), schema).select("row.*", "known", "rare"), "counted")
    rare = counted.select(F.col("name.a").alias("a"), F.col("name.b").alias("b"), F.explode("rare").alias("r")).select("a", "b", "r.pretoken", "r.n")
    rare = rare.groupBy("a", "b", "pretoken").agg(F.max("n").alias("n"))
    sums = rare.join(table.select("pretoken", "pieces"), "pretoken").groupBy("a", "b").agg(F.sum(F.col("n") * F.col("pieces")).alias("others"))
    met = counted.join(sums, (F.col("name.a") == F.col("a")) & (F.col("name.b") == F.col("b")), "left")
    total = F.col("known") + F.coalesce("others", F.lit(0))
    return met.select("row", "n_bytes", total.alias("n_tokens"), (total > limit).alias("over_limit"))
