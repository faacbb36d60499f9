"""Line deduplication over all documents, by built-in functions only.

Each line's key is hashed to 128 bits. The hashes are range-partitioned, together with a salt of the document, and sorted by
hash, salt, document and position; a pass over that order finds where a document begins to hold a hash. One row per hash
sums this up: in how many documents it occurs and which is the last. A hash that a third of all lines share is spread over
SALTS ranges and reduced there before it meets in one row. The result names, per document, the runs of lines that stay -
a run-length coded bitmap - and not text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.common import let, stored

MIN_LENGTH = 20
MIN_DOCUMENTS = 3
SALTS = 64
WHITE = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lines(text: str):
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def keep_bitmaps(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH, min_documents: int = MIN_DOCUMENTS
) -> DataFrame:
    """(id, text_hash, n_lines, n_dropped, keep) for each document that loses lines; ``keep`` has the runs (first, lines) that stay.

    A key is a line without white space at its ends, A-Z lower-cased. Keys of at least ``min_length`` code points in at
    least ``min_documents`` documents lose their lines in all documents but the one of the largest id. NULL and empty texts
    are one empty line. Rows of equal id are one document for the count; a missing id is below all others.
    """
    rows = docs.select(
        F.coalesce(F.col(id_column).cast("bigint"), F.lit(-(1 << 63))).alias("id"), F.xxhash64(text).alias("text_hash"), _lines(text).alias("lines")
    )
    lines = rows.select("id", "text_hash", F.size("lines").alias("n_lines"), F.posexplode("lines").alias("pos", "line"))
    key = F.translate(F.btrim("line", F.lit(WHITE)), _UPPER, _LOWER)
    lines = lines.select("id", "text_hash", "n_lines", "pos", key.alias("key")).where(F.length("key") >= min_length)
    hashed = stored(
        lines.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("line"), "key").alias("h2"), "id", "text_hash", "n_lines", "pos"), "lines"
    )
    salted = hashed.select("h1", "h2", F.pmod(F.xxhash64("id"), F.lit(SALTS)).alias("salt"), "id", "pos").repartitionByRange("h1", "h2", "salt")
    order = Window.partitionBy("h1", "h2", "salt").orderBy(F.desc("id"), "pos")
    begins = F.coalesce((F.lag("id").over(order) != F.col("id")).cast("int"), F.lit(1))
    spread = salted.select("h1", "h2", "id", begins.alias("begins")).where("begins = 1")
    repeated = spread.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.max("id").alias("last")).where(F.col("n") >= min_documents)
    lost = hashed.join(repeated.select("h1", "h2", "last"), ["h1", "h2"]).where(F.col("id") != F.col("last"))
    gone = lost.groupBy("id", "text_hash").agg(
        F.max("n_lines").alias("n_lines"), F.array_sort(F.collect_set("pos")).alias("gone")
    )
    # A run of kept lines lies between two lost lines that are not neighbours.
    edges = F.concat(F.array(F.lit(-1)), F.col("gone"), F.array(F.col("n_lines")))
    runs = F.transform(
        F.col("edges"), lambda e, i: F.struct((e + 1).alias("first"), (F.get(F.col("edges"), i + 1) - e - 1).alias("lines"))
    )
    gone = gone.withColumn("edges", edges)
    return gone.select("id", "text_hash", "n_lines", F.size("gone").alias("n_dropped"), F.filter(runs, lambda r: r["lines"] > 0).alias("keep"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``row`` (the given row as a struct), ``n_lines``, ``n_dropped`` and ``kept_text`` of every document."""
    rows = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(id_column).cast("bigint"), F.lit(-(1 << 63))).alias("id"), F.xxhash64(text).alias("text_hash"))
    joined = rows.join(bitmaps.drop("n_lines"), ["id", "text_hash"], "left")
    whole = F.coalesce(F.col(f"row.{text}"), F.lit(""))
    lines = F.split(whole, "\n", -1)
    parts = let(lines, lambda every: F.transform("keep", lambda r: F.slice(every, r["first"] + 1, r["lines"])))
    kept = F.array_join(F.flatten(parts), "\n")
    return joined.select(
        "row", F.size(lines).cast("bigint").alias("n_lines"), F.coalesce("n_dropped", F.lit(0)).cast("bigint").alias("n_dropped"),
        F.when(F.col("keep").isNull(), whole).otherwise(kept).alias("kept_text"),
    )


def digest_columns(applied: DataFrame) -> DataFrame:
    return applied.select(
        F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    )
