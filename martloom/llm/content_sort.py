"""Exact duplicates of whole texts by sorting their content, by built-in functions only.

White space is normalised first. Sampled splitters cut the texts, in the order of their bytes, into ranges; inside a range an
external sort places equal texts next to each other, and each text is compared in full with its neighbour. The first of
a run of equal texts has the least id and stays.

A splitter is the leading part of a text and a 64-bit hash of the rest, so what the sample brings to the driver is bounded
by bytes, and texts with a long common beginning still fall into different ranges. A group of copies is dealt over as many
ranges as there are partitions by a hash of the id; the heads of its runs, one row per run, are then brought together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.common import stored

# Runs of white space other than a single space; what this leaves alone is normal already.
_UNTIDY = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"
LEADING = 16
# A group of copies of a whole table is cut into pieces of about so many rows.
PIECE_ROWS = 50_000


def normalised(text: str) -> Column:
    """Each run of white space as one space; NULL as the empty text."""
    return F.regexp_replace(F.coalesce(F.col(f"`{text}`"), F.lit("")), _UNTIDY, " ")


def _pieces(docs: DataFrame) -> int:
    """Into how many pieces a hot group is dealt: never fewer than shuffle partitions, and more for more rows."""
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-docs.count() // PIECE_ROWS))


def sorted_runs(docs: DataFrame, id_column: str = "doc_id", text: str = "text", pieces: int | None = None) -> DataFrame:
    """(id, digest, piece, head, first_id) per row: ``head`` marks the first of a run of equal neighbours, ``first_id`` is its id.

    ``digest`` is the SHA-256 of the normalised text in hex. ``piece`` says which part of a group of copies the run is.
    """
    pieces = pieces or _pieces(docs)
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), normalised(text).alias("content"))
    keyed = rows.select(
        F.substring("content", 1, LEADING).alias("leading"), F.xxhash64("content").alias("spread"),
        F.pmod(F.xxhash64("id"), F.lit(pieces)).alias("piece"), "id", "content",
    )
    ranged = keyed.repartitionByRange("leading", "spread", "piece")
    order = Window.partitionBy("leading", "spread", "piece").orderBy("content", F.col("id").asc_nulls_last())
    first = F.coalesce(F.lag("content").over(order) != F.col("content"), F.lit(True))
    marked = ranged.select("leading", "spread", "piece", "id", "content", first.alias("head"))
    first_id = F.last(F.when(F.col("head"), F.struct("id")), ignorenulls=True).over(order)["id"]
    return marked.select("id", F.sha2(F.col("content").cast("binary"), 256).alias("digest"), "piece", "head", first_id.alias("first_id"))


def exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", pieces: int | None = None) -> DataFrame:
    """(id, keep_id, group_size, kept, digest) for every given row, whatever other columns there are.

    Texts are equal when they are identical after each run of blanks, tabs and line breaks is replaced by one blank; NULL is the
    empty text. ``keep_id`` is the least id of the equal texts, a missing id being the greatest; ``group_size`` counts their
    rows. Of rows that share both id and text only one is kept. An empty table gives an empty result.
    """
    runs = stored(sorted_runs(docs, id_column, text, pieces), "runs")
    sizes = runs.groupBy("digest", "piece").agg(F.count("*").alias("n"))
    heads = runs.where("head").select("digest", "piece", "first_id").join(sizes, ["digest", "piece"])
    # One row per piece of a group: a hot group has at most as many as there are pieces.
    least = F.min(F.struct(F.col("first_id").isNull().alias("missing"), F.col("first_id").alias("id"), "piece")).alias("least")
    groups = heads.groupBy("digest").agg(least, F.sum("n").alias("group_size"))
    told = heads.select("digest", "piece").join(groups, "digest").select(
        "digest", "piece", F.col("least.id").alias("keep_id"), (F.col("least.piece") == F.col("piece")).alias("leads"), "group_size"
    )
    return runs.join(told, ["digest", "piece"]).select(
        "id", "keep_id", "group_size", (F.col("head") & F.col("leads")).alias("kept"), "digest"
    )


def drop_copies(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of equal texts, that of the least id, with the columns as given; of rows that share id and text any one."""
    kept = exact_duplicates(docs, id_column, text).where("kept").select("id", "digest")
    row = F.struct("*").alias("row")
    rows = docs.select(row, F.col(f"`{id_column}`").alias("id"), F.sha2(normalised(text).cast("binary"), 256).alias("digest"))
    same = rows["id"].eqNullSafe(kept["id"]) & (rows["digest"] == kept["digest"])
    return rows.join(kept, same, "left_semi").dropDuplicates(["id", "digest"]).select("row.*")


def digest_columns(groups: DataFrame) -> DataFrame:
    return groups.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))
