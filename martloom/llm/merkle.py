"""A Merkle tree over a table, with a proof for every row by pointer jumping.

1. Each row becomes a leaf digest. Leaves are numbered inside their group by range partitions, in order of their ids.
2. Levels are built in aligned blocks of 2^BLOCK_LEVELS neighbouring nodes, one task each; the tops of the blocks are the next
   round's nodes. Every node keeps its sibling. The roots of the groups are the leaves of one more tree.
3. Pointer jumping: a node starts with a pointer to its parent and a segment that holds its sibling. A self-join replaces the
   pointer by that of the node it points to and appends that node's segment, which doubles the distance: 1, 2, 4, 8 ...
   levels. After distance d only nodes on levels that d divides are asked again, so the others are left out. The children of a
   group's root get the group's own path appended beforehand, so the last jump reaches the root of all.

A node on level d stands for 2^d leaves, which bounds how many rows of one key meet in a join.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import stored
from martloom.operators.keys import dense_key

BLOCK_LEVELS = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# A sibling stands to the left or right of the node, or the node is alone in its run.
LEFT, RIGHT, ALONE = 0, 1, 2
_ENTRY = "struct<side:tinyint,digest:binary>"
# A side of a join is broadcast only when the number of leaves proves that it is smaller.
BROADCAST_BYTES = 8 << 20
_NODE_BYTES, _ENTRY_BYTES = 128, 72


def encoded(value: Column) -> Column:
    """A value with its length in bytes before it, or a dash; so neighbouring values cannot be mistaken for each other."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: Sequence[Column]) -> Column:
    """SHA-256, as bytes, of the encoded fields one after the other."""
    return F.unhex(F.sha2(F.concat(*[encoded(f) for f in fields]).cast("binary"), 256))


def _depth(leaves: str) -> Column:
    """Levels above so many leaves: the bits of the largest index."""
    return F.when(F.col(leaves) > 1, F.length(F.bin(F.col(leaves) - 1))).otherwise(0)


def _block(key: tuple, group: pa.Table) -> pa.Table:
    """All nodes of one aligned block with their siblings. Its top, without a segment, is looked at again one round up."""
    depth = key[2].as_py()
    level = group.column("level")[0].as_py()
    order = group.column("idx").to_numpy().argsort()
    group = group.take(order)
    first, now = group.column("idx")[0].as_py(), group.column("digest").to_pylist()
    top = min(level + BLOCK_LEVELS, depth)
    levels, places, digests, segments = [], [], [], []
    while level < top:
        above = []
        for i in range(0, len(now), 2):
            pair = now[i : i + 2]
            if len(pair) == 2:
                segments += [[{"side": RIGHT, "digest": pair[1]}], [{"side": LEFT, "digest": pair[0]}]]
            else:
                segments.append([{"side": ALONE, "digest": None}])
            above.append(hashlib.sha256("".join([d.hex() for d in pair]).encode()).digest())
        levels += [level] * len(now)
        places += range(first, first + len(now))
        digests += now
        now, first, level = above, first >> 1, level + 1
    levels, places, digests, segments = levels + [level], places + [first], digests + now, segments + [None]
    size = len(levels)
    given = group.num_rows if levels[0] == 0 else 0
    kind = pa.list_(pa.struct([("side", pa.int8()), ("digest", pa.binary())]))
    out = {
        "tree": pa.array([key[0].as_py()] * size, pa.int64()), "depth": pa.array([depth] * size, pa.int32()),
        "level": pa.array(levels, pa.int32()), "idx": pa.array(places, pa.int64()), "digest": pa.array(digests, pa.binary()),
        "segment": pa.array(segments, kind),
    }
    for name in ("id", "other"):
        column = group.column(name).combine_chunks()
        out[name] = pa.concat_arrays([column.slice(0, given), pa.nulls(size - given, column.type)])
    return pa.table(out)


def _built(leaves: DataFrame, depth: int) -> tuple[DataFrame, DataFrame]:
    """All nodes but the roots, and the roots, of the trees over ``leaves`` (tree, depth, idx, digest, id, other)."""
    kind = leaves.schema["id"].dataType.simpleString()
    schema = f"tree bigint, depth int, level int, idx bigint, digest binary, segment array<{_ENTRY}>, id {kind}, other binary"
    now = leaves.withColumn("level", F.lit(0))
    nodes, roots, bottom = [], [], 0
    while True:
        block = F.shiftright("idx", BLOCK_LEVELS).alias("block")
        done = stored(now.groupBy("tree", block, "depth").applyInArrow(_block, schema), "nodes")
        tops = done.where(F.col("segment").isNull())
        nodes.append(done.where(F.col("segment").isNotNull()))
        roots.append(tops.where(F.col("level") == F.col("depth")))
        bottom += BLOCK_LEVELS
        if bottom >= depth:
            break
        # Ids belong to leaves, which have been given out.
        now = tops.where(F.col("level") < F.col("depth")).drop("segment").withColumn("id", F.lit(None).cast(kind))
    every, all_roots = nodes[0], roots[0]
    for more, more_roots in zip(nodes[1:], roots[1:], strict=True):
        every, all_roots = every.union(more), all_roots.union(more_roots)
    return every, all_roots


def _bounded(df: DataFrame, rows: float, entries: int) -> DataFrame:
    """``df`` marked for broadcast if so many rows with so many entries are sure to be small."""
    return F.broadcast(df) if rows * (_NODE_BYTES + entries * _ENTRY_BYTES) <= BROADCAST_BYTES else df


def _jumped(nodes: DataFrame, ends: DataFrame, depth: int, leaves: int, trees: int, above: int) -> DataFrame:
    """The leaves with their whole segments. ``ends`` (tree, path, subroot) has what follows after a tree's root, ``above`` entries."""
    start = nodes.select(
        "tree", "level", "idx", "id", "other", "digest", "segment", (F.col("level") + 1 == F.col("depth")).alias("last")
    )
    tail = _bounded(ends.withColumnRenamed("tree", "of"), trees, above)
    pointed = start.where(~F.col("last")).select(
        *start.columns[:-1], (F.col("level") + 1).alias("up_level"), F.shiftright("idx", 1).alias("up_idx"), F.lit(None).cast("binary").alias("subroot")
    )
    at_root = start.where("last").join(tail, F.col("tree") == F.col("of")).select(
        *start.columns[:-2], F.concat("segment", "path").alias("segment"),
        F.lit(None).cast("int").alias("up_level"), F.lit(None).cast("bigint").alias("up_idx"), "subroot",
    )
    now, distance = pointed.union(at_root), 1
    while distance < depth:
        now = stored(now, "pointers")
        asking = now.where(F.col("level") % (2 * distance) == 0)
        asked = now.where(F.col("level") % (2 * distance) == distance).select(
            F.col("tree").alias("at_tree"), F.col("level").alias("at_level"), F.col("idx").alias("at_idx"), F.col("segment").alias("more"),
            F.col("up_level").alias("next_level"), F.col("up_idx").alias("next_idx"), F.col("subroot").alias("found"),
        )
        # On level d there are at most leaves / 2^d nodes, and one more for each tree; on all its odd multiples less than twice that.
        asked = _bounded(asked, 2 * (leaves / 2.0**distance + trees * (depth // distance + 1)), 2 * distance + above)
        met = (F.col("tree") == F.col("at_tree")) & (F.col("up_level") == F.col("at_level")) & (F.col("up_idx") == F.col("at_idx"))
        now = asking.join(asked, met, "left").select(
            "tree", "level", "idx", "id", "other", "digest",
            F.when(F.col("more").isNull(), F.col("segment")).otherwise(F.concat("segment", "more")).alias("segment"),
            F.col("next_level").alias("up_level"), F.col("next_idx").alias("up_idx"), F.coalesce("subroot", "found").alias("subroot"),
        )
        distance *= 2
    return now.where("level = 0").select("tree", "idx", "id", "other", "digest", "segment", "subroot")


def manifest(
    docs: DataFrame, id_column: str = "doc_id", group: str = "lang", fields: Sequence[str] = FIELDS, changed: dict[str, Column] | None = None
) -> DataFrame:
    """(id, leaf, other, subroot, root, segment) for every given row; digests are bytes.

    The leaf covers ``fields``. The leaves of a group ascend by id, a missing id first and equal ids by leaf; the groups
    ascend by the bytes of their names, a missing one first. ``segment`` has the siblings from the leaf to the root, with
    the side on which each stands. ``other`` is the leaf of the row with the columns in ``changed`` replaced (NULL without).
    Missing values have their own encoding; repeated rows are leaves of their own. An empty table gives an empty result.
    """
    column = {c: F.col(f"`{c}`") for c in fields}
    other = leaf_digest([(changed or {}).get(c, column[c]) for c in fields]) if changed else F.lit(None).cast("binary")
    name = F.col(f"`{group}`").cast("string")
    leaves = stored(
        docs.select(
            name.isNotNull().alias("named"), F.coalesce(name, F.lit("")).alias("name"),
            F.col(f"`{id_column}`").isNotNull().alias("known"), F.col(f"`{id_column}`").alias("id"),
            leaf_digest(list(column.values())).alias("digest"), other.alias("other"),
        ),
        "leaves",
    )
    numbered = dense_key(leaves, "place", ["named", "name", "known", "id", "digest"])
    sizes = numbered.groupBy("named", "name").agg(F.count("*").alias("n"), F.min("place").alias("start"))
    groups = stored(dense_key(sizes, "number", ["named", "name"]).withColumn("depth", _depth("n")), "groups")
    trees, total, depth = groups.agg(F.count("*"), F.sum("n"), F.max("depth")).first()
    if not trees:
        return leaves.select("id", F.col("digest").alias("leaf"), "other", F.col("digest").alias("subroot"), F.col("digest").alias("root"),
                             F.array().cast(f"array<{_ENTRY}>").alias("segment"))
    placed = numbered.join(groups.drop("n"), ["named", "name"]).select(
        F.col("number").alias("tree"), "depth", (F.col("place") - F.col("start")).alias("idx"), "digest", "id", "other"
    )
    nodes, roots = _built(placed, depth)
    # The tree over the groups' roots; its leaves' ids are the groups' numbers.
    top_depth = max(trees - 1, 0).bit_length()
    tops = roots.select(F.lit(0).cast("bigint").alias("tree"), F.lit(top_depth).alias("depth"), (F.col("tree") - 1).alias("idx"), "digest",
                        F.col("tree").alias("id"), F.lit(None).cast("binary").alias("other"))
    top_nodes, top_root = _built(tops, top_depth)
    root = bytes(top_root.first()["digest"])
    none = F.array().cast(f"array<{_ENTRY}>")
    if top_depth:
        end = top_nodes.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("tree"), none.alias("path"), F.lit(root).alias("subroot"))
        paths = _jumped(top_nodes, end, top_depth, trees, 1, 0).select(F.col("id").alias("tree"), F.col("segment").alias("path"), F.col("digest").alias("subroot"))
    else:
        paths = tops.select(F.col("id").alias("tree"), none.alias("path"), F.col("digest").alias("subroot"))
    paths = stored(paths, "paths")
    # A group of one row: its leaf is its root.
    single = roots.where("depth = 0").select(F.col("tree").alias("of"), "id", "other", "digest")
    found = single.join(paths, F.col("of") == F.col("tree")).select("id", "other", "digest", F.col("path").alias("segment"), "subroot")
    if depth:
        found = found.union(_jumped(nodes, paths, depth, total, trees, top_depth).select("id", "other", "digest", "segment", "subroot"))
    return found.select("id", F.col("digest").alias("leaf"), "other", "subroot", F.lit(root).alias("root"), "segment")


def hex_text(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def proof_digest(segment: str = "segment") -> Column:
    """SHA-256 in hex of the siblings of a segment, as hex, one after the other."""
    siblings = F.transform(F.filter(segment, lambda s: s["side"] != ALONE), lambda s: hex_text(s["digest"]))
    return F.sha2(F.array_join(siblings, "").cast("binary"), 256)


def folded(start: Column, segment: str = "segment") -> Column:
    """The root, in hex, that a leaf and its siblings lead to."""

    def step(below: Column, s: Column) -> Column:
        sibling = F.coalesce(hex_text(s["digest"]), F.lit(""))
        return F.sha2(F.when(s["side"] == LEFT, F.concat(sibling, below)).otherwise(F.concat(below, sibling)).cast("binary"), 256)

    return F.aggregate(segment, hex_text(start), step)


def verify(proofs: DataFrame, docs: DataFrame, id_column: str = "doc_id", fields: Sequence[str] = FIELDS) -> DataFrame:
    """(id, verified) for rows presented later: whether the row, as it is now, leads to the root by the proof stored for its id.

    A row without a proof is not verified. Ids that several rows share are verified if any of their proofs fits.
    """
    shown = docs.select(F.col(f"`{id_column}`").alias("shown"), leaf_digest([F.col(f"`{c}`") for c in fields]).alias("now"))
    met = shown.join(proofs, shown["shown"].eqNullSafe(proofs["id"]), "left")
    fits = F.coalesce(folded(F.col("now")) == hex_text(F.col("root")), F.lit(False))
    return met.groupBy("shown", "now").agg(F.max(fits).alias("verified")).select(F.col("shown").alias("id"), "verified")


def digest_columns(proofs: DataFrame) -> DataFrame:
    """Proofs and digests as text, and whether ``other`` (else the leaf) leads to the root."""
    shown = proofs.select(
        F.col("id").alias("doc_id"), hex_text(F.col("leaf")).alias("leaf"), hex_text(F.col("subroot")).alias("subroot"),
        hex_text(F.col("root")).alias("root"), proof_digest().alias("proof_sha256"), folded(F.coalesce("other", "leaf")).alias("folded_root"),
    )
    return shown.withColumn("verified", F.col("folded_root") == F.col("root"))
