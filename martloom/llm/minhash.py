"""Near-duplicates of whole texts by BagMinHash: weighted Jaccard similarity of multisets of five-word runs.

1. One pass computes for every text a digest of its words and a signature. The weight axis of each run of words is cut
   into dyadic strips [0,1), [1,2), [2,4), [4,8) ... A strip carries a Poisson process whose points fall uniformly on its
   weights and on the components of the signature; a point counts when it lies below the run's multiplicity in the text.
   A component keeps the first point. Two texts agree in a component with the probability of their weighted Jaccard
   similarity, without bias. Points are drawn lazily: only those that can still be first.
2. Exact copies collapse by digest, with map-side pre-aggregation.
3. Bands of the signature are buckets, and the least digest of a bucket is its hub. Each text is first verified
   against one of its hubs, by the overlap of the whole multisets; verified links are joined into components. Then it is
   verified against those of its hubs that are still in another component. No bucket is expanded into pairs, none is capped.
4. Where a large bucket still holds several components, its texts are put in random orders and neighbours of different
   components are verified, as long as a pass joins a good part of the components: what is dense grows together in a few
   passes over linear work, and only what has few partners in its buckets is left.
5. What is still apart is joined exactly: two multisets at the similarity share one of the tokens that come first in each by
   rarity, and enough tokens can follow in both; such pairs of different components are verified.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.common import map_batches, mix, runs_of_words, scan_words, stored, stored_with, text_blocks
from martloom.llm.graph import contracted, hung

RUN = 5
SIMILARITY = 0.8
# 32 bands of 5: a pair at similarity 0.8 shares no band with probability 3e-6.
BANDS, BAND_ROWS = 32, 5
COMPONENTS = BANDS * BAND_ROWS
_SLACK = 3.0
# Buckets of more texts are put in random orders first, in pieces of about so many rows.
LARGE, PIECE = 64, 20_000
# Passes go on while one joins more than this part of the texts in such buckets to another component.
PROGRESS = 200
_SLOTS = 1 << 16
# Ids to fetch texts by: up to so many go to every task.
BROADCAST_ROWS = 1 << 21
# The points of a block are several times its text.
_BLOCK_BYTES = 1 << 19


def multisets(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct runs of words per row: (hash, multiplicity, row), ordered by row; then two digest words per row.

    A text of one to four words is one run. The digest of a text without words is that of its bytes.
    """
    words = scan_words(column)
    hashes = words.hashes()
    n_words = np.diff(words.first)
    found, at = runs_of_words(hashes, words.row, RUN)
    found, rows = [found], [words.row[at]]
    for k in range(1, RUN):
        short = np.flatnonzero(n_words == k)
        if len(short):
            total = np.zeros(len(short), np.uint64)
            for j in range(k):
                total = mix(total) + hashes[words.first[short] + j]
            found.append(mix(total + np.uint64(k)))
            rows.append(short)
    value, row = np.concatenate(found), np.concatenate(rows)
    key = mix(value ^ mix(row.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key)
    key, value, row = key[order], value[order], row[order]
    new = np.flatnonzero(np.concatenate([[True], (value[1:] != value[:-1]) | (row[1:] != row[:-1])])) if len(key) else np.zeros(0, np.int64)
    weight = np.diff(np.append(new, len(key)))
    value, row = value[new], row[new]
    order = np.argsort(row, kind="stable")
    return value[order], weight[order], row[order], *digests(column, words, hashes)


def digests(column: pa.Array, words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits per row that depend on all its words in order."""
    out = []
    place = np.arange(len(hashes)) - np.repeat(words.first[:-1], np.diff(words.first))
    for salt in (np.uint64(11), np.uint64(0x5DEECE66D)):
        terms = mix(hashes + salt * mix(place.astype(np.uint64) + salt))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
        out.append(mix(sums[words.first[1:]] - sums[words.first[:-1]] + salt))
    for i in np.flatnonzero(np.diff(words.first) == 0):
        content = column[int(i)].as_py()
        if content:
            raw = np.frombuffer(content.encode("utf-8"), np.uint8).astype(np.uint64)
            terms = mix(raw + mix(np.arange(len(raw), dtype=np.uint64) * np.uint64(256) + np.uint64(5)))
            out[0][i] = mix(terms.sum(dtype=np.uint64) + np.uint64(1))
            out[1][i] = mix(mix(terms + np.uint64(9)).sum(dtype=np.uint64))
    return out[0], out[1]


def signatures(value: np.ndarray, weight: np.ndarray, row: np.ndarray, rows: int, m: int = COMPONENTS) -> np.ndarray:
    """(rows, m) values of 14 bits; rows without a run stay 0."""
    out = np.zeros((rows, m), np.uint16)
    total = np.bincount(row, weight, rows)
    limit = np.where(total > 0, (np.log(m) + _SLACK) / np.maximum(total, 1), 0)
    # One entry per run and strip; strip j covers the weights [2^(j-1), 2^j), strip 0 covers [0, 1).
    strips = 1 + np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64)
    item = np.repeat(np.arange(len(value)), strips)
    strip = np.arange(len(item)) - np.repeat(np.cumsum(strips) - strips, strips)
    width = np.where(strip > 0, 2.0 ** (strip - 1), 1.0)
    base = np.where(strip > 0, width, 0.0)
    seed = mix(value[item] + np.uint64(0x632BE59BD9B4E019) * strip.astype(np.uint64))
    open_rows = total > 0
    while open_rows.any():
        take = np.flatnonzero(open_rows[row[item]])
        first = np.full(rows * m, np.inf)
        who = np.zeros(rows * m, np.uint64)
        for slot, x, name in _points(seed[take], width[take], base[take], weight[item[take]], row[item[take]], limit, m):
            np.minimum.at(first, slot, x)
            won = x == first[slot]
            who[slot[won]] = name[won]
        first, who = first.reshape(rows, m), who.reshape(rows, m)
        done = open_rows & np.isfinite(first).all(axis=1)
        out[done] = (who[done] >> np.uint64(50)).astype(np.uint16)
        open_rows &= ~done
        limit = limit * 2
    return out


def _points(seed, width, base, weight, row, limit, m) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Points up to each row's limit, some draws of every process at a time."""
    at, step, chunk = np.zeros(len(seed)), 0, 4
    while len(seed):
        k = np.arange(step, step + chunk, dtype=np.uint64)
        draw = mix(seed[:, None] + mix(k + np.uint64(1))[None, :])
        gaps = -np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / (m * width)[:, None]
        x = at[:, None] + np.cumsum(gaps, axis=1)
        i, j = np.nonzero(x <= limit[row][:, None])
        other = mix(draw[i, j] ^ np.uint64(0x94D049BB133111EB))
        part = (other & np.uint64(0xFFFFFFFF)).astype(np.float64) * 2.0**-32
        kept = base[i] + part * width[i] < weight[i]
        i, j, other = i[kept], j[kept], other[kept]
        component = ((other >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
        yield row[i] * m + component.astype(np.int64), x[i, j], mix(draw[i, j])
        alive = x[:, -1] <= limit[row]
        seed, width, base, weight, row, at = seed[alive], width[alive], base[alive], weight[alive], row[alive], x[alive, -1]
        step, chunk = step + chunk, min(chunk * 4, 64)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """(rows, bands) bucket keys."""
    parts = signature.reshape(len(signature), BANDS, BAND_ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), parts.shape[:2]) + np.uint64(7)
    for j in range(BAND_ROWS):
        key = mix(key * np.uint64(65599) + parts[:, :, j])
    return key


def _binary_digest(one: np.ndarray, two: np.ndarray) -> pa.Array:
    raw = np.stack([one, two], axis=1).astype(">u8").tobytes()
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(one), [None, pa.py_buffer(raw)]).cast(pa.binary())


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in text_blocks(batch, "text", _BLOCK_BYTES):
            column = block.column("text")
            value, weight, row, one, two = multisets(column)
            sketch = signatures(value, weight, row, len(column))
            filled = np.bincount(row, minlength=len(column)) > 0
            keys = band_keys(sketch).view(np.int64)
            bands = pa.array([k if f else k[:0] for k, f in zip(keys, filled, strict=True)], pa.list_(pa.int64()))
            digest = _binary_digest(one, two)
            missing = pa.compute.is_null(column)
            yield pa.RecordBatch.from_arrays(
                [block.column("id"), pa.compute.if_else(missing, pa.scalar(None, pa.binary()), digest), bands],
                ["id", "digest", "bands"],
            )


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest and multiset (sorted hashes, then multiplicities) of each text."""
    for batch in batches:
        for block in text_blocks(batch, "text", _BLOCK_BYTES):
            value, weight, row, one, two = multisets(block.column("text"))
            bounds = np.searchsorted(row, np.arange(block.num_rows + 1))
            packed = []
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                order = np.argsort(value[a:b])
                packed.append(value[a:b][order].tobytes() + weight[a:b][order].astype(np.uint32).tobytes())
            yield pa.RecordBatch.from_arrays([_binary_digest(one, two), pa.array(packed, pa.binary())], ["digest", "runs"])


def unpack(runs: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(runs) // 12
    return np.frombuffer(runs, np.uint64, n), np.frombuffer(runs, np.uint32, n, 8 * n).astype(np.int64)


def weighted_jaccard(a: bytes, b: bytes) -> float:
    """Sum of minima over sum of maxima of two packed multisets."""
    (va, wa), (vb, wb) = unpack(a), unpack(b)
    if not len(va) or not len(vb):
        return 0.0
    at = np.minimum(np.searchsorted(vb, va), len(vb) - 1)
    same = vb[at] == va
    shared = int(np.minimum(wa[same], wb[at[same]]).sum())
    return shared / (int(wa.sum()) + int(wb.sum()) - shared)


def _verify(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("ru"), batch.column("rv"), strict=True)
            kept = [weighted_jaccard(a.as_py(), b.as_py()) >= least for a, b in pairs]
            yield batch.select(["u", "v"]).filter(pa.array(kept, pa.bool_()))

    return run


def _fetch_runs(wanted: DataFrame, rows: int, docs: DataFrame) -> DataFrame:
    """(digest, runs) of the wanted texts (digest, id), so many rows. Each text is fetched by the id of its first copy."""
    # By size only: a few ids need no shuffle of all texts.
    side = F.broadcast if rows <= BROADCAST_ROWS else lambda df: df
    found = docs.join(side(wanted.select(F.col("id").alias("wanted"))), docs["id"].eqNullSafe(F.col("wanted")), "left_semi").select("text")
    found = map_batches(found, _runs, "digest binary, runs binary")
    return found.join(side(wanted.select("digest")), "digest", "left_semi").dropDuplicates(["digest"])


def _links(pairs: DataFrame, runs: DataFrame, least: float) -> DataFrame:
    """The pairs (u, v) of digests whose multisets are similar enough."""
    joined = pairs.join(runs.select(F.col("digest").alias("u"), F.col("runs").alias("ru")), "u").join(
        runs.select(F.col("digest").alias("v"), F.col("runs").alias("rv")), "v"
    )
    return map_batches(joined.select("u", "v", "ru", "rv"), _verify(least), "u binary, v binary")


def occurrences(packed: bytes) -> np.ndarray:
    """Every occurrence of a run as a 64-bit number: the overlap of two multisets is that of these sets."""
    value, weight = unpack(packed)
    occurrence = np.arange(int(weight.sum())) - np.repeat(np.cumsum(weight) - weight, weight)
    return mix(np.repeat(value, weight) + mix(occurrence.astype(np.uint64)))


def _slot_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(_SLOTS, np.int64)
    for batch in batches:
        for packed in batch.column("runs"):
            counts += np.bincount((occurrences(packed.as_py()) % np.uint64(_SLOTS)).astype(np.int64), minlength=_SLOTS)
    filled = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(filled, pa.int64()), pa.array(counts[filled], pa.int64())], ["slot", "n"])


def _first_tokens(common: np.ndarray, least: float):
    """The tokens of a text that must hold one of its shared ones: by rarity, as many as can all be missing, and one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for digest, part, packed in zip(*[batch.column(c) for c in ("digest", "part", "runs")], strict=True):
                token = occurrences(packed.as_py())
                order = np.lexsort((token, common[(token % np.uint64(_SLOTS)).astype(np.int64)]))
                size = len(token)
                n = size - int(np.ceil(least * size - 1e-9)) + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(token[order[:n]].view(np.int64)), pa.array([digest.as_py()] * n, pa.binary()), pa.array([part.as_py()] * n, pa.binary()),
                     pa.array(np.arange(n), pa.int64()), pa.array([size] * n, pa.int64())],
                    ["token", "digest", "part", "place", "size"],
                )

    return run


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """(id, digest, class_id) per given row, under the names ``id``, ``digest``, ``class_id``.

    Texts are linked when their multisets of five-word runs have a weighted Jaccard similarity of at least ``least``;
    classes are the connected texts, named by their least id. Words are as in ``common.scan_words``. A text of fewer
    than five words is one run. Texts with the same words in the same order are copies; texts without words only if
    equal. A NULL text is alone in its class. Repeated rows share a class; an empty table gives an empty result.
    """
    docs = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    rows = stored(map_batches(docs, _sketch, "id bigint, digest binary, bands array<bigint>"), "sketch")
    copies = rows.where(F.col("digest").isNotNull())
    texts = stored(copies.groupBy("digest").agg(F.min("id").alias("id"), F.first("bands").alias("bands")), "texts")
    bands = texts.select("digest", F.explode("bands").alias("key"))
    hubs = bands.groupBy("key").agg(F.min("digest").alias("hub"), F.count("*").alias("n")).where("n > 1").select("key", "hub")
    buckets = stored(bands.join(hubs, "key"), "buckets")
    # First each text meets one hub: the least of all its buckets' hubs.
    met = buckets.groupBy("digest").agg(F.min("hub").alias("least"))
    wanted, seen = stored_with(met.join(texts.select("digest", "id"), "digest"), "wanted")
    runs = stored(_fetch_runs(wanted, seen["rows"], docs), "runs")
    pairs = wanted.where(F.col("least") != F.col("digest")).select(F.col("least").alias("u"), F.col("digest").alias("v"))
    parts = hung(_links(pairs, runs, least))
    parts = wanted.select(F.col("digest").alias("node")).join(parts, "node", "left")
    parts = stored(parts.select("node", F.coalesce("component", "node").alias("component")), "parts")
    # Then the hubs that are still in another component.
    more, seen = stored_with(_other_hubs(buckets, parts).join(pairs, ["u", "v"], "left_anti"), "pairs")
    if seen["rows"]:
        parts, _ = _grown(parts, _links(more, runs, least))
    # Last what the buckets hold beyond their hubs.
    mixed, seen = stored_with(_mixed(buckets, parts), "mixed", F.count_if(F.col("n") > LARGE).alias("large"))
    if seen["rows"]:
        held, whole = stored_with(runs.join(mixed.select("digest").distinct(), "digest", "left_semi"), "held")
        turn, found = 0, whole["rows"] if seen["large"] else 0
        while found * PROGRESS > whole["rows"]:
            parts, found = _grown(parts, _links(_chance_pairs(mixed, turn), held, least))
            turn += 1
            if found:
                mixed = stored(_mixed(buckets, parts), "mixed")
        parts, _ = _grown(parts, _links(_rare_pairs(mixed, held, least), held, least))
    named = texts.select("digest", "id").join(parts, texts["digest"] == parts["node"], "left")
    named = named.select("digest", "id", F.coalesce("component", "digest").alias("component"))
    least_id = named.groupBy("component").agg(F.min("id").alias("class_id"))
    classes = named.join(least_id, "component").select("digest", "class_id")
    out = rows.select("id", "digest").join(classes, "digest", "left")
    return out.select("id", "digest", F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"))


def _ordered(pairs: DataFrame) -> DataFrame:
    """Distinct (u, v) with u < v of pairs (digest, hub)."""
    return pairs.select(F.least("hub", "digest").alias("u"), F.greatest("hub", "digest").alias("v")).distinct()


def _other_hubs(buckets: DataFrame, parts: DataFrame) -> DataFrame:
    """Pairs of a text and a bucket's hub that are in different components."""
    pairs = _ordered(buckets.where(F.col("hub") != F.col("digest")))
    for end, part in (("u", "pu"), ("v", "pv")):
        pairs = pairs.join(parts.select(F.col("node").alias(end), F.col("component").alias(part)), end)
    return pairs.where(F.col("pu") != F.col("pv")).select("u", "v")


def _mixed(buckets: DataFrame, parts: DataFrame) -> DataFrame:
    """(key, digest, part, n) of the buckets that hold several components; n are their texts in all. Buckets of two texts are
    done, their pair was verified."""
    placed = buckets.select("key", "digest").join(parts.select(F.col("node").alias("digest"), F.col("component").alias("part")), "digest")
    several = placed.groupBy("key").agg(F.min("part").alias("a"), F.max("part").alias("b"), F.count("*").alias("n"))
    return placed.join(several.where((F.col("a") != F.col("b")) & (F.col("n") > 2)).select("key", "n"), "key")


def _chance_pairs(mixed: DataFrame, turn: int) -> DataFrame:
    """Neighbours of different components in a random order of each large bucket, which is cut into pieces at random, too.

    Of a bucket's largest component about as many texts take part, at random, as there are others: these need partners.
    """
    large = mixed.where(F.col("n") > LARGE)
    largest = large.groupBy("key", "part").agg(F.count("*").alias("most")).groupBy("key").agg(F.max(F.struct("most", "part")).alias("m"))
    rows = large.join(largest.select("key", F.col("m.part").alias("main"), F.col("m.most").alias("most")), "key")
    chance = F.pmod(F.xxhash64(F.lit(turn), "digest"), F.lit(1 << 20)) / (1 << 20)
    rows = rows.where((F.col("part") != F.col("main")) | (chance * F.col("most") < F.col("n") - F.col("most")))
    piece = F.pmod(F.xxhash64("digest", F.lit(turn), F.lit("piece")), F.ceil(F.col("n") / PIECE))
    order = Window.partitionBy("key", "piece").orderBy(F.xxhash64(F.lit(turn), F.lit("order"), "digest"), "digest")
    rows = rows.withColumn("piece", piece).select("digest", "part", F.lag("digest").over(order).alias("hub"), F.lag("part").over(order).alias("other"))
    return _ordered(rows.where(F.col("part") != F.col("other")))


def _rare_pairs(mixed: DataFrame, held: DataFrame, least: float) -> DataFrame:
    """Pairs of texts in different components that can be similar: they share a first token and can share enough after it.

    Rarity is counted in hashed slots; any order that is the same for all texts loses no pair, this one makes few. Of each
    token, the component with most texts is only ever the second side.
    """
    placed = mixed.select("digest", "part").distinct()
    texts = held.join(placed, "digest")
    common = np.zeros(_SLOTS, np.int64)
    # One number per slot.
    for row in map_batches(texts.select("runs"), _slot_counts, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).collect():
        common[row["slot"]] = row["n"]
    rows = stored(map_batches(texts, _first_tokens(common, least), "token bigint, digest binary, part binary, place bigint, size bigint"), "tokens")
    sizes = rows.groupBy("token", "part").agg(F.count("*").alias("n"))
    shared = sizes.groupBy("token").agg(F.max(F.struct("n", "part"))["part"].alias("main"), F.count("*").alias("parts")).where("parts > 1")
    rows = rows.join(shared.select("token", "main"), "token")
    names = ("digest", "part", "place", "size")
    left = rows.where(F.col("part") != F.col("main")).select("token", *[F.col(c).alias(c + "1") for c in names])
    right = rows.select(F.col("token").alias("token2"), *[F.col(c).alias(c + "2") for c in names], "main")
    # Two texts outside the main component meet once.
    once = (F.col("part2") == F.col("main")) | (F.col("part1") < F.col("part2"))
    sized = (F.col("size1") >= least * F.col("size2")) & (F.col("size2") >= least * F.col("size1"))
    follow = F.least(F.col("size1") - F.col("place1"), F.col("size2") - F.col("place2"))
    enough = follow * (1 + least) >= least * (F.col("size1") + F.col("size2")) - 1e-6
    pairs = left.join(right, (F.col("token") == F.col("token2")) & (F.col("part1") != F.col("part2")) & once & sized & enough)
    return _ordered(pairs.select(F.col("digest1").alias("digest"), F.col("digest2").alias("hub")))


def _grown(parts: DataFrame, links: DataFrame) -> tuple[DataFrame, int]:
    """The components after these links join them, and how many components have become part of another."""
    links, seen = stored_with(links, "links")
    if not seen["rows"]:
        return parts, 0
    edges = links
    for end, part in (("u", "pu"), ("v", "pv")):
        edges = edges.join(parts.select(F.col("node").alias(end), F.col("component").alias(part)), end)
    merged = contracted(edges.select(F.col("pu").alias("u"), F.col("pv").alias("v")))
    merged = merged.select(F.col("node").alias("old"), F.col("component").alias("new"))
    moved = parts.join(merged, parts["component"] == merged["old"], "left")
    moved = moved.select("node", F.coalesce("new", "component").alias("component"), "old", "new")
    # A component is named by one of its nodes.
    joined = F.count_if(F.col("node") == F.col("old")).alias("joined")
    grown, seen = stored_with(moved, "parts", joined)
    return grown.select("node", "component"), seen["joined"]


def _digest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in text_blocks(batch, "text", _BLOCK_BYTES):
            column = block.column("text")
            words = scan_words(column)
            digest = _binary_digest(*digests(column, words, words.hashes()))
            digest = pa.compute.if_else(pa.compute.is_null(column), pa.scalar(None, pa.binary()), digest)
            yield pa.RecordBatch.from_arrays([block.column("row"), digest], ["row", "digest"])


def keep_one(docs: DataFrame, id_column: str = "doc_id", text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """One row of each class, that of the least id; of repeated rows with the same id and words any one. Columns as given."""
    classes = near_duplicates(docs, id_column, text, least)
    first = classes.groupBy("class_id", F.col("digest").isNull().alias("missing")).agg(F.min(F.struct("id", "digest")).alias("k"))
    first = stored(first.select("k.*"), "kept")
    repeated = docs.groupBy(id_column).count().where("count > 1").select(F.col(id_column).alias("id"))
    repeated = stored(first.join(repeated, first["id"].eqNullSafe(repeated["id"]), "left_semi"), "repeated")
    if repeated.isEmpty():
        return docs.join(first, docs[id_column].eqNullSafe(first["id"]), "left_semi")
    single = first.join(repeated, first["id"].eqNullSafe(repeated["id"]), "left_anti")
    kept = docs.join(single, docs[id_column].eqNullSafe(single["id"]), "left_semi")
    several = docs.join(repeated, docs[id_column].eqNullSafe(repeated["id"]), "left_semi")
    kind = several.select(F.struct("*").alias("row")).schema["row"].dataType.simpleString()
    several = several.select(F.struct("*").alias("row"), F.col(text).alias("text"))
    several = map_batches(several, _digest_rows, f"row {kind}, digest binary").withColumn("id", F.col(f"row.{id_column}"))
    wanted = repeated.select(F.col("id").alias("rid"), F.col("digest").alias("rdigest"))
    chosen = several.join(
        wanted, several["id"].eqNullSafe(wanted["rid"]) & several["digest"].eqNullSafe(wanted["rdigest"]), "left_semi"
    )
    return kept.union(chosen.dropDuplicates(["id", "digest"]).select("row.*"))
