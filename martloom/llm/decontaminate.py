"""Benchmark decontamination by Wu-Manber search over words.

The symbols of the search are words. The test strings are the benchmark's windows of 13 consecutive words, and for items
with fewer words the whole item. Windows of equal length form one search: a table gives for every block of two words how
far the search may shift without passing an occurrence; where it says 0, the windows whose last two words have the block's
hash are candidates, and their text is compared directly. Many stretches of text are searched side by side.

Spark cuts the benchmark into windows and deals them by a hash of window and item into parts of about ``part_bytes``, stored in the
shared folder. A part's search tables are a bounded broadcast. One part is one pass over the documents; with several, each
pass stores the hits of its part, its broadcast is destroyed before the next one, and the hits meet their texts at the end.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import Words, map_batches, mix, packed, scan_words, stored, text_blocks

WINDOW = 13
# Hit share from which a document is contaminated: 1 word in 20.
SHARE = 20
# A search's block table has 2^16 entries.
_TABLE_BITS = 16
# Words searched by one cursor.
_STRETCH = 512


class WuManber:
    """Tables for all windows of one length. ``windows`` maps the window's words, joined by spaces, to its item numbers."""

    def __init__(self, length: int, windows: dict[bytes, list[int]]) -> None:
        self.length = length
        self.block = min(2, length)
        self.texts = list(windows)
        self.items = [windows[w] for w in self.texts]
        column = pa.array([w.decode("utf-8") for w in self.texts], pa.large_string())
        hashes = scan_words(column).hashes().reshape(len(self.texts), length)
        last = length - self.block
        self.shift = np.full(1 << _TABLE_BITS, last + 1, np.int32)
        for at in range(last + 1):
            np.minimum.at(self.shift, self.block_hash(hashes, at), last - at)
        order = np.argsort(self._suffix(hashes), kind="stable")
        self.suffixes = self._suffix(hashes)[order]
        self.order = order

    def block_hash(self, hashes: np.ndarray, at: int) -> np.ndarray:
        full = hashes[:, at]
        for j in range(1, self.block):
            full = full * np.uint64(3) + hashes[:, at + j]
        return (mix(full) & np.uint64((1 << _TABLE_BITS) - 1)).astype(np.int64)

    def _suffix(self, hashes: np.ndarray) -> np.ndarray:
        full = hashes[:, self.length - self.block]
        for j in range(self.length - self.block + 1, self.length):
            full = full * np.uint64(3) + hashes[:, j]
        return mix(full)

    def search(self, words: Words, hashes: np.ndarray, plain: bytes, begin: np.ndarray, end: np.ndarray) -> Iterator[tuple[int, int]]:
        """(first word, window) of every occurrence. ``plain`` holds the words joined by single spaces."""
        n = len(hashes)
        if n < self.length:
            return
        pairs = hashes
        if self.block == 2:
            pairs = np.zeros(n, np.uint64)
            pairs[1:] = hashes[:-1] * np.uint64(3) + hashes[1:]
        suffix = mix(pairs)
        slot = (suffix & np.uint64((1 << _TABLE_BITS) - 1)).astype(np.int64)
        # A cursor stands on the last word of the window it looks at; it owns the stretch of last words up to ``stop``.
        low = np.arange(self.length - 1, n, _STRETCH)
        cursor, stop = low.copy(), np.minimum(low + _STRETCH, n)
        found = []
        while len(cursor):
            jump = self.shift[slot[cursor]]
            hit = cursor[jump == 0]
            if len(hit):
                found.append(hit)
            cursor = cursor + np.maximum(jump, 1)
            live = cursor < stop
            cursor, stop = cursor[live], stop[live]
        if not found:
            return
        last = np.concatenate(found)
        first = last - self.length + 1
        same = words.row[first] == words.row[last]
        first, last = first[same], last[same]
        left = np.searchsorted(self.suffixes, suffix[last], "left")
        right = np.searchsorted(self.suffixes, suffix[last], "right")
        for i in np.flatnonzero(right > left):
            text = plain[begin[first[i]] : end[last[i]]]
            for j in self.order[left[i] : right[i]]:
                if self.texts[j] == text:
                    yield int(first[i]), int(j)


def _joined(words: Words) -> tuple[bytes, np.ndarray, np.ndarray]:
    """All words joined by single spaces, and each word's range in that."""
    sizes = words.end - words.start
    end = np.cumsum(sizes + 1) - 1
    begin = end - sizes
    plain = np.full(int(end[-1]) + 1 if len(end) else 0, 32, np.uint8)
    shift = np.repeat(words.start - begin, sizes)
    places = np.arange(int(sizes.sum())) + np.repeat(begin - (np.cumsum(sizes) - sizes), sizes)
    plain[places] = words.data[places + shift]
    return plain.tobytes(), begin, end


def item_windows(item: str | None, text: str, window: int = WINDOW) -> list[tuple[int, bytes, str | None]]:
    """(words, window's words joined by spaces, item) of all windows of an item; none for a text without words."""
    words = scan_words(pa.array([text], pa.large_string()))
    tokens = [words.data[a:b].tobytes() for a, b in zip(words.start, words.end, strict=True)]
    length = min(window, len(tokens))
    return [(length, b" ".join(tokens[at : at + length]), item) for at in range(len(tokens) - length + 1 if tokens else 0)]


def searches_of(windows: list[tuple[int, bytes, str | None]]) -> list[WuManber]:
    """One search per window length."""
    by_length: dict[int, dict[bytes, list]] = defaultdict(lambda: defaultdict(list))
    for length, text, item in windows:
        ids = by_length[length][text]
        if item not in ids:
            ids.append(item)
    return [WuManber(length, dict(found)) for length, found in sorted(by_length.items())]


def find_hits(column: pa.Array, searches: list[WuManber]) -> tuple[np.ndarray, list[list[dict]]]:
    """Words per row, and per row the stretches of words (from, until) in which windows of an item occur."""
    words = scan_words(column)
    found: list[dict] = [{} for _ in range(words.rows)]
    if len(words.start):
        hashes = words.hashes()
        plain, begin, end = _joined(words)
        for search in searches:
            for at, window in sorted(search.search(words, hashes, plain, begin, end)):
                row = int(words.row[at])
                low = at - int(words.first[row])
                for item in search.items[window]:
                    parts = found[row].setdefault(item, [])
                    if parts and parts[-1][0] <= low <= parts[-1][1]:
                        parts[-1][1] = max(parts[-1][1], low + search.length)
                    else:
                        parts.append([low, low + search.length])
    rows = [[{"item": item, "from": a, "until": b} for item, parts in row.items() for a, b in parts] for row in found]
    return np.diff(words.first), rows


def covered(n_words: int, hits: list[dict]) -> int:
    """Words inside any of the stretches."""
    if not hits:
        return 0
    edge = np.zeros(n_words + 1, np.int64)
    for hit in hits:
        edge[hit["from"]] += 1
        edge[hit["until"]] -= 1
    return int((np.cumsum(edge)[:n_words] > 0).sum())


_HITS = pa.list_(pa.struct([("item", pa.string()), ("from", pa.int64()), ("until", pa.int64())]))
_HITS_DDL = "array<struct<item: string, `from`: bigint, until: bigint>>"


def _windows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist(), strict=True):
                rows = item_windows(item, text, window)
                for low in range(0, len(rows), 1 << 12):
                    length, words, items = zip(*rows[low : low + (1 << 12)], strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(length, pa.int32()), pa.array(words, pa.binary()), pa.array(items, pa.string())], ["length", "words", "item"])

    return run


def _summed(n_words: np.ndarray, hits: list[list[dict]]) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Words, hit words and sorted item ids of each row."""
    ids = [sorted({h["item"] for h in found} - {None}) for found in hits]
    n_hit = [covered(n, h) for n, h in zip(n_words, hits, strict=True)]
    return pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(ids, pa.list_(pa.string()))


def _one_pass(tables: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in text_blocks(batch, "text"):
                n_words, hits = find_hits(block.column("text"), tables.value)
                columns = [block.column("row"), *_summed(n_words, hits), pa.array(hits, _HITS)]
                yield pa.RecordBatch.from_arrays(columns, ["row", "n_words", "n_hit", "item_ids", "hits"])

    return run


def _part_hits(tables: Broadcast):
    """The hits of one part, of texts that have any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in text_blocks(batch, "text"):
                _, hits = find_hits(block.column("text"), tables.value)
                at = [i for i, found in enumerate(hits) if found]
                if at:
                    yield pa.RecordBatch.from_arrays([block.column("name").take(pa.array(at)), pa.array([hits[i] for i in at], _HITS)], ["name", "hits"])

    return run


def _merged(hits: list[dict]) -> list[dict]:
    """The stretches of each item, with those that touch made one: windows of an item can be in several parts."""
    out: list[dict] = []
    for hit in sorted(hits, key=lambda h: (h["item"] is not None, h["item"] or "", h["from"])):
        if out and out[-1]["item"] == hit["item"] and hit["from"] <= out[-1]["until"]:
            out[-1]["until"] = max(out[-1]["until"], hit["until"])
        else:
            out.append(dict(hit))
    return out


def _all_hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in text_blocks(batch, "text"):
            hits = [_merged(found or []) for found in block.column("hits").to_pylist()]
            n_words = np.diff(scan_words(block.column("text")).first)
            yield pa.RecordBatch.from_arrays([block.column("row"), *_summed(n_words, hits), pa.array(hits, _HITS)], ["row", "n_words", "n_hit", "item_ids", "hits"])


def _stored_windows(benchmark: DataFrame, item_id: str, text: str, window: int, part_bytes: int) -> tuple[DataFrame, int]:
    """(length, words, item, part) of the whole benchmark, each once, and the number of parts."""
    given = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("text")).where(F.col(text).isNotNull())
    rows = stored(map_batches(given, _windows(window), "length int, words binary, item string").distinct(), "windows")
    size = rows.agg(F.sum(F.octet_length("words") + F.coalesce(F.octet_length("item"), F.lit(0)) + 64)).first()[0] or 0
    parts = max(1, -(-size // part_bytes))
    return rows.withColumn("part", F.pmod(F.xxhash64("words", "item"), F.lit(parts))), parts


def find_overlaps(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, part_bytes: int = 32 << 20, keep: tuple[str, ...] | None = None,
) -> DataFrame:
    """``row`` (the columns ``keep``, or all, as a struct), ``n_words``, ``n_hit``, ``item_ids`` (sorted strings), ``hits`` (word ranges
    by item), ``contaminated``.

    Words are letters, digits and all beyond ASCII, A-Z lower-cased. A NULL or empty text has no words and is not
    contaminated. Benchmark rows with NULL text or no words have no window; a NULL item id takes part in hits but not in
    ``item_ids``; repeated items count once. Repeated documents are judged row by row.
    """
    sc = docs.sparkSession.sparkContext
    windows, parts = _stored_windows(benchmark, item_id, item_text, window, part_bytes)

    def tables(part: int) -> Broadcast:
        # A part is bounded by ``part_bytes``.
        rows = windows.where(F.col("part") == part).select("length", "words", "item").collect()
        return sc.broadcast(searches_of([(r["length"], bytes(r["words"]), r["item"]) for r in rows]))

    df, row = packed(docs, keep, text=text)
    out = f"row {row}, n_words bigint, n_hit bigint, item_ids array<string>, hits {_HITS_DDL}"
    if parts == 1:
        found = map_batches(df, _one_pass(tables(0)), out)
    else:
        # Two hashes name a text; copies share their hits.
        whole = F.coalesce("text", F.lit(""))
        named = df.withColumn("name", F.struct(F.xxhash64(whole).alias("a"), F.xxhash64(F.lit("text"), whole).alias("b")))
        every = None
        for part in range(parts):
            shared = tables(part)
            some = stored(map_batches(named.select("name", "text"), _part_hits(shared), f"name struct<a: bigint, b: bigint>, hits {_HITS_DDL}"), "part-hits")
            shared.destroy()
            every = some if every is None else every.union(some)
        once = every.distinct().groupBy("name").agg(F.flatten(F.collect_list("hits")).alias("hits"))
        once = once.select(F.col("name.a").alias("a"), F.col("name.b").alias("b"), "hits")
        met = named.join(once, (F.col("name.a") == F.col("a")) & (F.col("name.b") == F.col("b")), "left")
        found = map_batches(met.select("row", "text", "hits"), _all_hits, out)
    return found.withColumn("contaminated", (F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without its contaminated rows; columns as given."""
    return find_overlaps(docs, benchmark, **options).where(~F.col("contaminated")).select("row.*")


def digest_columns(found: DataFrame) -> DataFrame:
    return found.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"), "contaminated",
    )
