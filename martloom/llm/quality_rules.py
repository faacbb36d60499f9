"""Quality rules by distribution divergence.

Every text is compared with the reference of its language: the histogram of its character classes and the histogram of its
common words, by Jensen-Shannon distance (base 2, so 0 to 1). References are sums over all documents of a language. Words
fall into hashed slots; a slot that holds at least ``COMMON`` of a language's words is a common-word bin, all others form
one further bin, so a reference has at most 1 / COMMON + 1 bins. Every language has its own reference, whatever their number; texts of a
language with fewer than ``MIN_REFERENCE_WORDS`` words in all are not judged by distance and have none.

Sampling alone moves the histogram of a short text away from its reference. A distance therefore counts only beyond a
limit plus a term that falls with the square root of the text's size, and texts below ``MIN_WORDS`` are not judged by it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import ALNUM, DARK, Words, map_batches, mix, packed, runs_of_words, scan_words, stored, text_blocks, text_bytes

SLOTS = 1 << 13
COMMON = 0.002
# A task sums up so many languages at a time.
LANGUAGES = 256
MIN_REFERENCE_WORDS = 1000
MIN_WORDS = 30
# Distance limits for long texts, and what a text of one word may exceed them by.
CLASS_LIMIT, CLASS_SLACK = 0.16, 1.0
WORD_LIMIT, WORD_SLACK = 0.20, 3.0
RUN = 5

SYMBOLS = b"#*$%&|<>"
CLASSES = ("lower", "upper", "digit", "space", "line end", "mark", "symbol", "beyond ASCII")
# Bytes inside a character count for no class.
_CLASS = np.full(256, 6, np.int64)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 0, 1, 2
_CLASS[[0x20, 0x09]], _CLASS[[0x0A, 0x0B, 0x0C, 0x0D]] = 3, 4
_CLASS[list(b".,;:!?'\"()-")] = 5
_CLASS[0x80:0xC0], _CLASS[0xC0:] = len(CLASSES), 7
_NOT_LINE_END = np.ones(256, bool)
_NOT_LINE_END[0x0A] = False
_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True


def _repeated(key: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry whether its key is in its row elsewhere, and whether it is there earlier."""
    mixed = mix(key ^ mix(row.astype(np.uint64) + np.uint64(3)))
    order = np.argsort(mixed, kind="stable")
    same = np.zeros(len(key), bool)
    if len(key) > 1:
        same[1:] = (mixed[order][1:] == mixed[order][:-1]) & (row[order][1:] == row[order][:-1])
    earlier, anywhere = np.zeros(len(key), bool), np.zeros(len(key), bool)
    earlier[order] = same
    anywhere[order] = same | np.append(same[1:], False)
    return anywhere, earlier


def base_counts(column: pa.Array) -> dict[str, np.ndarray]:
    """The plain counts of each text. A line counts as repeated if it has a word and equals an earlier line of its text."""
    words = scan_words(column, DARK, lower=False)
    rows = words.rows
    _, offsets = text_bytes(column)

    def per_row(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return sums[offsets[1:]] - sums[offsets[:-1]]

    dark = DARK[words.data]
    lines = scan_words(column, _NOT_LINE_END, lower=False)
    inked = np.concatenate([[0], np.cumsum(dark, dtype=np.int64)])
    filled = inked[lines.end] > inked[lines.start]
    _, earlier = _repeated(lines.hashes()[filled], lines.row[filled])
    runs, at = runs_of_words(words.hashes(), words.row, RUN)
    twice, _ = _repeated(runs, words.row[at])
    edge = np.zeros(len(words.start) + RUN + 1, np.int64)
    np.add.at(edge, at[twice], 1)
    np.add.at(edge, at[twice] + RUN, -1)
    inside = np.cumsum(edge)[: len(words.start)] > 0
    return {
        "n_words": np.diff(words.first),
        "word_chars": per_row(dark & ((words.data < 0x80) | (words.data >= 0xC0))),
        "n_symbols": per_row(_IS_SYMBOL[words.data]),
        "n_dup_lines": np.bincount(lines.row[filled][earlier], minlength=rows),
        "n_repeat_words": np.bincount(words.row[inside], minlength=rows),
    }


def _classes(column: pa.Array) -> np.ndarray:
    """(rows, classes) characters."""
    data, offsets = text_bytes(column)
    n = len(CLASSES)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    return np.bincount(row * (n + 1) + _CLASS[data], minlength=(len(offsets) - 1) * (n + 1)).reshape(-1, n + 1)[:, :n]


def _slots(words: Words) -> np.ndarray:
    return (words.hashes() % np.uint64(SLOTS)).astype(np.int64)


def _count_histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task and language: how often each word slot (0 and up) and each character class (below 0) occurs."""
    sums: dict[str | None, np.ndarray] = {}
    n = len(CLASSES)

    def out() -> pa.RecordBatch:
        langs, keys, counts = [], [], []
        for lang, total in sums.items():
            at = np.flatnonzero(total)
            langs += [lang] * len(at)
            keys.append(at - n)
            counts.append(total[at])
        sums.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(np.concatenate(keys)), pa.array(np.concatenate(counts))], ["lang", "bin", "n"]
        )

    for batch in batches:
        for block in text_blocks(batch, "text"):
            column = block.column("text")
            codes = block.column("lang").dictionary_encode(null_encoding="encode")
            code, names = codes.indices.to_numpy(), codes.dictionary.to_pylist()
            words = scan_words(column, ALNUM)
            slot, classes = _slots(words), _classes(column)
            for i, lang in enumerate(names):
                total = sums.setdefault(lang, np.zeros(n + SLOTS, np.int64))
                total[:n] += classes[code == i].sum(axis=0)
                total[n:] += np.bincount(slot[code[words.row] == i], minlength=SLOTS)
                if len(sums) >= LANGUAGES:
                    yield out()
    if sums:
        yield out()


def references(docs: DataFrame) -> DataFrame:
    """(language, reference): one row for each language with enough words, as a table that stays on the executors.

    ``docs`` has columns text and lang. A reference holds counts of at most 1 / COMMON word slots and of the classes.
    """
    counts = stored(
        map_batches(docs, _count_histograms, "lang string, bin bigint, n bigint").groupBy("lang", "bin").agg(F.sum("n").alias("n")),
        "histograms",
    )
    words = F.sum(F.when(F.col("bin") >= 0, F.col("n")).otherwise(0)).alias("words")
    by_lang = counts.groupBy(F.col("lang").alias("language")).agg(words).where(F.col("words") >= MIN_REFERENCE_WORDS)
    heavy = (F.col("bin") < 0) | (F.col("n") >= COMMON * F.col("words"))
    bins = counts.join(by_lang, counts["lang"].eqNullSafe(F.col("language"))).where(heavy)
    bins = bins.groupBy("language").agg(F.first("words").alias("words"), F.collect_list(F.struct("bin", "n")).alias("bins"))
    return stored(map_batches(bins, _pack, "language string, reference binary"), "references")


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = []
        for words, bins in zip(batch.column("words").to_pylist(), batch.column("bins").to_pylist(), strict=True):
            values.append(np.array([(-len(CLASSES) - 1, words), *sorted((b["bin"], b["n"]) for b in bins)], np.int64).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("language"), pa.array(values, pa.binary())], ["language", "reference"])


def _reference(packed_bins: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class shares, bin of each slot, bin shares."""
    (_, words), *bins = np.frombuffer(packed_bins, np.int64).reshape(-1, 2).tolist()
    n = len(CLASSES)
    classes = np.zeros(n)
    common = [(b, c) for b, c in bins if b >= 0]
    for b, c in bins:
        if b < 0:
            classes[b + n] = c
    place = np.full(SLOTS, len(common), np.int64)
    for i, (b, _) in enumerate(common):
        place[b] = i
    shares = np.array([c / max(words, 1) for _, c in common] + [0.0])
    shares[-1] = max(0.0, 1 - shares.sum())
    return classes / max(classes.sum(), 1), place, shares


def jensen_shannon(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Distance of each row of counts from the reference shares; rows without counts have distance 0."""
    total = counts.sum(axis=1, keepdims=True)
    p = counts / np.maximum(total, 1)
    middle = (p + reference) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        a = np.where(p > 0, p * np.log2(p / middle), 0).sum(axis=1)
        b = np.where(reference > 0, reference * np.log2(reference / middle), 0).sum(axis=1)
    return np.where(total[:, 0] > 0, np.sqrt(np.clip((a + b) / 2, 0, 1)), 0.0)


def _distances(column: pa.Array, references: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class distance, word distance and number of compared words of each text; distances are NaN without a reference."""
    words = scan_words(column, ALNUM)
    slot, classes, n = _slots(words), _classes(column), np.diff(words.first)
    by_class, by_word = np.full(len(column), np.nan), np.full(len(column), np.nan)
    # Equal references stand for one language.
    codes = references.dictionary_encode(null_encoding="encode")
    code = codes.indices.to_numpy()
    for i, packed_bins in enumerate(codes.dictionary.to_pylist()):
        if packed_bins is None:
            continue
        shares, place, word_shares = _reference(packed_bins)
        members = np.flatnonzero(code == i)
        for low in range(0, len(members), 256):
            part = members[low : low + 256]
            by_class[part] = jensen_shannon(classes[part], shares)
            local = np.repeat(np.arange(len(part)), n[part])
            picks = np.concatenate([np.arange(words.first[i], words.first[i + 1]) for i in part])
            bins = np.bincount(local * len(word_shares) + place[slot[picks]], minlength=len(part) * len(word_shares))
            by_word[part] = jensen_shannon(bins.reshape(len(part), -1), word_shares)
    return by_class, by_word, n


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in text_blocks(batch, "text"):
            column = block.column("text")
            base = base_counts(column)
            by_class, by_word, n = _distances(column, block.column("reference"))
            root = np.sqrt(np.maximum(n, 1))
            # Not a number is never beyond a limit.
            far = (by_class > CLASS_LIMIT + CLASS_SLACK / root) | (by_word > WORD_LIMIT + WORD_SLACK / root)
            failed = (base["n_words"] < 10) | (100 * base["n_repeat_words"] > 20 * base["n_words"])
            kept = ~failed & ~(far & (n >= MIN_WORDS))
            yield pa.RecordBatch.from_arrays(
                [block.column("row"), *(pa.array(v, pa.int64()) for v in base.values()),
                 pa.array(by_class, from_pandas=True), pa.array(by_word, from_pandas=True), pa.array(failed), pa.array(kept)],
                ["row", *base, "class_distance", "word_distance", "base_failed", "kept"],
            )


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", keep: tuple[str, ...] | None = None) -> DataFrame:
    """``row`` (the columns ``keep``, or all, as a struct), the five counts, both distances, ``base_failed`` and ``kept``.

    A NULL text counts as empty: no words, so the base rules fail it. A NULL language is a language of its own. Distances are
    NULL where the language has too few words for a reference; such texts are judged by the base rules only. Repeated
    rows are judged alike; an empty table gives an empty result.
    """
    refs = references(docs.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang")))
    given, kind = packed(docs, keep, text=text, lang=lang)
    # Broadcast or shuffled by the size of the stored references.
    given = given.join(refs, F.col("lang").eqNullSafe(F.col("language")), "left").select("row", "text", "reference")
    counts = ", ".join(f"{c} bigint" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
    return map_batches(
        given, _judge, f"row {kind}, {counts}, class_distance double, word_distance double, base_failed boolean, kept boolean"
    )
