"""Toxicity by a linear classifier over character n-grams, scaled by naive Bayes log-count ratios.

Features are the distinct n-grams (4, 6 and 8 code points, lower-cased, inside one word with its edges) of the whole text, hashed
to FEATURES slots. For each slot the ratio r = log of its smoothed share among toxic texts over its share among others; a
logistic regression is fitted to the features times r. Only the SELECTED slots that tell the classes apart best are kept.

The fit uses at most PER_CLASS labelled texts of each class, chosen by hash; counts per slot are summed by Spark. The fit
itself sees sparse rows of selected slots only. Both classes have the same weight, since toxic texts are rare and a missed
one costs more than their share says.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import map_batches, mix, packed, stored, text_blocks

ORDERS = (4, 6, 8)
FEATURES = 1 << 18
SELECTED = 8192
PER_CLASS = 6000
FOLDS = 5
ROUNDS = 150
DECAY = 1e-4


@dataclass
class Model:
    weights: np.ndarray  # per slot, float32
    bias: float

    def score(self, slots: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
        z = self.bias + np.bincount(row, self.weights[slots], rows)
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (slot, row) pairs, ordered by row."""
    lowered = [" " + t.lower() + " " for t in texts]
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(t) for t in lowered])
    row = np.repeat(np.arange(len(texts)), sizes)
    letter = np.ones(128, bool)
    letter[:48] = letter[58:97] = letter[123:] = False
    wordy = np.where(points < 128, letter[np.minimum(points, 127)], True)
    wordy &= (points != 0xA0) & ~((points >= 0x2000) & (points < 0x2070)) & (points != 0x3000)
    # White space and marks are one kind of edge; runs of them are a single one.
    keep = wordy.copy()
    keep[1:] |= wordy[:-1] | (row[1:] != row[:-1])
    keep[:1] = True
    points, row, wordy = np.where(wordy, points, 32)[keep].astype(np.uint64), row[keep], wordy[keep]
    edges = np.concatenate([[0], np.cumsum(~wordy)])
    found = []
    for n in ORDERS:
        m = len(points) - n + 1
        if m <= 0:
            continue
        value = np.full(m, n, np.uint64)
        for j in range(n):
            value = value * np.uint64(0x9E3779B97F4A7C15) + points[j : j + m]
        inner = edges[n - 1 : n - 1 + m] - edges[1 : 1 + m]
        good = (inner == 0) & (row[:m] == row[n - 1 :])
        found.append((row[:m][good].astype(np.uint64) << np.uint64(18)) | (mix(value[good]) >> np.uint64(46)))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pairs = np.unique(np.concatenate(found))
    return (pairs & np.uint64(FEATURES - 1)).astype(np.int64), (pairs >> np.uint64(18)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((2, FEATURES), np.int64)
    for batch in batches:
        for block in text_blocks(batch, "text"):
            slots, row = features(block.column("text").to_pylist())
            toxic = block.column("toxic").to_numpy()[row]
            for c in (0, 1):
                total[c] += np.bincount(slots[toxic == c], minlength=FEATURES)
    at = np.flatnonzero(total.sum(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[0, at]), pa.array(total[1, at])], ["slot", "clean", "toxic"])


def _rows(place):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in text_blocks(batch, "text"):
                slots, row = features(block.column("text").to_pylist())
                at = place.value[slots]
                at, row = at[at >= 0].astype(np.uint16), row[at >= 0]
                bounds = np.searchsorted(row, np.arange(block.num_rows + 1))
                packed = [at[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [block.column("doc_id"), block.column("toxic"), pa.array(packed, pa.binary())], ["doc_id", "toxic", "slots"]
                )

    return run


def training_sample(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> tuple[DataFrame, float]:
    """Texts of the chosen labelled rows (doc_id, text, toxic), and the share of toxic ones among all usable labels.

    A label is usable if it is 0 or 1 and crc32 of its doc_id as text is not divisible by FOLDS.
    """
    usable = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    usable = usable.where(F.col("toxic").isin(0, 1) & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS != 0))
    share = usable.agg(F.avg("toxic")).first()[0]
    # An id with both labels counts as toxic.
    distinct = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id")
    # At most two times per_class ids, and one text of each, whatever rows share an id.
    chosen = distinct.where("toxic = 0").limit(per_class).union(distinct.where("toxic = 1").limit(per_class))
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    one = F.min_by(F.struct("text"), F.struct(F.xxhash64("text"), "text"))["text"].alias("text")
    return stored(texts.groupBy("doc_id", "toxic").agg(one).select("doc_id", "text", "toxic"), "toxic-sample"), share or 0.0


def fit(sample: DataFrame, share: float) -> Model:
    """Without texts of both classes the score is the share of toxic labels."""
    spark = sample.sparkSession
    sample = sample.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "toxic")
    counts = map_batches(sample, _count, "slot bigint, clean bigint, toxic bigint").groupBy("slot").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")
    ).toPandas()  # at most FEATURES rows
    slot = counts["slot"].to_numpy()
    clean, toxic = np.zeros(FEATURES), np.zeros(FEATURES)
    clean[slot], toxic[slot] = counts["clean"], counts["toxic"]
    n = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    odds = np.log(max(share, 1e-6) / max(1 - share, 1e-6))
    if not n.get(0) or not n.get(1):
        return Model(np.zeros(FEATURES, np.float32), float(odds))
    ratio = np.log((toxic + 1) / (toxic.sum() + FEATURES)) - np.log((clean + 1) / (clean.sum() + FEATURES))
    p, q = toxic / n[1], clean / n[0]
    middle = (toxic + clean) / (n[0] + n[1])
    apart = np.abs(p - q) / np.sqrt(np.maximum(middle * (1 - middle), 1e-6))
    apart[toxic + clean < 3] = 0
    picked = np.sort(np.argsort(-apart, kind="stable")[:SELECTED])
    place = np.full(FEATURES, -1, np.int32)
    place[picked] = np.arange(len(picked))
    shared = spark.sparkContext.broadcast(place)
    rows = map_batches(sample, _rows(shared), "doc_id bigint, toxic int, slots binary").collect()  # at most 2 * PER_CLASS
    rows.sort(key=lambda r: (r["doc_id"], r["toxic"], r["slots"]))
    at = [np.frombuffer(r["slots"], np.uint16) for r in rows]
    label = np.array([r["toxic"] for r in rows], float)
    weight = np.where(label > 0, 0.5 / n[1], 0.5 / n[0])
    item = np.repeat(np.arange(len(rows)), [len(a) for a in at])
    w, bias = _logistic(np.concatenate(at).astype(np.int64), item, ratio[picked], label, weight, 0.0)
    weights = np.zeros(FEATURES, np.float32)
    weights[picked] = w * ratio[picked]
    _give_back_memory()
    return Model(weights, bias)


def _give_back_memory() -> None:
    """The driver goes on with other stages: what the fit has used returns to the system where that can be asked for."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass


def _logistic(at, item, ratio, label, weight, bias) -> tuple[np.ndarray, float]:
    """Weighted logistic regression on the scaled features, by Adam over all rows."""
    values = ratio[at]
    w = np.zeros(len(ratio) + 1)
    w[-1] = bias
    one, two = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, ROUNDS + 1):
        z = w[-1] + np.bincount(item, values * w[at], len(label))
        error = weight * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - label)
        slope = np.append(np.bincount(at, values * error[item], len(ratio)) + DECAY * w[:-1], error.sum())
        one, two = 0.9 * one + 0.1 * slope, 0.99 * two + 0.01 * slope**2
        w -= 0.05 * (one / (1 - 0.9**step)) / (np.sqrt(two / (1 - 0.99**step)) + 1e-8)
    return w[:-1], float(w[-1])


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in text_blocks(batch, "text"):
                slots, row = features(block.column("text").to_pylist())
                scores = model.value.score(slots, row, block.num_rows)
                yield pa.RecordBatch.from_arrays([block.column("row"), pa.array(scores)], ["row", "score"])

    return run


def score(docs: DataFrame, labels: DataFrame, text: str = "text", id_column: str = "doc_id", keep: tuple[str, ...] | None = None) -> DataFrame:
    """``row`` (the columns ``keep``, or all, as a struct) and ``score``, higher where the label 1 is likelier.

    The score depends on the text alone; NULL counts as empty and gets the score of a text without features. Rows without
    id are scored and never used for the fit. Repeated rows get equal scores; an empty table gives an empty result.
    """
    named = docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"))
    model = docs.sparkSession.sparkContext.broadcast(fit(*training_sample(named, labels)))
    given, kind = packed(docs, keep, text=text)
    given = given.select("row", F.coalesce("text", F.lit("")).alias("text"))
    return map_batches(given, _score(model), f"row {kind}, score double")


def drop_toxic(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows scored 0.5 or higher; columns as given."""
    return score(docs, labels, **options).where(F.col("score") < 0.5).select("row.*")


def digest_columns(scored: DataFrame) -> DataFrame:
    held_out = F.crc32(F.col("row.doc_id").cast("string").cast("binary")) % FOLDS == 0
    return scored.select(
        F.col("row.doc_id").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
