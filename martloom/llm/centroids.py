"""Exact k-means on integer vectors by Shallot search.

Vectors are packed into blocks once and stored in buckets. Per vector a small state stays beside them: its centroid, the one that
was second-nearest, an upper bound on the distance to the first and a lower bound on the distance to all others. A round

1. moves the bounds by how far the centroids moved; a vector whose bounds leave no other centroid is done without arithmetic;
2. else computes the distance to its centroid and, if that settles nothing, to the second-nearest; the closer one is where
   the scan starts;
3. scans that one's neighbours, the other centroids in ascending distance from it, as far as the sum of the distance from
   the vector to the start and to the best second so far. Each centroid met may shrink that ball;
4. compares all it meets by their integer squared distances, ties by the centroid's number.

Bounds are floating-point numbers with a margin for rounding, so they can only make a round look at more. Each task adds the vectors
of its centroids as integers. A block meets its state in a join of equal buckets, so vectors are shuffled and written once.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.common import map_batches, stored
from martloom.session import scratch_path

SCALE = 1024
BLOCK_ROWS = 1024
# Squared distances of vectors within this range fit 64-bit integers for up to 2^7 components.
_SMALL = 1 << 27
_MARGIN = 1e-9
# Sums are handed to Spark in two parts, each of which fits a decimal.
_HALF = 64
_LARGEST = 1 << 170


@dataclass
class Centroids:
    """Integer centroids, how far each moved last, and every one's neighbours by distance."""

    points: list[list[int]]
    moved: np.ndarray
    order: np.ndarray
    gaps: np.ndarray

    @staticmethod
    def of(points: list[list[int]], before: list[list[int]] | None = None) -> Centroids:
        k = len(points)
        gaps = np.array([[_length(p, q) for q in points] for p in points]).reshape(k, k)
        apart = gaps + np.diag(np.full(k, np.inf))
        order = np.argsort(apart, axis=1, kind="stable")[:, : k - 1]
        moved = np.array([_length(p, q) for p, q in zip(points, before, strict=True)]) if before else np.zeros(k)
        return Centroids(points, moved, order, np.take_along_axis(gaps, order, axis=1))


def _length(p: list[int], q: list[int]) -> float:
    return float(sum((a - b) ** 2 for a, b in zip(p, q, strict=True))) ** 0.5


def fixed_point(column: pa.Array, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows that have exactly so many finite components, and those components as integers floor(1024 x).

    The integers are 64-bit where all are small enough for exact 64-bit distances, else Python's own.
    """
    sizes = pa.compute.fill_null(pa.compute.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(sizes == dimensions)
    flat = column.take(pa.array(rows)).flatten()
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(rows), dimensions)
    good = np.isfinite(values).all(axis=1)
    rows, values = rows[good], values[good]
    if values.size and np.abs(values).max() * SCALE >= _SMALL:
        whole = np.array([[math.floor(SCALE * Fraction(v)) for v in row] for row in values.tolist()], object).reshape(values.shape)
        if max(abs(v) for v in whole.flat) >= _LARGEST:
            raise ValueError(f"a component beyond 2^{_LARGEST.bit_length() - 11}")
        return rows, whole
    return rows, np.floor(values * SCALE).astype(np.int64)


def _pack(whole: np.ndarray) -> bytes:
    """Little-endian 32-bit integers where they fit, else decimal text."""
    if whole.dtype == np.int64:
        return b"i" + whole.astype(np.int32).tobytes()
    return b"t" + ",".join(map(str, whole.flat)).encode()


def _unpack(raw: bytes, dimensions: int) -> np.ndarray:
    if raw[:1] == b"i":
        return np.frombuffer(raw, np.int32, offset=1).astype(np.int64).reshape(-1, dimensions)
    return np.array([int(v) for v in raw[1:].decode().split(",")], object).reshape(-1, dimensions)


def _wide_enough(whole: np.ndarray, centroids: list[list[int]]) -> np.ndarray:
    """Python's integers where a centroid is too large for 64-bit distances."""
    large = any(abs(v) >= _SMALL for point in centroids for v in point)
    return whole.astype(object) if large else whole


def _squared(points: np.ndarray, targets: np.ndarray) -> np.ndarray:
    gap = points - targets
    return (gap * gap).sum(axis=1)


def _root(squared: np.ndarray) -> np.ndarray:
    return np.sqrt(squared.astype(np.float64))


def search(points: np.ndarray, first: np.ndarray, second: np.ndarray, upper: np.ndarray, lower: np.ndarray, at: Centroids) -> int:
    """Bring the states of ``points`` up to date in place; returns how many distances were computed."""
    k = len(at.points)
    if k == 1:
        return 0
    target = np.array(at.points, points.dtype)
    apart = at.gaps[:, 0] / 2
    top = np.argsort(at.moved)[-2:]
    # The largest move of a centroid other than a vector's own.
    others = np.where(first == top[-1], at.moved[top[0]], at.moved[top[-1]])
    upper[:] = (upper + at.moved[first]) * (1 + _MARGIN)
    lower[:] = lower - others - _MARGIN * (lower + others)
    open_ = np.flatnonzero(~(upper < np.maximum(lower, apart[first] * (1 - _MARGIN))))
    near = _squared(points[open_], target[first[open_]])
    work = len(open_)
    upper[open_] = _root(near) * (1 + _MARGIN)
    still = ~(upper[open_] < np.maximum(lower[open_], apart[first[open_]] * (1 - _MARGIN)))
    open_, near = open_[still], near[still]
    if not len(open_):
        return work
    one, two = first[open_].copy(), second[open_].copy()
    far = _squared(points[open_], target[two])
    work += len(open_)
    swap = (far < near) | ((far == near) & (two < one))
    one[swap], two[swap] = two[swap], one[swap]
    near[swap], far[swap] = far[swap], near[swap]
    start, reach = one.copy(), _root(near)
    seen = two.copy()
    alive = np.arange(len(open_))
    for step in range(k - 1):
        # The ball shrinks as soon as a nearer second is known.
        inside = at.gaps[start[alive], step] * (1 - _MARGIN) <= (reach[alive] + _root(far[alive])) * (1 + _MARGIN)
        alive = alive[inside]
        if not len(alive):
            break
        other = at.order[start[alive], step]
        fresh = other != seen[alive]
        a, c = alive[fresh], other[fresh]
        distance = _squared(points[open_[a]], target[c])
        work += len(a)
        best = (distance < near[a]) | ((distance == near[a]) & (c < one[a]))
        runner = ~best & ((distance < far[a]) | ((distance == far[a]) & (c < two[a])))
        b = a[best]
        two[b], far[b] = one[b], near[b]
        one[b], near[b] = c[best], distance[best]
        r = a[runner]
        two[r], far[r] = c[runner], distance[runner]
    first[open_], second[open_] = one, two
    upper[open_], lower[open_] = _root(near) * (1 + _MARGIN), _root(far) * (1 - _MARGIN)
    return work


_STATE = np.dtype([("first", "<i4"), ("second", "<i4"), ("upper", "<f8"), ("lower", "<f8")])
_SUMS = "array<struct<cluster:int,part:int,high:decimal(38,0),low:decimal(38,0)>>"


def _round(at: Centroids, dimensions: int):
    """New states of all blocks; a task's last block carries the sums of the vectors of every centroid (part -1 is their number)."""
    kind = pa.list_(pa.struct([("cluster", pa.int32()), ("part", pa.int32()), ("high", pa.decimal128(38, 0)), ("low", pa.decimal128(38, 0))]))
    k = len(at.points)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts, held = [[0] * dimensions for _ in range(k)], [0] * k, None
        for batch in batches:
            for block, vectors, raw in zip(*[batch.column(c).to_pylist() for c in ("block", "vectors", "state")], strict=True):
                points = _wide_enough(_unpack(vectors, dimensions), at.points)
                if raw is None:
                    state = np.zeros(len(points), _STATE)
                    state["second"], state["upper"] = min(1, k - 1), np.inf
                else:
                    state = np.frombuffer(raw, _STATE).copy()
                search(points, *[state[c] for c in _STATE.names], at)
                for c in np.unique(state["first"]):
                    mine = points[state["first"] == c]
                    counts[c] += len(mine)
                    sums[c] = [s + int(t) for s, t in zip(sums[c], mine.sum(axis=0), strict=True)]
                if held:
                    yield _state_row(*held, None, kind)
                held = block, state.tobytes()
        if held:
            total = []
            for c in range(k):
                for part, value in ((-1, counts[c]), *enumerate(sums[c])):
                    total.append({"cluster": c, "part": part, "high": value >> _HALF, "low": value & ((1 << _HALF) - 1)})
            yield _state_row(*held, total, kind)

    return run


def _state_row(block: int, state: bytes, sums: list | None, kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([state], pa.binary()), pa.array([sums], kind)], ["block", "state", "sums"])


def _blocks(dimensions: int):
    """Kept vectors of a task in blocks; the names of all blocks differ."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, size = TaskContext.get().partitionId() << 32, 0
        ids, parts = [], []

        def done() -> pa.RecordBatch:
            kind = np.int64 if all(p.dtype == np.int64 for p in parts) else object
            whole = np.concatenate([p.astype(kind) for p in parts])
            return pa.RecordBatch.from_arrays(
                [pa.array([name], pa.int64()), pa.array([[i for part in ids for i in part]], pa.list_(pa.int64())), pa.array([_pack(whole)], pa.binary())],
                ["block", "ids", "vectors"],
            )

        for batch in batches:
            rows, whole = fixed_point(batch.column("vector"), dimensions)
            names = batch.column("id").take(pa.array(rows)).to_pylist()
            at = 0
            while at < len(rows):
                take = min(BLOCK_ROWS - size, len(rows) - at)
                ids.append(names[at : at + take])
                parts.append(whole[at : at + take])
                at, size = at + take, size + take
                if size == BLOCK_ROWS:
                    yield done()
                    name, size, ids, parts = name + 1, 0, [], []
        if size:
            yield done()

    return run


def _bucketed(df: DataFrame, name: str, buckets: int) -> str:
    """Store in buckets of ``block`` in the shared folder and return the table's name."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    table = f"{name}_{uuid.uuid4().hex}"
    df.write.format("parquet").bucketBy(buckets, "block").sortBy("block").option("path", path).saveAsTable(table)
    return table


def _seeds(blocks: DataFrame, k: int, seed: int, dimensions: int) -> list[list[int]]:
    """The k vectors whose ids have the least hashes; a missing id comes last, equal ids by their vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, vectors in zip(batch.column("ids").to_pylist(), batch.column("vectors").to_pylist(), strict=True):
                whole = _unpack(vectors, dimensions)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([",".join(map(str, w)) for w in whole], pa.string())], ["id", "vector"])

    named = map_batches(blocks, run, "id bigint, vector string")
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256)
    chosen = named.orderBy(order.asc_nulls_last(), "vector").limit(k).collect()
    return [[int(v) for v in r["vector"].split(",")] for r in chosen]


def _next(points: list[list[int]], state: DataFrame) -> list[list[int]]:
    """Componentwise floor of the mean of each centroid's vectors; one without vectors stays."""
    sums = state.where(F.col("sums").isNotNull()).select(F.explode("sums").alias("s")).select("s.*")
    whole = sums.groupBy("cluster", "part").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
    found = {(r["cluster"], r["part"]): (int(r["high"]) << _HALF) + int(r["low"]) for r in whole.collect()}
    return [
        [found[c, part] // found[c, -1] for part in range(len(point))] if found.get((c, -1)) else point for c, point in enumerate(points)
    ]


def _measured(points: list[list[int]], dimensions: int):
    """Every vector with its centroid and the squared distance to it, as a decimal number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, vectors, raw in zip(*[batch.column(c).to_pylist() for c in ("ids", "vectors", "state")], strict=True):
                whole, first = _wide_enough(_unpack(vectors, dimensions), points), np.frombuffer(raw, _STATE)["first"]
                distance = _squared(whole, np.array(points, whole.dtype)[first])
                fits = [int(d) if d < 1 << 63 else None for d in distance] if distance.dtype == object else distance
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(first, pa.int32()), pa.array(fits, pa.int64())], ["id", "cluster", "distance"])

    return run


@dataclass
class Clustering:
    """``vectors`` (id, cluster, distance) and the final centroids."""

    vectors: DataFrame
    centroids: list[list[int]]


def _forget(spark: SparkSession, table: str | None) -> None:
    """Take a table out of the session's catalog; its files stay in the shared folder."""
    if table:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def cluster(
    vectors: DataFrame, dimensions: int, k: int, rounds: int, seed: int, id_column: str = "vec_id", vector: str = "embedding",
    seen: Callable[[int, list[list[int]]], None] | None = None,
) -> Clustering:
    """k-means of all vectors with exactly ``dimensions`` finite components; others are left out.

    Components become floor(1024 x). Centroids start as the vectors whose ids have the least hashes. A round assigns each vector to the
    nearest centroid, the smaller number in a tie, and replaces each centroid that has vectors by the floor of their mean; at the
    end they are assigned once more. With fewer vectors than ``k`` there are as many centroids as vectors. Ids may be missing or
    repeated: every row is a vector of its own. A squared distance beyond 64 bits is NULL; a component beyond 2^160 is an
    error. An empty table gives an empty result. ``seen`` is told each round's number and centroids.
    """
    spark = vectors.sparkSession
    given = vectors.select(F.col(f"`{id_column}`").cast("bigint").alias("id"), F.col(f"`{vector}`").alias("vector"))
    blocks = stored(map_batches(given, _blocks(dimensions), "block bigint, ids array<bigint>, vectors binary"), "blocks")
    points = _seeds(blocks, k, seed, dimensions)
    if not points:
        return Clustering(spark.createDataFrame([], "id bigint, cluster int, distance bigint"), [])
    buckets = max(1, min(blocks.count(), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    held = _bucketed(blocks.repartition(buckets, "block"), "vectors", buckets)
    before: list[list[int]] | None = None
    state_table: str | None = None
    for turn in range(rounds + 1):
        at = Centroids.of(points, before)
        if state_table:
            # Equal buckets meet without a shuffle; the hint keeps the plan so at every size.
            met = spark.table(held).drop("ids").join(spark.table(state_table).drop("sums").hint("merge"), "block")
        else:
            met = spark.table(held).select("block", "vectors", F.lit(None).cast("binary").alias("state"))
        state = map_batches(met, _round(at, dimensions), f"block bigint, state binary, sums {_SUMS}")
        newer = _bucketed(state, "state", buckets)
        _forget(spark, state_table)
        state_table = newer
        if turn < rounds:
            before, points = points, _next(points, spark.table(state_table))
            if seen:
                seen(turn, points)
    met = spark.table(held).join(spark.table(state_table).drop("sums").hint("merge"), "block")
    out = stored(map_batches(met.select("ids", "vectors", "state"), _measured(points, dimensions), "id bigint, cluster int, distance bigint"), "clusters")
    for table in (state_table, held):
        _forget(spark, table)
    return Clustering(out, points)


def digest_columns(found: Clustering) -> DataFrame:
    """Each vector with its cluster's and the whole inertia and its centroid's digest. The joined side has one row per centroid."""
    vectors = found.vectors
    per = vectors.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()
    whole = sum(r["cluster_inertia"] or 0 for r in per)
    rows = [(r["cluster"], r["cluster_inertia"], whole, ",".join(map(str, found.centroids[r["cluster"]]))) for r in per]
    told = vectors.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, components string")
    told = told.select("cluster", "cluster_inertia", "inertia", F.sha2(F.col("components").cast("binary"), 256).alias("centroid_sha256"))
    return vectors.withColumnRenamed("id", "vec_id").join(F.broadcast(told), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
