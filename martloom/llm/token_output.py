"""Token ids in compressed files: an adaptive context-mixing range coder over ids.

A file row is a segment: whole documents in ascending id order, their ids one after the other, cut into blocks of BLOCK ids.
Each block is coded on its own with a fresh model and carries a checksum. The model of a block mixes three predictions:

* order 2: the id that last followed the same two ids, order 1: the id that last followed the same id, each with a count of
  how often it was right in a row; how much of the probability the two get is adapted separately for each pair of counts;
* order 0: frequencies of ids in the whole segment, kept before its blocks in about a byte for each id; in a small segment those
  of groups of neighbouring ids. One step of the coder for an id, whatever the size of the vocabulary.

The range coder works on integers only. All blocks of a segment are coded side by side, one id of each block per step, so a
step is a few array operations. Coding and decoding run the same model code. A block needs the table of its segment and no other block.

Format of a segment (little-endian): magic, version, numbers of documents, ids and digits, then for each document its id
(int64), whether that is missing (uint8) and its number of ids (uint64), a checksum of all that, number of bytes (uint32) and
checksum (uint32) of the table, and for each block its number of coded bytes (uint32) and the checksum of its ids (uint32); then
the table and the coded bytes of all blocks.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martloom.llm.common import map_batches, text_blocks
from martloom.llm.pretokens import Pieces, block_pieces, held_pieces
from martloom.session import scratch_path

MAGIC, VERSION = b"MLTOKENS", 2
BLOCK = 2048
# Ids after which a segment is closed.
SEGMENT = 1 << 22
END_ID = 1

# Probabilities of choices are in units of 2^-BITS, those of groups of ids in units of 2^-GROUP_BITS.
BITS, GROUP_BITS = 14, 20
_ONE = 1 << BITS
_SLOT_BITS = 11
# What is coded first: the order-2 id, the order-1 id, or neither. A row has the upper bounds of the first two, in 16 bits each; the
# step towards what was seen keeps each of the three at least _CHOICE_LEAST wide.
_CHOICE_RATE, _CHOICE_LEAST = 5, 32
_CONFIDENCE = 7
_WINDOW, _RENEW = 40, 24
# A table of ids has at most so many groups, and one for so many ids of the segment; an id's place in its group takes pieces of PIECE bits.
_GROUPS, _IDS_A_GROUP, _PIECE = 1 << 16, 16, 12


class _Encoder:
    """Range coder of many lanes. Carries go into the 16-bit digits already written and are settled at the end."""

    def __init__(self, lanes: int, steps: int) -> None:
        self.low, self.range = np.zeros(lanes, np.int64), np.full(lanes, 1 << _WINDOW, np.int64)
        self.digits = np.zeros((lanes, 64 + steps // 2), np.uint32)
        self.used = np.zeros(lanes, np.int64)

    def lanes(self, lane) -> tuple:
        return lane, self.low[lane], self.range[lane]

    def code(self, state: tuple, start: np.ndarray, size: np.ndarray | int, bits: int = BITS) -> tuple:
        lane, low, width = state
        width = width >> bits
        low = low + width * start
        width *= size
        full = np.flatnonzero(width < (1 << _RENEW))
        if len(full):
            at = full if isinstance(lane, slice) else lane[full]
            used = self.used[at]
            if int(used.max()) + 8 > self.digits.shape[1]:
                self.digits = np.concatenate([self.digits, np.zeros_like(self.digits)], axis=1)
            moved = low[full]
            self.digits[at, used] = moved >> _RENEW
            self.used[at] = used + 1
            low[full] = (moved & ((1 << _RENEW) - 1)) << 16
            width[full] <<= 16
        return lane, low, width

    def store(self, state: tuple) -> None:
        lane, self.low[lane], self.range[lane] = state[0], state[1], state[2]

    def finish(self) -> list[bytes]:
        lane = np.arange(len(self.low))
        self.digits = np.concatenate([self.digits, np.zeros((len(lane), 4), np.uint32)], axis=1)
        # The 40 bits of the window: two whole digits and half of a third.
        for part in (self.low >> 24, (self.low >> 8) & 0xFFFF, (self.low & 0xFF) << 8):
            self.digits[lane, self.used] = part
            self.used += 1
        for j in range(self.digits.shape[1] - 1, 0, -1):
            self.digits[:, j - 1] += self.digits[:, j] >> np.uint32(16)
            self.digits[:, j] &= np.uint32(0xFFFF)
        small = self.digits.astype("<u2")
        return [small[i, : self.used[i]].tobytes() for i in lane]


class _Decoder:
    def __init__(self, coded: list[bytes]) -> None:
        sizes = [len(c) // 2 for c in coded]
        self.digits = np.zeros((len(coded), max(sizes, default=0) + 8), np.int64)
        for i, c in enumerate(coded):
            self.digits[i, : sizes[i]] = np.frombuffer(c, "<u2")
        # Digits as they come in: half of one and half of the next, since the window holds two and a half.
        self.digits[:, 2:-1] = ((self.digits[:, 2:-1] & 0xFF) << 8) | (self.digits[:, 3:] >> 8) if len(coded) else 0
        first = np.array([int.from_bytes(np.frombuffer(c, "<u2")[:3].astype(">u2").tobytes(), "big") >> 8 for c in coded], np.int64)
        self.range, self.value = np.full(len(coded), 1 << _WINDOW, np.int64), first
        self.next = np.full(len(coded), 2, np.int64)

    def lanes(self, lane) -> tuple:
        return lane, self.value[lane], self.range[lane]

    @staticmethod
    def target(state: tuple, bits: int = BITS) -> np.ndarray:
        # Both are below 2^40 and the quotient is below 2^21, so this division is exact enough for its floor.
        return np.minimum(state[1] / (state[2] >> bits), (1 << bits) - 1).astype(np.int64)

    def code(self, state: tuple, start: np.ndarray, size: np.ndarray | int, bits: int = BITS) -> tuple:
        lane, value, width = state
        width = width >> bits
        value = value - width * start
        width *= size
        full = np.flatnonzero(width < (1 << _RENEW))
        if len(full):
            at = full if isinstance(lane, slice) else lane[full]
            following = self.next[at]
            value[full] = (value[full] << 16) | self.digits[at, following]
            self.next[at] = following + 1
            width[full] <<= 16
        return lane, value, width

    def store(self, state: tuple) -> None:
        lane, self.value[lane], self.range[lane] = state[0], state[1], state[2]


class _Groups:
    """Order 0: how often each group of 2^shift neighbouring ids occurs in the segment. Stored as one byte a group, about its logarithm."""

    def __init__(self, table: bytes) -> None:
        self.table, self.shift = table, table[0]
        code = np.frombuffer(zlib.decompress(table[1:]), np.uint8).astype(np.int64)
        sizes = np.where(code < 4, code, (4 + (code & 3)) << np.maximum((code >> 2) - 1, 0))
        ends = (np.cumsum(sizes) << GROUP_BITS) // sizes.sum()
        self.size = np.diff(ends, prepend=0)
        self.start = ends - self.size

    @classmethod
    def of(cls, ids: np.ndarray, digits: int) -> _Groups:
        bits = min(4 * digits, _GROUPS.bit_length() - 1, max(len(ids) // _IDS_A_GROUP, 1).bit_length() - 1)
        shift = 4 * digits - bits
        n = np.bincount(ids >> np.uint32(shift), minlength=1 << bits)
        # Whole counts of 19 bits in all, at least 1 for what occurs; the two bits after the first one are kept.
        n = np.where(n > 0, np.maximum((n << (GROUP_BITS - 1)) // len(ids), 1), 0)
        down = np.maximum(np.frexp(n)[1] - 3, 0)
        code = np.where(n < 4, n, ((down + 1) << 2) | ((n >> down) & 3))
        return cls(bytes([shift]) + zlib.compress(code.astype(np.uint8).tobytes()))

    def rest(self) -> list[tuple[int, int]]:
        """(shift, bits) of the pieces of an id's place in its group."""
        return [(max(top - _PIECE, 0), min(top, _PIECE)) for top in range(self.shift, 0, -_PIECE)]


class _Model:
    def __init__(self, lanes: int, groups: _Groups, decodes: bool) -> None:
        self.groups = groups
        self.group_at = np.repeat(np.arange(len(groups.size), dtype=np.uint32), groups.size) if decodes else None
        self.one, self.two = np.zeros(lanes << _SLOT_BITS, np.uint32), np.zeros(lanes << _SLOT_BITS, np.uint32)
        self.choice = np.full(lanes * 128, (_ONE // 4) | (_ONE // 2) << 16, np.uint32)
        self.last, self.hash1, self.hash2 = (np.zeros(lanes, np.uint32) for _ in range(3))
        self.slots, self.contexts = np.arange(lanes) << _SLOT_BITS, np.arange(lanes) * 128

    def step(self, n: int, ids: np.ndarray | None, coder) -> np.ndarray:
        """Code ``ids`` of the first n lanes, or decode them if there are none."""
        hash1 = self.hash1[:n]
        slot1 = self.slots[:n] + (hash1 >> np.uint32(32 - _SLOT_BITS))
        slot2 = self.slots[:n] + ((hash1 + self.hash2[:n]) >> np.uint32(32 - _SLOT_BITS))
        entry1, entry2 = self.one.take(slot1), self.two.take(slot2)
        guess1, guess2 = entry1 >> np.uint32(3), entry2 >> np.uint32(3)
        sure1, sure2 = entry1 & np.uint32(7), entry2 & np.uint32(7)
        context = self.contexts[:n] + ((guess1 == guess2) * np.uint32(64) + (sure2 << np.uint32(3)) + sure1)
        chances = self.choice.take(context).view(np.int32)
        first, second = chances & 0xFFFF, chances >> 16
        state = coder.lanes(slice(0, n))
        if ids is None:
            target = coder.target(state)
            hit2, neither = target < first, target >= second
            is_one = ~(hit2 | neither)
        else:
            hit2 = ids == guess2
            is_one = (ids == guess1) & ~hit2
            neither = ~(hit2 | is_one)
        start = np.where(hit2, 0, np.where(is_one, first, second))
        end = np.where(hit2, first, np.where(is_one, second, _ONE))
        coder.store(coder.code(state, start, end - start))
        first += (np.where(hit2, _ONE - 2 * _CHOICE_LEAST, _CHOICE_LEAST) - first) >> _CHOICE_RATE
        second += (np.where(neither, 2 * _CHOICE_LEAST, _ONE - _CHOICE_LEAST) - second) >> _CHOICE_RATE
        self.choice[context] = (first | second << 16).view(np.uint32)
        out = np.where(hit2, guess2, guess1) if ids is None else ids
        plain = np.flatnonzero(neither)
        if len(plain):
            found = self._by_group(plain, None if ids is None else ids[plain], coder)
            if ids is None:
                out[plain] = found
        fresh = out << np.uint32(3)
        self.one[slot1] = np.where(out == guess1, entry1 + (sure1 < _CONFIDENCE), fresh)
        self.two[slot2] = np.where(out == guess2, entry2 + (sure2 < _CONFIDENCE), fresh)
        np.multiply(self.last[:n], np.uint32(0x85EBCA6B), out=self.hash2[:n])
        self.last[:n] = out
        np.multiply(out, np.uint32(0x9E3779B1), out=hash1)
        return out

    def _by_group(self, lane: np.ndarray, ids: np.ndarray | None, coder) -> np.ndarray:
        groups, state = self.groups, coder.lanes(lane)
        group = self.group_at.take(coder.target(state, GROUP_BITS)) if ids is None else ids >> np.uint32(groups.shift)
        state = coder.code(state, groups.start.take(group), groups.size.take(group), GROUP_BITS)
        done = group
        for shift, bits in groups.rest():
            part = coder.target(state, bits).astype(np.uint32) if ids is None else (ids >> np.uint32(shift)) & np.uint32((1 << bits) - 1)
            state = coder.code(state, part.astype(np.int64), 1, bits)
            done = (done << np.uint32(bits)) | part
        coder.store(state)
        return done


def encode_blocks(ids: np.ndarray, digits: int, block: int = BLOCK) -> list[bytes]:
    """The table of groups, then each block of ids on its own; all but the last have ``block`` ids."""
    n = -(-len(ids) // block)
    if not n:
        return []
    padded = np.zeros(n * block, np.uint32)
    padded[: len(ids)] = ids
    padded = np.ascontiguousarray(padded.reshape(n, block).T)
    tail = len(ids) - (n - 1) * block
    groups = _Groups.of(ids, digits)
    model, coder = _Model(n, groups, False), _Encoder(n, block)
    for t in range(block if n > 1 else tail):
        live = n if t < tail else n - 1
        model.step(live, padded[t, :live], coder)
    return [groups.table, *coder.finish()]


def decode_blocks(coded: list[bytes], total: int, digits: int, block: int = BLOCK) -> np.ndarray:
    n = len(coded) - 1
    if n < 1:
        return np.zeros(0, np.uint32)
    out = np.zeros((block, n), np.uint32)
    tail = total - (n - 1) * block
    model, coder = _Model(n, _Groups(coded[0]), True), _Decoder(coded[1:])
    for t in range(block if n > 1 else tail):
        live = n if t < tail else n - 1
        out[t, :live] = model.step(live, None, coder)
    return np.ascontiguousarray(out.T).reshape(-1)[:total]


@dataclass
class Segment:
    doc_ids: list
    sizes: np.ndarray
    ids: np.ndarray  # uint32, all documents one after the other


def pack(segment: Segment, digits: int) -> bytes:
    missing = np.array([d is None for d in segment.doc_ids], np.uint8)
    names = np.array([0 if d is None else d for d in segment.doc_ids], "<i8")
    head = MAGIC + struct.pack("<IQQI", VERSION, len(names), len(segment.ids), digits)
    head += names.tobytes() + missing.tobytes() + segment.sizes.astype("<u8").tobytes()
    coded = encode_blocks(segment.ids, digits)
    sums = [zlib.crc32(segment.ids[i : i + BLOCK].astype("<u4").tobytes()) for i in range(0, len(segment.ids), BLOCK)]
    sums = [zlib.crc32(c) for c in coded[:1]] + sums
    index = np.array([[len(c), s] for c, s in zip(coded, sums, strict=True)], "<u4").tobytes()
    return head + struct.pack("<I", zlib.crc32(head)) + index + b"".join(coded)


def unpack(data: bytes) -> Segment:
    """The segment; raises ValueError where a checksum does not hold."""
    fixed = len(MAGIC) + struct.calcsize("<IQQI")
    version, docs, total, digits = struct.unpack("<IQQI", data[len(MAGIC) : fixed])
    if data[: len(MAGIC)] != MAGIC or version != VERSION:
        raise ValueError("not a token segment of this version")
    end = fixed + docs * 17
    if struct.unpack("<I", data[end : end + 4])[0] != zlib.crc32(data[:end]):
        raise ValueError("checksum of the document index does not hold")
    names = np.frombuffer(data, "<i8", docs, fixed)
    missing = np.frombuffer(data, np.uint8, docs, fixed + 8 * docs)
    sizes = np.frombuffer(data, "<u8", docs, fixed + 9 * docs).astype(np.int64)
    blocks = -(-total // BLOCK)
    rows = blocks + (blocks > 0)
    index = np.frombuffer(data, "<u4", 2 * rows, end + 4).reshape(rows, 2).astype(np.int64)
    bounds = end + 4 + 8 * rows + np.concatenate([[0], np.cumsum(index[:, 0])]).astype(np.int64)
    coded = [data[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    if coded and zlib.crc32(coded[0]) != index[0, 1]:
        raise ValueError("checksum of the table of ids does not hold")
    ids = decode_blocks(coded, total, digits)
    for i in range(blocks):
        if zlib.crc32(ids[i * BLOCK : (i + 1) * BLOCK].astype("<u4").tobytes()) != index[i + 1, 1]:
            raise ValueError(f"checksum of block {i} does not hold")
    return Segment([None if m else int(d) for d, m in zip(names, missing, strict=True)], sizes, ids)


def block_ids(column: pa.Array, pieces: Pieces, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts of a block, each with the end id, and the number of ids of each."""
    block = block_pieces(column, pieces)
    code, bounds, wholes = block.code, block.bounds, block.wholes
    starts = np.cumsum(block.sizes) - block.sizes
    per_token = block.sizes[code] if len(code) else np.zeros(0, np.int64)
    before = np.concatenate([[0], np.cumsum(per_token)])
    per_row = before[bounds[1:]] - before[bounds[:-1]]
    for row, whole in wholes.items():
        per_row[row] = len(whole)
    out = np.full(int(per_row.sum()) + len(per_row), end_id, np.uint32)
    row_start = np.cumsum(per_row + 1) - (per_row + 1)
    shift = np.repeat(row_start - before[bounds[:-1]], np.diff(bounds))
    target = before[:-1] + shift
    inner = np.arange(int(per_token.sum())) - np.repeat(before[:-1], per_token)
    out[np.repeat(target, per_token) + inner] = block.flat[np.repeat(starts[code], per_token) + inner] if len(code) else 0
    for row, whole in wholes.items():
        out[row_start[row] : row_start[row] + len(whole)] = whole
    return out, per_row + 1


def _write(tokenizer, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = held_pieces(tokenizer.value)
        digits = -(-max(int(pieces.library.get_vocab_size(with_added_tokens=True)) - 1, end_id, 1).bit_length() // 4)
        shard, number = TaskContext.get().partitionId(), 0
        names: list = []
        sizes: list[np.ndarray] = []
        ids: list[np.ndarray] = []

        def close() -> pa.RecordBatch:
            segment = Segment(names, np.concatenate(sizes), np.concatenate(ids))
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int64()), pa.array([number], pa.int64()), pa.array([len(segment.ids)], pa.int64()),
                 pa.array([pack(segment, digits)], pa.binary())], ["shard", "segment", "n_ids", "data"],
            )

        for batch in batches:
            for block in text_blocks(batch, "text"):
                found, per_row = block_ids(block.column("text"), pieces, end_id)
                names += block.column("doc_id").to_pylist()
                sizes.append(per_row)
                ids.append(found)
                if sum(map(len, ids)) >= SEGMENT:
                    yield close()
                    names, sizes, ids, number = [], [], [], number + 1
        if names:
            yield close()

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, text: str = "text", id_column: str = "doc_id", end_id: int = END_ID) -> None:
    """Write the ids of all texts in ascending id order as Parquet rows (shard, segment, n_ids, data).

    NULL counts as empty: the end id alone. Rows without id come first; rows with equal ids are ordered by text. An empty
    table gives an empty file set. A failed task is repeated whole, and only finished tasks leave files.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        tokenizer = docs.sparkSession.sparkContext.broadcast(file.read())
    rows = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # The second key splits an id that very many rows share.
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("text")]
    dealt = rows.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    map_batches(dealt, _write(tokenizer, end_id), "shard bigint, segment bigint, n_ids bigint, data binary").write.parquet(path)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for shard, number, data in zip(batch.column("shard").to_pylist(), batch.column("segment").to_pylist(), batch.column("data"), strict=True):
            segment = unpack(data.as_py())
            ends = np.cumsum(segment.sizes)
            raw = segment.ids.astype("<u4")
            sums = [zlib.crc32(raw[a:b].tobytes()) for a, b in zip(ends - segment.sizes, ends, strict=True)]
            n = len(sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard] * n, pa.int64()), pa.array([number] * n, pa.int64()), pa.array(segment.doc_ids, pa.int64()),
                 pa.array(ends - segment.sizes, pa.int64()), pa.array(segment.sizes, pa.int64()), pa.array(sums, pa.int64())],
                ["shard", "segment", "doc_id", "inner", "n_tokens", "ids_crc32"],
            )


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, decoded from the files; ``start`` counts the ids before it."""
    files = spark.read.schema("shard bigint, segment bigint, n_ids bigint, data binary").parquet(path)
    shards = files.groupBy("shard").agg(F.sum("n_ids").alias("n")).orderBy("shard").collect()  # one row per written task
    before, total = [], 0
    for r in shards:
        before.append((r["shard"], total))
        total += r["n"]
    starts = spark.createDataFrame(before, "shard bigint, shard_start bigint")
    inner = F.sum("n_ids").over(Window.partitionBy("shard").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1))
    starts = files.select("shard", "segment", F.coalesce(inner, F.lit(0)).alias("before")).join(F.broadcast(starts), "shard")
    starts = starts.select("shard", "segment", (F.col("before") + F.col("shard_start")).alias("base"))
    found = map_batches(
        files.select("shard", "segment", "data"), _read, "shard bigint, segment bigint, doc_id bigint, inner bigint, n_tokens bigint, ids_crc32 bigint"
    )
    found = found.join(starts, ["shard", "segment"])
    return found.select("doc_id", (F.col("inner") + F.col("base")).alias("start"), "n_tokens", "ids_crc32")


def encode_and_read(docs: DataFrame, tokenizer_path: str, **options) -> DataFrame:
    """Write to the shared folder and return the index read back from there."""
    path = scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer_path, **options)
    return read_index(docs.sparkSession, path)
