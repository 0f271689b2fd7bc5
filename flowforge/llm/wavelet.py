"""Token ids as wavelet matrices: succinct bit-planes with rank and select.

A shard holds the ids of consecutive documents as 16 bit-planes, the highest
bit first. Each plane keeps the order that a stable partition by the plane
above gave, so ``access``, ``count`` and ``locate`` need only ranks in planes
and no other copy of the ids. Layout of a shard (little-endian): magic, number
of ids, number of documents, doc ids with a null flag each, ids per document,
then for each plane its number of zeros, its packed bits and the ones before
every block of 512 bits.

``encode_shards`` writes documents in ascending (doc_id, text) order, a null
doc_id first; a null text is empty (its only id is the end id); repeated rows
are documents of their own; columns beyond doc_id and text are ignored; an
empty table gives no shard. Texts of any length are encoded whole.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowforge.llm.common import bounded_batches, string_bytes, text_or_empty
from flowforge.llm.tokens import encoder

MAGIC = b"WVM1"
BITS = 16
BLOCK = 512
#: Offsets of at most so many shards are broadcast (a few MB).
MOST_OFFSETS = 100_000


class WaveletMatrix:
    """One sequence of ids below 2^16 under access, counting and lookup."""

    def __init__(self, n: int, planes: list[tuple[int, np.ndarray, np.ndarray]]) -> None:
        self.n, self.planes = n, planes

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        now, planes = ids.astype(np.uint16), []
        for bit in range(BITS - 1, -1, -1):
            ones = (now & np.uint16(1 << bit)) != 0
            packed = np.packbits(ones, bitorder="little")
            low = now[~ones]
            planes.append((len(low), packed, cls._directory(packed)))
            now = np.concatenate([low, now[ones]])
        return cls(len(ids), planes)

    @staticmethod
    def _directory(packed: np.ndarray) -> np.ndarray:
        per = np.zeros(-(-len(packed) // (BLOCK // 8)) * (BLOCK // 8), np.uint8)
        per[:len(packed)] = packed
        counts = np.bitwise_count(per.view("<u8")).reshape(-1, BLOCK // 64).sum(1, dtype=np.uint32)
        return np.concatenate([[0], np.cumsum(counts)]).astype("<u4")

    def to_bytes(self) -> list[bytes]:
        out = []
        for zeros, packed, ones in self.planes:
            out += [struct.pack("<I", zeros), packed.tobytes(), ones.tobytes()]
        return out

    @classmethod
    def from_bytes(cls, buf: memoryview, at: int, n: int) -> WaveletMatrix:
        size, blocks = -(-n // 8), -(-(-(-n // 8)) // (BLOCK // 8)) + 1
        planes = []
        for _ in range(BITS):
            (zeros,) = struct.unpack_from("<I", buf, at)
            packed = np.frombuffer(buf, np.uint8, size, at + 4)
            planes.append((zeros, packed, np.frombuffer(buf, "<u4", blocks, at + 4 + size)))
            at += 4 + size + 4 * blocks
        return cls(n, planes)

    def _rank1(self, plane: int, i: int) -> int:
        _, packed, ones = self.planes[plane]
        block, byte = i // BLOCK, i // 8
        r = int(ones[block]) + int(np.bitwise_count(packed[block * (BLOCK // 8):byte]).sum())
        return r + (int(packed[byte]) & ((1 << (i % 8)) - 1)).bit_count() if i % 8 else r

    def _bit(self, plane: int, i: int) -> int:
        return int(self.planes[plane][1][i >> 3]) >> (i & 7) & 1

    def _select(self, plane: int, bit: int, k: int) -> int:
        """Position of the k-th (from 0) such bit: bisect on its rank."""
        low, high = 0, self.n
        while low < high:
            mid = (low + high) // 2
            ones = self._rank1(plane, mid + 1)
            if (ones if bit else mid + 1 - ones) > k:
                high = mid
            else:
                low = mid + 1
        return low

    def access(self, i: int) -> int:
        value = 0
        for p in range(BITS):
            bit, one = self._bit(p, i), self._rank1(p, i)
            value = value << 1 | bit
            i = self.planes[p][0] + one if bit else i - one
        return value

    def _range(self, value: int, low: int, high: int) -> tuple[int, int]:
        for p in range(BITS):
            a, b = self._rank1(p, low), self._rank1(p, high)
            if value >> (BITS - 1 - p) & 1:
                low, high = self.planes[p][0] + a, self.planes[p][0] + b
            else:
                low, high = low - a, high - b
        return low, high

    def count(self, value: int, low: int = 0, high: int | None = None) -> int:
        a, b = self._range(value, low, self.n if high is None else high)
        return b - a

    def locate(self, value: int) -> list[int]:
        """All positions of a value, ascending: select back up the planes."""
        a, b = self._range(value, 0, self.n)
        found = []
        for i in range(a, b):
            for p in range(BITS - 1, -1, -1):
                bit, zeros = value >> (BITS - 1 - p) & 1, self.planes[p][0]
                i = self._select(p, bit, i - zeros if bit else i)
            found.append(i)
        return sorted(found)

    def decode(self) -> np.ndarray:
        """All ids: undo the partitions from the lowest plane up."""
        now = np.zeros(self.n, np.uint16)
        for p in range(BITS - 1, -1, -1):
            zeros, packed, _ = self.planes[p]
            ones = np.unpackbits(packed, count=self.n, bitorder="little").view(bool)
            up = np.empty(self.n, np.uint16)
            up[~ones] = now[:zeros]
            up[ones] = now[zeros:] | np.uint16(1 << (BITS - 1 - p))
            now = up
        return now


def shard_bytes(doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray) -> bytes:
    known = np.array([d is not None for d in doc_ids], np.uint8)
    values = np.array([d or 0 for d in doc_ids], "<i8")
    return b"".join([MAGIC, struct.pack("<QI", len(ids), len(doc_ids)), known.tobytes(), values.tobytes(),
                     counts.astype("<u4").tobytes(), *WaveletMatrix.build(ids).to_bytes()])


def open_shard(data: bytes) -> tuple[list[int | None], np.ndarray, WaveletMatrix]:
    buf = memoryview(data)
    if bytes(buf[:4]) != MAGIC:
        raise ValueError("not a wavelet shard")
    n, docs = struct.unpack_from("<QI", buf, 4)
    at = 16
    known = np.frombuffer(buf, np.uint8, docs, at)
    values = np.frombuffer(buf, "<i8", docs, at + docs)
    counts = np.frombuffer(buf, "<u4", docs, at + 9 * docs).astype(np.int64)
    return [int(v) if k else None for v, k in zip(values, known, strict=True)], counts, \
        WaveletMatrix.from_bytes(buf, at + 13 * docs, n)


def encode_shards(docs: DataFrame, tokenizer: str, end_id: int, shard_ids: int = 1 << 20) -> DataFrame:
    """One row per shard: part, shard (in order), n_ids, data. Documents are
    dealt by ranges of doc_id, so shards follow the order of doc_id; a doc_id
    that many rows share is dealt further by its text's hash. A shard is closed
    at the document that brings it to ``shard_ids`` ids or more."""
    bounded_batches(docs.sparkSession)
    keyed = docs.select("doc_id", text_or_empty().alias("text")).withColumn("_h", F.xxhash64("text"))
    dealt = keyed.repartitionByRange("doc_id", "_h").sortWithinPartitions("doc_id", "_h", "text").drop("_h")
    out = pa.schema([("part", pa.int32()), ("shard", pa.int64()), ("n_ids", pa.int64()), ("data", pa.binary())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, shard = encoder(tokenizer, True), TaskContext.get().partitionId(), 0
        names: list = []
        counts: list = []
        held: list = []
        size = 0

        def close():
            nonlocal names, counts, held, size, shard
            data = shard_bytes(names, np.concatenate(counts), np.concatenate(held))
            row = pa.record_batch([pa.array([part], pa.int32()), pa.array([shard]), pa.array([size]),
                                   pa.array([data], pa.binary())], schema=out)
            names, counts, held, size, shard = [], [], [], 0, shard + 1
            return row

        for batch in batches:
            ids, n = enc.encode(*string_bytes(batch.column(1)), end_id)
            doc_ids, to, a = batch.column(0).to_pylist(), np.cumsum(n), 0
            while a < len(n):
                done = int(to[a - 1]) if a else 0
                b = min(len(n), int(np.searchsorted(to, done + shard_ids - size)) + 1)
                names += doc_ids[a:b]
                counts.append(n[a:b])
                held.append(ids[done:to[b - 1]])
                size += int(to[b - 1]) - done
                a = b
                if size >= shard_ids:
                    yield close()
        if names:
            yield close()

    return dealt.mapInArrow(encode, "part int, shard bigint, n_ids bigint, data binary")


def write_shards(docs: DataFrame, path: str, tokenizer: str, end_id: int, shard_ids: int = 1 << 20) -> None:
    """The shards as a table of blobs at ``path`` (any place Spark can write)."""
    encode_shards(docs, tokenizer, end_id, shard_ids).write.option("compression", "none").parquet(path)


def read_documents(shards: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids
    (little-endian unsigned 32-bit), decoded from shards. Shard offsets are
    running sums: inside each part, then over the parts' totals."""
    sizes = shards.select("part", "shard", "n_ids")
    few = sizes.count() <= MOST_OFFSETS
    inside = Window.partitionBy("part").orderBy("shard")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("_t"))
    parts = parts.select("part", (F.sum("_t").over(Window.orderBy("part")) - F.col("_t")).alias("_p"))
    bases = sizes.withColumn("_s", F.sum("n_ids").over(inside) - F.col("n_ids")) \
        .join(parts, "part").select("part", "shard", (F.col("_p") + F.col("_s")).alias("_base"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, shard, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                         batch.column(2), strict=True):
                doc_ids, counts, matrix = open_shard(data.as_buffer())
                ids, to = matrix.decode().astype("<u4"), np.cumsum(counts)
                offs = np.concatenate([[0], to * 4]).astype(np.int64)
                blob = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), [
                    None, pa.py_buffer(offs), pa.py_buffer(ids)]).cast(pa.binary())
                yield pa.record_batch([pa.array([part] * len(counts), pa.int32()), pa.array([shard] * len(counts)),
                                       pa.array(doc_ids, pa.int64()), pa.array(to - counts), pa.array(counts), blob],
                                      names=["part", "shard", "doc_id", "_at", "n_tokens", "ids"])

    rows = shards.select("part", "shard", "data").mapInArrow(
        decode, "part int, shard bigint, doc_id bigint, _at bigint, n_tokens bigint, ids binary")
    # two dozen bytes a shard: broadcast while their number is bounded, so that
    # the decoded ids stay where they are
    return rows.join(F.broadcast(bases) if few else bases, ["part", "shard"]).select(
        "doc_id", (F.col("_base") + F.col("_at")).alias("start"), "n_tokens", "ids")
