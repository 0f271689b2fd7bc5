"""Helpers shared by the operators: byte-level word scanning and hashing in
numpy, ASCII word patterns, the shared folder.

A *word* is a maximal run of characters other than the space and the control
characters 9 to 13 (``[^\\x20\\x09-\\x0D]+``); all of them are single bytes in
UTF-8, so words are found on the bytes of an Arrow string column directly.
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowforge.session import checkpoint_dir

WORD = r"[^\x20\x09-\x0D]+"

_SEP = np.zeros(256, bool)
_SEP[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Odd multipliers of the two hash families (any odd 64-bit numbers do).
_MUL = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the session's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table into the shared folder and read it back: cuts the lineage
    and survives the loss of executors."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def ship(spark: SparkSession) -> None:
    """Give the workers this package: Spark's file server hands out a zip of
    the sources, once per application."""
    sc = spark.sparkContext
    if _SHIPPED.get("app") == sc.applicationId:
        return
    root = Path(__file__).resolve().parents[1]
    zipped = Path(tempfile.mkdtemp(prefix="flowforge-")) / "flowforge.zip"
    with zipfile.ZipFile(zipped, "w") as out:
        for f in sorted(root.rglob("*.py")):
            out.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(zipped))
    _SHIPPED["app"] = sc.applicationId


_SHIPPED: dict[str, str] = {}


def bounded_batches(spark: SparkSession, rows: int = 2000) -> None:
    """To be called before any Python stage: ships the package and bounds the
    Arrow batches, so that long texts cannot fill a worker."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", 32 << 20)


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col), F.lit(""))


def mix(h: np.ndarray, family: int = 0) -> np.ndarray:
    h = h ^ (h >> np.uint64(30))
    h *= _MIX[family]
    h ^= h >> np.uint64(27)
    h *= _MUL[1 - family]
    h ^= h >> np.uint64(31)
    return h


def string_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes and the row offsets of a null-free string column."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    kind = np.int64 if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type) else np.int32
    _, offs, data = col.buffers()
    if len(col) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    offs = np.frombuffer(offs, kind)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[offs[0]:offs[-1]], offs - offs[0]


def scan_words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and each row's first word number."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    word = ~_SEP[data]
    cut = np.zeros(n + 1, bool)
    cut[offs] = True
    before = np.empty(n, bool)
    before[0] = True
    np.logical_not(word[:-1], out=before[1:])
    before |= cut[:n]
    starts = np.flatnonzero(word & before)
    after = np.empty(n, bool)
    after[-1] = True
    np.logical_not(word[1:], out=after[:-1])
    after |= cut[1:]
    ends = np.flatnonzero(word & after) + 1
    return starts, ends, np.searchsorted(starts, offs)


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, family: int = 0) -> np.ndarray:
    """A 64-bit hash of each word: its bytes are absorbed eight at a time."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))
    left = ends - starts
    h = left.astype(np.uint64) * _MUL[family]
    at, rows = starts, None
    while True:
        part = eights[at]
        short = left < 8
        part = np.where(short, part & ((np.uint64(1) << (np.minimum(left, 7).astype(np.uint64) * np.uint64(8)))
                                       - np.uint64(1)), part)
        if rows is None:
            h = mix(h ^ part, family)
        else:
            h[rows] = mix(h[rows] ^ part, family)
        more = np.flatnonzero(left > 8)
        if not len(more):
            return h
        rows = more if rows is None else rows[more]
        at, left = at[more] + 8, left[more] - 8


def lowered(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z in lower case (other bytes unchanged)."""
    return _LOWER[data]


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int, family: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get(family)
    if have is None or len(have[0]) < n:
        base, size = int(_MUL[family]), max(n, 1 << 16)
        inverse = pow(base, -1, 1 << 64)
        up = np.full(size, base, np.uint64)
        down = np.full(size, inverse, np.uint64)
        up[0] = down[0] = 1
        have = (np.multiply.accumulate(up), np.multiply.accumulate(down))
        if size <= 1 << 22:
            _POWERS[family] = have
    return have[0][:n], have[1][:n]


def hash_windows(words: np.ndarray, width: int, family: int = 0) -> np.ndarray:
    """Hash of each run of ``width`` consecutive word hashes (rolling: prefix
    sums of hash * B^i modulo 2^64, brought to a common power)."""
    n = len(words)
    if n < width:
        return np.zeros(0, np.uint64)
    up, down = _powers(n + 1, family)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(words * up[:n], out=total[1:])
    return mix((total[width:] - total[:-width]) * down[:n - width + 1], family)


def row_slices(offs: np.ndarray, most: int = 4 << 20):
    """Runs of rows of about ``most`` bytes (one row at least)."""
    a, n = 0, len(offs) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offs, offs[a] + most, "right")) - 1)
        yield a, min(b, n)
        a = min(b, n)
