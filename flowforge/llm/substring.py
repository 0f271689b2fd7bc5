"""Substring dedup: repeated word windows, by a count-min prefilter.

Pass 1 counts the documents of every window of ``width`` words in a count-min
sketch: each task counts its own windows and emits the sketch as sorted cells, the tasks' sketches
are merged cell range by cell range, and one bit per cell says "two or more".
Pass 2 keeps the windows whose every cell says so; counts are never too low, so
no repeated window is lost. These windows alone are grouped exactly, by 96 bits of
two independent hashes of their words: a window is a repeat if its group starts
in a smaller doc_id. A task settles its own rows first: of the rows of a window
only those of its smallest doc_id go into the shuffle, so that a passage in very
many documents gives a row per task, not a row per document.

The sketch grows with the text up to ``most_cells`` a row, a bound on what is
broadcast (``most_cells`` / 8 bytes a row). Beyond it the filter lets more
unrepeated windows through, which only costs shuffle: the exact pass decides.

Null texts have no words. Rows with one doc_id are judged alike: a window that
also starts in another row of the same doc_id is no repeat. A null doc_id is
neither smaller nor larger than another: such rows lose nothing. Documents with
fewer than ``width`` words are kept whole. Extra columns are carried along.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowforge.llm.common import (
    bounded_batches, hash_windows, hash_words, row_slices, scan_words, string_bytes, text_or_empty)

ROWS = 2  # hash rows of the sketch
RANGES = 64  # cell ranges of a row, merged apart
LEAST_CELLS = 1 << 12
HELD = 1 << 23  # windows a task holds before it emits a part of its sketch


def _gaps(cells: np.ndarray) -> bytes:
    """Sorted distinct cells as byte gaps; 255 means "255 more, go on"."""
    gap = np.diff(cells.astype(np.int64), prepend=-1) - 1
    more = gap // 255
    out = np.full(int(more.sum()) + len(gap), 255, np.uint8)
    out[np.cumsum(more + 1) - 1] = gap % 255
    return out.tobytes()


def _cells(gaps: bytes) -> np.ndarray:
    raw = np.frombuffer(gaps, np.uint8)
    ends = raw != 255
    return np.cumsum(raw, dtype=np.int64)[ends] + np.arange(int(ends.sum()))


def sketch_cell(window: np.ndarray, row: int, cells: int) -> np.ndarray:
    """Cell of a window hash in one row (``cells`` is a power of two, 2^31 at most)."""
    return (window >> np.uint64(32 * row)) & np.uint64(cells - 1)


def text_windows(data: np.ndarray, offs: np.ndarray, width: int, families: int):
    """For runs of rows: window hashes, the row and the word number in the row
    of each window, and a hash of each row's whole text."""
    for a, b in row_slices(offs):
        part, at = data[offs[a]:offs[b]], offs[a:b + 1] - offs[a]
        starts, ends, first = scan_words(part, at)
        hashes = [hash_words(part, starts, ends, f) for f in range(families)]
        n = np.diff(first)
        row = np.repeat(np.arange(b - a), n)
        count = max(0, len(starts) - width + 1)
        whole = row[:count] == row[width - 1:] if count else np.zeros(0, bool)
        keep = np.flatnonzero(whole)
        yield a, [hash_windows(h, width, f)[keep] for f, h in enumerate(hashes)], row[keep], keep - first[row[keep]]


def count_min(texts: DataFrame, width: int, cells: int, per_row: bool = False) -> np.ndarray:
    """Merged sketch of all windows as bits: [row, cell / 8], set where the
    count is two or more. ``per_row``: a row counts a window once."""
    span = cells // RANGES

    def emit(held: list[np.ndarray]) -> pa.RecordBatch:
        windows = np.concatenate(held)
        keys, once, twice = [], [], []
        for row in range(ROWS):
            cell = np.sort(sketch_cell(windows, row, cells).astype(np.uint32))
            new = np.ones(len(cell), bool)
            new[1:] = cell[1:] != cell[:-1]
            many = np.zeros(len(cell), bool)
            many[:-1] = new[:-1] & ~new[1:]
            at = np.searchsorted(cell, np.arange(RANGES + 1, dtype=np.uint32) * np.uint32(span))
            for r in range(RANGES):
                s = slice(at[r], at[r + 1])
                local = cell[s] - np.uint32(r * span)
                keys.append(row * RANGES + r)
                once.append(_gaps(local[new[s] & ~many[s]]))
                twice.append(_gaps(local[many[s]]))
        return pa.record_batch([pa.array(keys, pa.int32()), pa.array(once, pa.binary()), pa.array(twice, pa.binary())],
                               names=["range", "once", "twice"])

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for _, (windows,), row, _ in text_windows(*string_bytes(batch.column(0)), width, 1):
                if per_row and len(row):
                    ends = np.append(np.flatnonzero(np.diff(row)) + 1, len(row))
                    windows = np.concatenate([np.unique(w) for w in np.split(windows, ends[:-1])])
                held.append(windows)
                size += len(windows)
                if size >= HELD:
                    yield emit(held)
                    held, size = [], 0
        if size:
            yield emit(held)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, counts = None, np.zeros(span, np.uint8)

        def done() -> pa.RecordBatch:
            return pa.record_batch([pa.array([now], pa.int32()), pa.array(
                [np.packbits(counts >= 2, bitorder="little").tobytes()], pa.binary())], names=["range", "bits"])

        for batch in batches:
            for key, once, twice in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != now:
                    if now is not None:
                        yield done()
                    now = key
                    counts[:] = 0
                cell = _cells(once)
                counts[cell] = np.minimum(counts[cell] + 1, 2)
                counts[_cells(twice)] = 2
        if now is not None:
            yield done()

    parts = texts.select("text").mapInArrow(sketch, "range int, once binary, twice binary")
    merged = parts.repartition("range").sortWithinPartitions("range").mapInArrow(merge, "range int, bits binary")
    bits = np.zeros((ROWS, cells // 8), np.uint8)
    for r in merged.collect():
        row, part = divmod(r["range"], RANGES)
        bits[row, part * span // 8:(part + 1) * span // 8] = np.frombuffer(r["bits"], np.uint8)
    return bits


def repeated_windows(docs: DataFrame, width: int = 50, most_cells: int = 1 << 28) -> DataFrame:
    """doc_id, text_hash and starts: the word numbers at which repeated windows
    start, one row per document that has any. (doc_id, text_hash) names a row's
    document: equal rows share it."""
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    cells = max(LEAST_CELLS, min(most_cells, 1 << (size // 4).bit_length()))
    sketch = spark.sparkContext.broadcast(count_min(rows.where("doc_id is not null"), width, cells, per_row=True))
    keyed = rows.where("doc_id is not null").select(F.col("doc_id").cast("long"), "text", F.hash("text"))

    def estimated(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
        """Runs of candidate rows, sorted by window and doc_id: h1, h2, doc_id,
        text_hash, at, and whether a smaller doc_id of the run has the window."""
        bits, held, size = sketch.value, [], 0

        def run() -> list[np.ndarray]:
            cols = [np.concatenate(c) for c in zip(*held, strict=True)]
            order = np.lexsort((cols[2], cols[1], cols[0]))
            h1, h2, doc, text, at = (c[order] for c in cols)
            new = np.ones(len(h1), bool)
            new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            least = doc[np.flatnonzero(new)][np.cumsum(new) - 1] if len(doc) else doc
            return [h1, h2, doc, text, at, doc > least]

        for batch in batches:
            ids, hashes = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            for base, (h1, h2), row, at in text_windows(*string_bytes(batch.column(1)), width, 2):
                keep = np.ones(len(h1), bool)
                for r in range(ROWS):
                    cell = sketch_cell(h1, r, cells)
                    keep &= (bits[r][cell >> np.uint64(3)] >> (cell & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
                row = row[keep] + base
                held.append((h1[keep].view(np.int64), (h2[keep] >> np.uint64(32)).astype(np.uint32).view(np.int32),
                             ids[row], hashes[row], at[keep].astype(np.int32)))
                size += len(row)
                if size >= HELD // 4:
                    yield run()
                    held, size = [], 0
        if size:
            yield run()

    def unsettled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for *cols, settled in estimated(batches):
            yield pa.record_batch([pa.array(c[~settled]) for c in cols], names=["h1", "h2", "doc_id", "text_hash", "at"])

    def settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, doc, text, at, known in estimated(batches):
            yield pa.record_batch([pa.array(c[known]) for c in (doc, text, at)], names=["doc_id", "text_hash", "at"])

    least = F.min("doc_id").over(Window.partitionBy("h1", "h2"))
    found = keyed.mapInArrow(unsettled, "h1 bigint, h2 int, doc_id bigint, text_hash int, at int") \
        .withColumn("least", least).where("doc_id > least").select("doc_id", "text_hash", "at")
    own = keyed.mapInArrow(settled, "doc_id bigint, text_hash int, at int")
    return found.union(own).groupBy("doc_id", "text_hash").agg(F.collect_set("at").alias("starts"))


def remove_repeats(docs: DataFrame, width: int = 50, most_cells: int = 1 << 28) -> DataFrame:
    """``docs`` with ``kept_text`` (the words left, joined by one space),
    ``n_words`` and ``n_removed``: every word that a repeated window covers is
    removed, judged on the input. Texts cross the one shuffle compressed."""
    names = [c for c in docs.columns if c not in ("text", "kept_text", "n_words", "n_removed")]
    repeats = repeated_windows(docs, width, most_cells).select(
        F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), "starts")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col("doc_id").cast("long").alias("id"),
                       F.hash(text_or_empty()).alias("hash"), "text")
    row_type = rows.schema["row"].dataType.simpleString()

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [None if not t.is_valid else t.as_buffer().to_pybytes() for t in batch.column(3)]
            small = [None if t is None else zlib.compress(t, 1) for t in raw]
            yield pa.record_batch([*batch.columns[:3], pa.array(small, pa.binary())], names=["row", "id", "hash", "z"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n_words, n_removed, kept = [], [], [], []
            for small, starts in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                text = None if small is None else zlib.decompress(small)
                words = (text or b"").split()
                n_words.append(len(words))
                if starts.is_valid:
                    begin = starts.values.to_numpy()
                    change = np.bincount(begin, minlength=len(words) + 1) \
                        - np.bincount(begin + width, minlength=len(words) + 1)
                    words = [words[i] for i in np.flatnonzero(np.cumsum(change)[:-1] == 0)]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words).decode())
                texts.append(None if text is None else text.decode())
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.string()), pa.array(kept, pa.string()),
                                   pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())],
                                  names=["row", "text", "kept_text", "n_words", "n_removed"])

    joined = rows.mapInArrow(squeeze, f"row {row_type}, id bigint, hash int, z binary") \
        .join(repeats, ["id", "hash"], "left").select("row", "z", "starts")
    out = joined.mapInArrow(cut, f"row {row_type}, text string, kept_text string, n_words bigint, n_removed bigint")
    own = [F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns if c in names or c == "text"]
    return out.select(*own, "kept_text", "n_words", "n_removed")
