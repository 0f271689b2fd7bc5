"""Quality classifier: random-indexing word vectors and a small network.

Words are hashed into ``BUCKETS`` buckets; a bucket's index vector is two signed
ones out of ``WIDTH`` places. A bucket's context vector is the sum of the index
vectors of the words within two places of its words, over all documents; log
damping, centring and unit length make it a word vector. A document's features
are the mean and the spread of its words' vectors and the log of its length: no
label, language, source or id. A two-layer numpy network is fitted on at most
about ``most_rows`` labelled rows (a sample by hash of doc_id); a fifth of them
sets a temperature that calibrates the probabilities. All else covers all rows.

A null or empty text has zero features and gets a score like any other. Labels:
null qualities are ignored, an id with contradicting labels teaches nothing, and
without usable labels every score is 0.5. A null doc_id is never held out.
Repeated rows are scored each; extra columns are carried along.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowforge.llm.common import (
    bounded_batches, hash_words, row_slices, scan_words, string_bytes, text_or_empty)

BUCKETS = 1 << 15
WIDTH = 32
REACH = 2
RANGES = 16


def _index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places [bucket, 2] and signs [bucket, 2] of the index vectors."""
    rng = np.random.default_rng(7)
    return rng.integers(WIDTH, size=(BUCKETS, 2)), rng.choice([-1.0, 1.0], size=(BUCKETS, 2))


def _buckets(data: np.ndarray, offs: np.ndarray, most: int):
    for a, b in row_slices(offs, most):
        part = data[offs[a]:offs[b]]
        starts, ends, first = scan_words(part, offs[a:b + 1] - offs[a])
        yield (hash_words(part, starts, ends) & np.uint64(BUCKETS - 1)).astype(np.int64), first


def context_vectors(docs: DataFrame) -> np.ndarray:
    """Sums over all documents, [bucket, place]; tasks add up their own, then
    one task per range of buckets adds the tasks' sums as they stream in."""
    span = BUCKETS // RANGES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = _index_vectors()
        total = np.zeros(BUCKETS * WIDTH)
        for batch in batches:
            for word, first in _buckets(*string_bytes(batch.column(0)), 4 << 20):
                row = np.repeat(np.arange(len(first) - 1), np.diff(first))
                cells, weights = [], []
                for gap in range(1, REACH + 1):
                    near = row[gap:] == row[:-gap]
                    for x, y in ((word[gap:][near], word[:-gap][near]), (word[:-gap][near], word[gap:][near])):
                        for k in (0, 1):
                            cells.append(x * WIDTH + places[y, k])
                            weights.append(signs[y, k])
                total += np.bincount(np.concatenate(cells), np.concatenate(weights), len(total))
        parts = total.astype(np.float32).reshape(RANGES, -1)
        yield pa.record_batch([pa.array(range(RANGES), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())],
                              names=["range", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, np.zeros(span * WIDTH)
        for batch in batches:
            for key, sums in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if key != now and now is not None:
                    yield pa.record_batch([pa.array([now], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                                          names=["range", "sums"])
                    total = np.zeros(span * WIDTH)
                now = key
                total = total + np.frombuffer(sums.as_buffer(), np.float32)
        if now is not None:
            yield pa.record_batch([pa.array([now], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                                  names=["range", "sums"])

    schema = "range int, sums binary"
    merged = docs.select(text_or_empty().alias("text")).mapInArrow(count, schema) \
        .repartition("range").sortWithinPartitions("range").mapInArrow(add, schema)
    sums = np.zeros((BUCKETS, WIDTH))
    for r in merged.collect():
        sums[r["range"] * span:(r["range"] + 1) * span] = np.frombuffer(r["sums"]).reshape(span, WIDTH)
    return sums


def word_vectors(sums: np.ndarray) -> np.ndarray:
    damped = np.sign(sums) * np.log1p(np.abs(sums))
    damped -= damped.mean(0)
    norm = np.linalg.norm(damped, axis=1, keepdims=True)
    return (damped / np.where(norm > 0, norm, 1)).astype(np.float32)


def pooled(vectors: np.ndarray, text: pa.Array) -> np.ndarray:
    """Features of each text: mean and spread of its word vectors, log length."""
    parts = []
    for word, first in _buckets(*string_bytes(text), 1 << 20):
        n = np.diff(first)
        some = n > 0
        mean = np.zeros((len(n), WIDTH), np.float32)
        square = np.zeros_like(mean)
        if len(word):
            x = vectors[word]
            mean[some] = np.add.reduceat(x, first[:-1][some], axis=0) / n[some, None]
            square[some] = np.add.reduceat(x * x, first[:-1][some], axis=0) / n[some, None]
        spread = np.sqrt(np.maximum(square - mean * mean, 0))
        parts.append(np.hstack([mean, spread, np.log1p(n)[:, None]]))
    return np.concatenate(parts).astype(float) if parts else np.zeros((0, 2 * WIDTH + 1))


class Network:
    """tanh layer, logistic output, temperature."""

    def __init__(self, hidden: int = 32, seed: int = 5) -> None:
        self.hidden, self.seed, self.temperature = hidden, seed, 1.0
        self.params: list[np.ndarray] = []
        self.shift = self.scale = np.zeros(0)

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.params
        return np.tanh((x - self.shift) / self.scale @ w1 + b1) @ w2 + b2

    def fit(self, x: np.ndarray, y: np.ndarray, aside: np.ndarray, epochs: int = 60, batch: int = 256,
            rate: float = 3e-3, decay: float = 1e-4) -> Network:
        """Adam on the rows not ``aside``, then the temperature that gives the
        rows aside the smallest log loss."""
        rng = np.random.default_rng(self.seed)
        self.shift, self.scale = x.mean(0), x.std(0) + 1e-6
        self.params = [rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], self.hidden)), np.zeros(self.hidden),
                       rng.normal(0, self.hidden ** -0.5, self.hidden), np.zeros(())]
        own, held = (x[~aside], y[~aside]), (x[aside], y[aside])
        if not len(own[0]):
            own = held
        z = (own[0] - self.shift) / self.scale
        first, second, step = [np.zeros_like(p) for p in self.params], [np.zeros_like(p) for p in self.params], 0
        for _ in range(epochs):
            order = rng.permutation(len(z))
            for a in range(0, len(z), batch):
                rows = order[a:a + batch]
                w1, b1, w2, b2 = self.params
                h = np.tanh(z[rows] @ w1 + b1)
                error = (1 / (1 + np.exp(-np.clip(h @ w2 + b2, -30, 30))) - own[1][rows]) / len(rows)
                back = error[:, None] * w2 * (1 - h * h)
                grads = [z[rows].T @ back + decay * w1, back.sum(0), h.T @ error + decay * w2, error.sum()]
                step += 1
                for i, g in enumerate(grads):
                    first[i] = 0.9 * first[i] + 0.1 * g
                    second[i] = 0.999 * second[i] + 0.001 * g * g
                    self.params[i] = self.params[i] - rate * (first[i] / (1 - 0.9 ** step)) / (
                        np.sqrt(second[i] / (1 - 0.999 ** step)) + 1e-8)
        if len(held[0]):
            logit = self.logits(held[0])
            loss = {t: float(np.logaddexp(0, -np.where(held[1] > 0.5, logit, -logit) / t).mean())
                    for t in np.geomspace(0.25, 8, 41)}
            self.temperature = min(loss, key=loss.__getitem__)
        return self

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -500, 500)))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, vectors, most_rows: int = 20_000) -> Network | None:
    """Fitted on labelled rows that are not held out, about ``most_rows`` at
    most: ids and features of this sample alone reach the driver, and its ids
    are the only table that is broadcast."""
    one = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(
        F.min("quality").alias("y"), F.max("quality").alias("z")).where("y = z") \
        .where(~held_out(F.col("doc_id"))).select("doc_id", F.col("y").cast("double"))
    n = one.count()
    part = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(min(1.0, most_rows / max(n, 1)) * (1 << 20))
    texts = docs.select("doc_id", text_or_empty().alias("text")).where(part).join(F.broadcast(one.where(part)), "doc_id")

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = pooled(vectors.value, batch.column(2))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array([r.tobytes() for r in x], pa.binary())],
                                  names=["doc_id", "y", "x"])

    sample = texts.select(F.col("doc_id").cast("long"), "y", "text").mapInArrow(pool, "doc_id bigint, y double, x binary")
    rows = sample.groupBy("doc_id").agg(F.min(F.struct("x", "y")).alias("r")).select("doc_id", "r.*").collect()
    if not rows:
        return None
    rows = sorted(rows)
    x = np.stack([np.frombuffer(r["x"]) for r in rows])
    ids = np.array([r["doc_id"] for r in rows], np.int64).view(np.uint64)
    aside = (ids * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % np.uint64(5) == 0
    return Network().fit(x, np.array([r["y"] for r in rows]), aside)


def score_quality(docs: DataFrame, labels: DataFrame, most_rows: int = 20_000, carry: list[str] | None = None) -> DataFrame:
    """The columns ``carry`` of ``docs`` (default: all) with held_out, score
    and predicted."""
    spark = docs.sparkSession
    bounded_batches(spark)
    vectors = spark.sparkContext.broadcast(word_vectors(context_vectors(docs)))
    model = spark.sparkContext.broadcast(train(docs, labels, vectors, most_rows))
    carry = [c for c in (carry or docs.columns) if c not in ("held_out", "score", "predicted")]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), text_or_empty().alias("text"),
                       held_out(F.col("doc_id")).alias("held_out"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = pooled(vectors.value, batch.column(1))
            p = model.value.probability(x) if model.value is not None else np.full(len(x), 0.5)
            yield pa.record_batch([batch.column(0), batch.column(2), pa.array(p)], names=["row", "held_out", "score"])

    row_type = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(score, f"row {row_type}, held_out boolean, score double").select(
        "row.*", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
