"""Packing by lexical retrieval: sequences of related documents, cut freely.

Documents are dealt by content: in the order of their heaviest shared terms they
are cut into ranges of about ``shard_ids`` ids, whatever file they came from (a
group of equal terms that is larger is cut by place). Each range is a shard with
a BM25 inverted index; a seed is scored with all its terms. A window starts with a seed document
(or the rest of one that the last window cut); when the seed ends, the index
returns its best unused neighbours, which fill the window greedily. A document
that does not fit is cut, and its rest opens the next window, so windows are
full. What is open at a shard's end is carried into the next shard; at a task's
end the last window is cut into runs whose lengths are powers of two, which
need no padding.

Document frequencies and the mean length come from all documents (bounded by
the vocabulary). A null text is empty (one piece with the end id); a repeated
row is a document of its own; columns beyond doc_id and text are ignored; an
empty table gives no pieces. Ties between neighbours go to the earlier document
of the shard. Ids must lie below 2^16.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowforge.llm.common import bounded_batches, stored, string_bytes, text_or_empty
from flowforge.llm.tokens import encoder, release

K1, B = 1.2, 0.75
VOCABULARY = 1 << 16
#: A term that one of so many documents of a shard holds has a weight for each of them.
DENSE = 8


class Terms:
    """Distinct terms of a document in order, with their counts: a sort of its
    ids, or for long documents marks in a table of the vocabulary."""

    LONG = 1 << 13

    def __init__(self) -> None:
        self.marked = np.zeros(VOCABULARY, bool)
        self.place = np.zeros(VOCABULARY, np.int32)

    @staticmethod
    def _sorted(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids in order, and the places where a new one begins."""
        ids = np.sort(ids, kind="stable")  # by digits, as they have 16 bits
        begins = np.ones(len(ids), bool)
        np.not_equal(ids[1:], ids[:-1], out=begins[1:])
        return ids, begins.nonzero()[0]

    def of(self, ids: np.ndarray) -> np.ndarray:
        if len(ids) < self.LONG:
            ids, begins = self._sorted(ids)
            return ids[begins].astype(np.int64)
        self.marked[ids] = True
        terms = np.flatnonzero(self.marked)
        self.marked[terms] = False
        return terms

    def counted(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(ids) < self.LONG:
            ids, begins = self._sorted(ids)
            return ids[begins].astype(np.int64), np.diff(begins, append=len(ids))
        terms = self.of(ids)
        self.place[terms] = np.arange(len(terms), dtype=np.int32)
        return terms, np.bincount(self.place[ids], minlength=len(terms))


class Index:
    """Inverted index of one shard: postings by term, terms by document.
    Documents that are used up leave the postings (``forget``)."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean_length: float) -> None:
        terms, docs_of, tfs, found = [], [], [], Terms()
        for i, ids in enumerate(docs):
            t, n = found.counted(ids)
            terms.append(t.astype(np.uint16))
            tfs.append(n)
            docs_of.append(np.full(len(t), i, np.int32))
        self.n = len(docs)
        self.first = np.cumsum([0, *map(len, terms)])
        self.term = np.concatenate(terms) if terms else np.zeros(0, np.uint16)
        doc = np.concatenate(docs_of) if docs else np.zeros(0, np.int32)
        tf = np.concatenate(tfs).astype(np.float32) if docs else np.zeros(0, np.float32)
        length = np.array([len(d) for d in docs], np.float32)
        norm = K1 * (1 - B + B * length / max(mean_length, 1e-9))
        weight = idf[self.term] * tf * (K1 + 1) / (tf + norm[doc])
        order = np.argsort(self.term, kind="stable")
        # as wide as the sums are made, so that a score converts nothing
        self.post_doc, self.post_weight = doc[order].astype(np.int64), weight[order].astype(float)
        self.row = np.full(VOCABULARY, -1, np.int64)  # of a common term in ``rows``
        self.at = np.searchsorted(self.term[order], np.arange(VOCABULARY + 1))
        self.column, self.rows = np.arange(self.n), np.zeros((0, self.n))
        common = np.flatnonzero(np.diff(self.at) * DENSE >= max(self.n, 1))
        if len(common):
            self._lay_out(common)

    def _lay_out(self, common: np.ndarray) -> None:
        """Take the terms that many documents hold out of the postings: a weight
        for every document of each, added up without looking up documents."""
        self.row[common] = np.arange(len(common))
        count = np.diff(self.at)
        row = np.repeat(self.row, count)
        dense = row >= 0
        self.rows = np.zeros((len(common), self.n))
        self.rows[row[dense], self.post_doc[dense]] = self.post_weight[dense]
        self.post_doc, self.post_weight = self.post_doc[~dense], self.post_weight[~dense]
        self.at = np.concatenate([np.zeros(1, np.int64), np.cumsum(np.where(self.row >= 0, 0, count))])

    def forget(self, used: np.ndarray) -> None:
        """Postings of the documents that are not used, in the same order."""
        keep = ~used[self.post_doc]
        self.at = np.concatenate([np.zeros(1, np.int64), np.cumsum(keep)])[self.at]
        self.post_doc, self.post_weight = self.post_doc[keep], self.post_weight[keep]
        keep = ~used[self.column]
        self.column, self.rows = self.column[keep], np.ascontiguousarray(self.rows[:, keep])

    def scores(self, seed: int) -> np.ndarray:
        """Scores of all documents that are not forgotten."""
        mine = self.term[self.first[seed]:self.first[seed + 1]]
        mine = mine.astype(np.int64)
        row, a = self.row[mine], self.at[mine]
        n = self.at[mine + 1] - a
        to = np.cumsum(n)
        where = np.repeat(a - (to - n), n)
        where += np.arange(len(where))
        score = np.bincount(self.post_doc[where], self.post_weight[where], self.n).astype(float, copy=False)  # of nothing: integers
        total = np.zeros(len(self.column))
        for r in row[row >= 0].tolist():
            total += self.rows[r]
        score[self.column] += total
        return score


def best_first(score: np.ndarray, some: int = 32) -> Iterator[int]:
    """Places of the positive scores, largest first (ties: the earlier place);
    only as many are sorted as are asked for, in growing portions."""
    while True:
        if some < len(score):
            left = np.flatnonzero(score >= np.partition(score, -some)[-some])
            left = left[score[left] > 0]
        else:
            left = np.flatnonzero(score > 0)
        yield from left[np.argsort(-score[left], kind="stable")].tolist()
        if some >= len(score) or not len(left):
            return
        score[left] = -1.0
        some *= 8


class Packer:
    """Fills windows over consecutive shards; ``out`` gets (document, start,
    length, sequence, offset)."""

    def __init__(self, width: int, idf: np.ndarray, mean_length: float) -> None:
        self.width, self.idf, self.mean_length = width, idf, mean_length
        self.sequence, self.fill = 0, 0
        self.open: list[tuple] = []  # pieces of the window that is not full yet
        self.out: list[tuple] = []

    def _place(self, doc, length: int) -> int:
        """Lay a whole document down across windows; ids left in the window
        that its end lies in."""
        start = 0
        while start < length:
            n = min(length - start, self.width - self.fill)
            self.open.append((doc, start, n, self.sequence, self.fill))
            self.fill += n
            start += n
            if self.fill == self.width:
                self.out += self.open
                self.open, self.fill, self.sequence = [], 0, self.sequence + 1
        return self.fill

    def shard(self, docs: list[tuple[object, np.ndarray]]) -> None:
        index = Index([ids for _, ids in docs], self.idf, self.mean_length)
        used = np.zeros(len(docs), bool)
        held = len(docs)  # documents in the postings
        for first in range(len(docs)):
            if used[first]:
                continue
            used[first] = True
            if not self._place(docs[first][0], len(docs[first][1])):
                continue
            # the window is open: its seed's neighbours go on; the one that the
            # window's end cuts is the seed of the next window, which its rest opens
            seed: int | None = first
            while seed is not None and self.fill and not used.all():
                left = len(docs) - np.count_nonzero(used)
                if left < held * 7 // 8:
                    index.forget(used)
                    held = left
                score = index.scores(seed)
                score[used] = -1.0
                seed = None
                for doc in best_first(score):
                    used[doc], window = True, self.sequence
                    self._place(docs[doc][0], len(docs[doc][1]))
                    if self.sequence != window:
                        seed = doc
                        break

    def close(self) -> None:
        """Cut the last window into runs with powers of two as lengths."""
        left = self.fill
        runs = [1 << i for i in range(left.bit_length() - 1, -1, -1) if left >> i & 1]
        pieces = [(doc, start, n) for doc, start, n, _, _ in self.open]
        for run in runs:
            at = 0
            while at < run:
                doc, start, n = pieces.pop(0)
                take = min(n, run - at)
                self.out.append((doc, start, take, self.sequence, at))
                if take < n:
                    pieces.insert(0, (doc, start + take, n - take))
                at += take
            self.sequence += 1
        self.open, self.fill = [], 0


def tokenized(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Written once into the shared folder: doc_id, ids (unsigned 16-bit) of
    every document and, from every task, one row with its document frequencies
    (doc_id null, df set)."""
    bounded_batches(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("df", pa.binary())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, df, any_row, terms = encoder(tokenizer, False), np.zeros(VOCABULARY, np.int64), False, Terms()
        for batch in batches:
            ids, n = enc.encode(*string_bytes(batch.column(1)), end_id)
            to = np.cumsum(n)
            for a, b in zip(to - n, to, strict=True):
                df[terms.of(ids[a:b])] += 1
            any_row = any_row or len(n) > 0
            blob = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(n), [
                None, pa.py_buffer(np.concatenate([[0], to * 2]).astype(np.int64)), pa.py_buffer(ids)])
            yield pa.record_batch([batch.column(0), blob.cast(pa.binary()), pa.nulls(len(n), pa.binary())],
                                  schema=schema)
        if any_row:
            yield pa.record_batch([pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()),
                                   pa.array([df.tobytes()], pa.binary())], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    return stored(rows.mapInArrow(encode, "doc_id bigint, ids binary, df binary"), "tokens")


def term_statistics(tokens: DataFrame) -> tuple[np.ndarray, int, float]:
    """Document frequency of every term, number of documents and mean length.
    Tasks add up their rows first; one number per term reaches the driver."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(VOCABULARY, np.int64)
        for batch in batches:
            for blob in batch.column(0):
                total += np.frombuffer(blob.as_buffer(), np.int64)
        term = np.flatnonzero(total)
        yield pa.record_batch([pa.array(term), pa.array(total[term])], names=["term", "n"])

    sums = tokens.where("df is not null").select("df").mapInArrow(add, "term bigint, n bigint") \
        .groupBy("term").agg(F.sum("n").alias("n"))
    df = np.zeros(VOCABULARY, np.int64)
    for row in sums.collect():
        df[row["term"]] = row["n"]
    n, length = tokens.where("ids is not null").agg(
        F.count(F.lit(1)), F.avg(F.octet_length("ids") / 2)).first()
    return df, n, length or 0.0


def content_key(t: np.ndarray, tf: np.ndarray, df: np.ndarray, idf: np.ndarray, least: int) -> int:
    """From a document's terms and their counts: the heaviest term that at least
    ``least`` documents hold, then the two heaviest that another document holds,
    as one number."""
    shared = df[t] > 1
    t, tf = t[shared].astype(np.int64), tf[shared]
    if not len(t):
        return 0
    weight = idf[t] * tf / (tf + K1)  # one document: its length changes little in the order
    first = int(weight.argmax())  # of equal ones the first, here and below
    common = np.where(df[t] >= least, weight, 0)
    top = [t[common.argmax() if common.any() else first], t[first]]
    if len(t) > 1:
        weight[first] = -1
        top.append(t[weight.argmax()])
    return sum(int(x) << 16 * (2 - i) for i, x in enumerate(top))


#: About so many documents a shard tell where ranges are cut.
TELLING = 256


def telling(rows: DataFrame, shard_ids: int) -> DataFrame:
    """The documents whose keys tell where ranges are cut: one of n ids with the
    chance n * TELLING / ``shard_ids``. Each one's own ids decide, whatever else
    the table holds and however large it is."""
    return rows.where(F.pmod(F.xxhash64("doc_id", "ids"), F.lit(max(1, shard_ids // TELLING))) < F.octet_length("ids") / 2)


def dealt_by_content(rows: DataFrame, df: np.ndarray, idf, least: int, parts: int, shard_ids: int) -> DataFrame:
    """doc_id and ids in ranges of the content key. The ranges are cut by a
    sample of the keys, which decides the split of the work only; ranges that a
    hot key fills share its rows by their place in the stored table, so repeated
    runs agree."""
    counts = rows.sparkSession.sparkContext.broadcast(df)

    def keyed(cuts: np.ndarray | None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            release()
            place, terms = TaskContext.get().partitionId() << 40, Terms()
            for batch in batches:
                keys = np.array([content_key(*terms.counted(np.frombuffer(blob.as_buffer(), np.uint16)), counts.value,
                                             idf.value, least) for blob in batch.column(1)], np.int64)
                places = np.arange(place, place + len(keys))
                place += len(keys)
                if cuts is None:
                    yield pa.record_batch([pa.array(keys)], names=["key"])
                    continue
                low, high = np.searchsorted(cuts, keys, "left"), np.searchsorted(cuts, keys, "right")
                part = low + places % (high - low + 1)
                yield pa.record_batch([batch.column(0), batch.column(1), pa.array(keys), pa.array(places),
                                       pa.array(part.astype(np.int32))], names=["doc_id", "ids", "key", "place", "part"])
        return run

    cuts = np.zeros(0, np.int64)
    if parts > 1:
        at = [i / parts for i in range(1, parts)]
        found = telling(rows, shard_ids).mapInArrow(keyed(None), "key bigint").agg(F.percentile_approx("key", at, 20 * parts)).first()[0]
        cuts = np.array(found or [], np.int64)
    dealt = rows.mapInArrow(keyed(cuts), "doc_id bigint, ids binary, key bigint, place bigint, part int")
    return dealt.repartitionById(parts, "part").sortWithinPartitions("key", "place").select("doc_id", "ids")


def pack(docs: DataFrame, tokenizer: str, end_id: int, width: int = 2048, shard_ids: int = 1 << 21) -> DataFrame:
    """Pieces: doc_id, start, length, doc_tokens, sequence_id, offset and ids
    (little-endian unsigned 32-bit)."""
    spark = docs.sparkSession
    tokens = tokenized(docs, tokenizer, end_id)
    df, n, mean_length = term_statistics(tokens)
    idf = spark.sparkContext.broadcast(np.log1p((n - df + 0.5) / (df + 0.5)).astype(np.float32))
    schema = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        base, packer = TaskContext.get().partitionId() << 40, Packer(width, idf.value, mean_length)

        def rows() -> pa.RecordBatch:
            out, packer.out = packer.out, []
            parts = [d[1][a:a + k].astype("<u4").tobytes() for d, a, k, _, _ in out]
            return pa.record_batch([
                pa.array([d[0] for d, *_ in out], pa.int64()), pa.array([p[1] for p in out], pa.int64()),
                pa.array([p[2] for p in out], pa.int64()), pa.array([len(d[1]) for d, *_ in out], pa.int64()),
                pa.array([base + p[3] for p in out], pa.int64()), pa.array([p[4] for p in out], pa.int64()),
                pa.array(parts, pa.binary())],
                names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

        held: list = []
        size = 0
        for batch in batches:
            for doc_id, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.frombuffer(blob.as_buffer(), np.uint16)
                held.append(((doc_id, ids), ids))
                size += len(ids)
                if size >= shard_ids:
                    packer.shard(held)
                    held, size = [], 0
                    yield rows()
        packer.shard(held)
        packer.close()
        yield rows()

    rows = tokens.where("ids is not null").select("doc_id", "ids")
    shard_docs = int(shard_ids / max(mean_length, 1))
    rows = dealt_by_content(rows, df, idf, max(2, min(shard_docs, n // 64)), max(1, -int(-n * mean_length // shard_ids)),
                            shard_ids)
    return rows.mapInArrow(fill, schema)
