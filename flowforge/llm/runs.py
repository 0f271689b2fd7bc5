"""Periodic runs of words, found with a dictionary of basic factors.

A run is a stretch of consecutive words with smallest period q (words q apart
are identical) that no neighbouring word extends, at least ``times`` periods and
``least`` words long. The dictionary names every factor of 2, 4, 8, .. words by
the pair of names of its halves, so that two factors of one length have one
name exactly if they are equal. Per length, the positions of a name are put in
order; a successor occurrence that overlaps or touches the factor (both lie in
a stretch of twice its length) proposes its distance as a period. In a run of
period q, factors of q to 2q - 1 words recur at distance q and no sooner, so
consecutive positions with one distance form the progression of that run;
every period is looked for at one length, (length / 2, length]. Proposals are
extended by words on both sides, and equal ones are kept once. Factors that
occur once are dropped from the dictionary, as are all longer ones at their
place: on ordinary text it is nearly empty after a few lengths.

Documents are independent rows: no shuffle, and a lost task is computed again.
A null text has no words and no runs, its collapsed text is empty; equal rows
are judged each on its own; runs of one document may overlap. An empty table
gives no rows. Extra columns are carried along unless ``carry`` names others; a
column named like an output of the operator is replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowforge.llm.common import _SEP, WORD, bounded_batches, row_slices, scan_words, string_bytes, text_or_empty

RUN = "struct<start:bigint,length:bigint,period:bigint>"


def _words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The words as one array of byte strings."""
    offs = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=offs[1:])
    packed = np.ascontiguousarray(data[~_SEP[data]])
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offs), pa.py_buffer(packed)])


def _ranks(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the keys (ties by place) and for each place in it the number
    of its key."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    names = np.zeros(len(keys), np.int64)
    np.cumsum(ordered[1:] != ordered[:-1], out=names[1:])
    return order, names


def find_runs(ids: np.ndarray, first: np.ndarray, least: int, times: int) -> tuple[np.ndarray, ...]:
    """Runs of some documents: ``ids`` are the words of all (equal numbers for
    equal words), document i has those from first[i] to first[i + 1]. Returns
    document, start (in ``ids``), length, period, ordered by start and period."""
    if times < 3:
        raise ValueError("runs are found from three periods on")
    total, doc = len(ids), np.repeat(np.arange(len(first) - 1), np.diff(first))
    longest = int(np.diff(first).max(initial=0))
    found = []
    at = np.arange(total)
    keys = doc * (int(ids.max(initial=0)) + 1) + ids
    name = np.full(total, -1, np.int64)
    length = 1
    while len(at) and length <= longest:
        order, ranks = _ranks(keys)
        at, same = at[order], ranks[1:] == ranks[:-1]
        gap = np.where(same, at[1:] - at[:-1], 0)
        near = (gap > length // 2) & (gap <= length)
        # progressions: consecutive places whose successors have one distance
        i, d = at[:-1][near], gap[near]
        by_place = np.argsort(i, kind="stable")
        i, d = i[by_place], d[by_place]
        head = np.ones(len(i), bool)
        head[1:] = (i[1:] != i[:-1] + 1) | (d[1:] != d[:-1]) | (doc[i[1:]] != doc[i[:-1]])
        tail = np.append(head[1:], True)[:len(i)]
        a, period = i[head], d[head]
        found.append((a, i[tail] + length + period - a, period))
        # the next length: pairs of names that both recur
        again = np.zeros(len(at), bool)
        again[1:] |= same
        again[:-1] |= same
        at, ranks = at[again], ranks[again]
        name[at] = ranks
        both = np.flatnonzero((at + length < first[doc[at] + 1]))
        both = both[name[at[both] + length] >= 0]
        keys = ranks[both] * (total + 1) + name[at[both] + length]
        name[at] = -1
        at = at[both]
        by_place = np.argsort(at, kind="stable")
        at, keys = at[by_place], keys[by_place]
        length *= 2
    start, size, period = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in range(3))
    long = size >= np.maximum(least, times * period)
    return _extended(ids, first, doc, start[long], size[long], period[long])


def _extended(ids, first, doc, start, size, period) -> tuple[np.ndarray, ...]:
    """Proposals extended to both sides while words one period apart agree;
    equal ones once."""
    end, of = start + size, doc[start] if len(start) else np.zeros(0, np.int64)
    while True:
        left = start > first[of]
        left[left] = ids[start[left] - 1] == ids[start[left] - 1 + period[left]]
        right = end < first[of + 1]
        right[right] = ids[end[right]] == ids[end[right] - period[right]]
        if not (left.any() or right.any()):
            break
        start, end = start - left, end + right
    order = np.lexsort((period, start))
    start, end, period, of = start[order], end[order], period[order], of[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (period[1:] != period[:-1])
    return of[new], start[new], (end - start)[new], period[new]


def _collapsed(data: np.ndarray, offs: np.ndarray, least: int, times: int) -> tuple[pa.Array, ...]:
    """n_words, n_runs, the runs and the collapsed text of each row."""
    starts, ends, first = scan_words(data, offs)
    words = _words(data, starts, ends)
    ids = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    of, start, size, period = find_runs(ids, first, least, times)
    change = np.zeros(len(ids) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + size, -1)
    kept = np.cumsum(change[:-1]) == 0
    upto = np.concatenate([[0], np.cumsum(kept)])[first]
    texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(upto, pa.int32()), words.filter(pa.array(kept))), b" ")
    runs = pa.StructArray.from_arrays([pa.array(x) for x in (start - first[of], size, period)],
                                      ["start", "length", "period"])
    split = np.searchsorted(of, np.arange(len(first)))
    return (pa.array(np.diff(first)), pa.array(np.diff(split)),
            pa.ListArray.from_arrays(pa.array(split, pa.int32()), runs), texts.cast(pa.string()))


def collapse_runs(docs: DataFrame, least: int = 24, times: int = 3, carry: Sequence[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``carry``) with ``n_words``, ``n_runs``, ``runs``
    (start, length and period in words, by start and period) and
    ``collapsed_text``: the words left, joined by one space, when each run keeps
    its first period only."""
    bounded_batches(docs.sparkSession)
    new = ("n_words", "n_runs", "runs", "collapsed_text")
    names = [c for c in (docs.columns if carry is None else carry) if c not in new]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), text_or_empty().alias("text"))

    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = string_bytes(batch.column(1))
            for a, b in row_slices(offs):
                made = _collapsed(data[offs[a]:offs[b]], offs[a:b + 1] - offs[a], least, times)
                yield pa.record_batch([batch.column(0).slice(a, b - a), *made], names=["row", *new])

    row_type = rows.schema["row"].dataType.simpleString()
    out = rows.mapInArrow(collapse, f"row {row_type}, n_words bigint, n_runs bigint, runs array<{RUN}>, "
                                    "collapsed_text string")
    return out.select("row.*", *new)


def longest_exponent(runs: Column) -> Column:
    """The run with the greatest length / period (compared exactly; ties: the
    first), null without runs."""
    return F.aggregate(runs, F.lit(None).cast(RUN), lambda best, r: F.when(
        best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text, where one document in ten (by a checksum of its id)
    repeats a stretch of its words to its end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = docs.select("doc_id", "text", (h % 10 == 0).alias("chosen"), F.floor(h / 10).alias("g"))
    split = chosen.withColumn("w", F.when(F.col("chosen"), F.regexp_extract_all("text", F.lit(f"({WORD})"))))
    placed = split.withColumn("n", F.size("w").cast("long")).withColumn(
        "a", F.when(F.col("n") > 0, F.col("g") % F.col("n"))).withColumn(
        "p", F.floor((F.col("n") - F.col("a")) / (F.col("g") % 8 + 3)) + 1)
    words = F.expr("transform(sequence(0L, n - 1), i -> w[cast(if(i >= a, a + (i - a) % p, i) as int)])")
    return placed.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(words, " "))
                         .otherwise(F.col("text")).alias("text"))
