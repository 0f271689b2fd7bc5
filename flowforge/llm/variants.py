"""Spelling variants, found with a trie over letter counts.

Words (lower-cased A-Z) are counted over all texts. The letters fall into 16
groups by code point; a word's path in the trie is its number of letters of
each group. Two words one edit apart differ in these counts by at most one
letter too many and one too few, so a search for the neighbours of a word goes
down the trie with a budget of one surplus and one deficit: at each level it
follows the child with its own count and, while the budget lasts, those with
one more and one fewer. Words of the leaves reached are verified.

The trie is dealt to tasks by subtrees: the levels are taken four at a time,
and a subtree that holds at most NODE words is closed; searches are routed to
closed subtrees by the same budget, level by level. A full path that more words
share is held in blocks, and its searches visit every block; a subtree with
many searches is held several times. So tasks hold bounded parts of the trie
and searches stream past them; what leaves a task is a row per search (number
of neighbours, the best one), never the pairs.

A null text has no words; equal rows count each. Ties of counts go to the
smaller word in code point order. An empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowforge.llm.common import bounded_batches, lowered, row_slices, stored, string_bytes

GROUPS = 16  # levels of the trie
STEP = 4  # levels taken at a time when subtrees are dealt
NODE = 4096  # words of a subtree that one task holds
ASKS = 1 << 16  # searches of a subtree that one task answers
SLICE = 4096  # searches that go down together
HELD = 200_000  # distinct words that a counting task holds
WIDE = 64  # words up to so long are verified in one matrix

_BYTE = np.arange(256)
_LETTER = ((_BYTE >= 65) & (_BYTE <= 90)) | ((_BYTE >= 97) & (_BYTE <= 122))


def _letter_runs(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letter bytes (ASCII letters, U+00C0 to U+00FF as pairs that begin with
    C3) as a mask, and start and end of each maximal run inside a row."""
    mask = _LETTER[data]
    lead = data == 0xC3
    mask |= lead
    mask[1:] |= lead[:-1]
    cut = np.zeros(len(data) + 1, bool)
    cut[offs] = True
    padded = np.concatenate([[False], mask, [False]])
    starts = np.flatnonzero(mask & (~padded[:-2] | cut[:-1]))
    ends = np.flatnonzero(mask & (~padded[2:] | cut[1:])) + 1
    return mask, starts, ends


def _shifted(state: np.ndarray) -> np.ndarray:
    """A checksum after one more zero byte."""
    return (state >> np.uint32(8)) ^ _CRC[state & np.uint32(255)]


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


_CRC = _crc_table()


def _checksums(prefix: np.ndarray, row: np.ndarray, words: list[bytes], word: np.ndarray) -> np.ndarray:
    """crc32 of prefix[row] + words[word] (``prefix``: checksums): the checksum
    of a prefix is moved on by the length of the word and joined with that of
    the word, which is the checksum of both."""
    size = np.array([len(w) for w in words], np.int64)
    own = np.array([zlib.crc32(w) for w in words], np.uint32)
    out = np.zeros(len(row), np.uint32)
    state, length = prefix, 0
    at = size[word]
    for wanted in np.unique(at).tolist():
        while length < wanted:
            state, length = _shifted(state), length + 1
        hit = np.flatnonzero(at == wanted)
        out[hit] = state[row[hit]] ^ own[word[hit]]
    return out


def _counted(data: np.ndarray, offs: np.ndarray, doc_ids: list, shortest: int, delete_every: int | None) -> dict[str, int]:
    """The words of some rows with their counts."""
    low = lowered(data)
    mask, starts, ends = _letter_runs(low, offs)
    if not len(starts):
        return {}
    packed = np.ascontiguousarray(low[mask])
    at = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=at[1:])
    # code points: bytes that begin one
    before = np.concatenate([[0], np.cumsum((packed & 0xC0) != 0x80)])
    points = before[at[1:]] - before[at[:-1]]
    coded = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(packed)]) \
        .dictionary_encode()
    word, words = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.to_pylist()
    keep = points >= shortest
    out: dict[str, int] = {}
    if delete_every:
        row = np.searchsorted(offs, starts, "right") - 1
        known = np.array([i is not None for i in doc_ids], bool)
        prefix = np.array([zlib.crc32(b"%d:" % i) if i is not None else 0 for i in doc_ids], np.uint32)
        h = _checksums(prefix, row, words, word)
        hit = (h % np.uint32(delete_every) == 0) & known[row]
        for i in np.flatnonzero(hit & (points > shortest)):
            text = words[word[i]].decode()
            gone = int(h[i]) % len(text)
            text = text[:gone] + text[gone + 1:]
            out[text] = out.get(text, 0) + 1
        keep &= ~hit
    counts = np.bincount(word[keep], minlength=len(words))
    for i in np.flatnonzero(counts):
        text = words[i].decode()
        out[text] = out.get(text, 0) + int(counts[i])
    return out


def count_words(docs: DataFrame, shortest: int = 6, fewest: int = 5, delete_every: int | None = None) -> DataFrame:
    """word, n: the words of at least ``shortest`` letters that occur at least
    ``fewest`` times in all. With ``delete_every``, an occurrence whose checksum
    (of ``<doc_id>:<word>``) it divides loses the letter at that checksum modulo
    the word's length; rows without doc_id keep their words."""
    bounded_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}

        def out() -> pa.RecordBatch:
            return pa.record_batch([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                   names=["word", "n"])

        for batch in batches:
            data, offs = string_bytes(batch.column(1))
            for a, b in row_slices(offs):
                ids = batch.column(0).slice(a, b - a).to_pylist()
                for word, n in _counted(data[offs[a]:offs[b]], offs[a:b + 1] - offs[a], ids, shortest, delete_every).items():
                    held[word] = held.get(word, 0) + n
                if len(held) >= HELD:
                    yield out()
                    held.clear()
        if held:
            yield out()

    rows = docs.where("text is not null").select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")) \
        .where(F.col("n") >= fewest)


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The letters of all words, one after another, and each word's first."""
    offs = np.zeros(len(words) + 1, np.int64)
    np.cumsum([len(w) for w in words], out=offs[1:])
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8), offs


def _paths(words: list[str]) -> np.ndarray:
    """Each word's letters of each group."""
    letters, offs = _letters(words)
    of = np.repeat(np.arange(len(words)), np.diff(offs))
    return np.bincount(of * GROUPS + letters % GROUPS, minlength=len(words) * GROUPS).reshape(-1, GROUPS)


def _nodes(paths: np.ndarray, depth: int) -> list[bytes]:
    return [row.tobytes() for row in paths[:, :depth].astype(">u4")]


def _matrix(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Words of at most WIDE letters as rows of a matrix, zeros behind; and the
    lengths of all."""
    size = np.array([len(w) for w in words], np.int64)
    flat = "".join(w[:WIDE].ljust(WIDE + 2, "\0") for w in words).encode("latin-1")
    return np.frombuffer(flat, np.uint8).reshape(-1, WIDE + 2), size


def one_edit(a: str, b: str) -> bool:
    """Exactly one inserted, deleted or replaced letter."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[i:] == b[i + 1:] if len(a) < len(b) else a[i + 1:] == b[i + 1:]


def _verified(a, b, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs (word i of a, word j of b) are one edit apart."""
    (words_a, rows_a, size_a), (words_b, rows_b, size_b) = a, b
    good = np.abs(size_a[i] - size_b[j]) <= 1
    wide = good & (np.maximum(size_a[i], size_b[j]) > WIDE)
    for k in np.flatnonzero(wide):
        good[k] = one_edit(words_a[i[k]], words_b[j[k]])
    for k in np.array_split(np.flatnonzero(good & ~wide), -(-len(i) // (1 << 16)) or 1):
        x, y, turn = rows_a[i[k]], rows_b[j[k]], (size_a[i[k]] > size_b[j[k]])[:, None]
        x, y = np.where(turn, y, x), np.where(turn, x, y)  # x is the shorter one
        differ = x != y
        moved = x[:, :-1] != y[:, 1:]
        after = np.arange(WIDE + 1) >= np.argmax(differ, 1)[:, None]
        good[k] = np.where(size_a[i[k]] == size_b[j[k]], differ.sum(1) == 1, ~(moved & after).any(1))
    return good


class Trie:
    """A subtree: words ordered by path, so that a node is a range of rows."""

    def __init__(self, words: list[str], n: np.ndarray):
        paths = _paths(words)
        order = np.lexsort(paths.T[::-1])
        self.words = [words[i] for i in order]
        self.n, self.paths = n[order], paths[order].astype(np.int32)
        self.rank = np.empty(len(words), np.int64)
        self.rank[sorted(range(len(words)), key=self.words.__getitem__)] = np.arange(len(words))
        self.rows, self.size = _matrix(self.words)

    def search(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (searched word, word of the trie) that are one edit apart."""
        paths = _paths(words).astype(np.int32)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        every, full = np.arange(len(words)), np.ones(len(words), np.int32)

        def descend(lo: int, hi: int, level: int, asks: np.ndarray, surplus: np.ndarray, deficit: np.ndarray) -> None:
            if level == GROUPS or (hi - lo) * len(asks) <= SLICE:
                step = max(1, (1 << 18) // (hi - lo))  # pairs looked at together
                for k in range(0, len(asks), step):
                    part = slice(k, k + step)
                    more = self.paths[None, lo:hi, level:] - paths[asks[part], None, level:]
                    over, under = np.maximum(more, 0).sum(2), np.maximum(-more, 0).sum(2)
                    i, j = np.nonzero((over <= surplus[part, None]) & (under <= deficit[part, None]))
                    found.append((asks[part][i], j + lo))
                return
            counts = self.paths[lo:hi, level]
            cuts = np.concatenate([[0], np.flatnonzero(counts[1:] != counts[:-1]) + 1, [hi - lo]])
            own = paths[asks, level]
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                more = counts[a] - own
                go = np.flatnonzero((more == 0) | ((more == 1) & (surplus > 0)) | ((more == -1) & (deficit > 0)))
                if len(go):
                    descend(lo + a, lo + b, level + 1, asks[go], surplus[go] - (more[go] == 1),
                            deficit[go] - (more[go] == -1))

        descend(0, len(self.words), 0, every, full, full)
        i, j = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in range(2))
        good = _verified((words, *_matrix(words)), (self.words, self.rows, self.size), i, j)
        return i[good], j[good]

    def answers(self, words: list[str]) -> pa.RecordBatch:
        """For each searched word with neighbours here: their number, and the
        most frequent one."""
        i, j = self.search(words)
        order = np.lexsort((self.rank[j], -self.n[j], i))
        i, j = i[order], j[order]
        head = np.flatnonzero(np.append(True, i[1:] != i[:-1])[:len(i)])
        near = np.diff(np.append(head, len(i)))
        return pa.record_batch([pa.array([words[k] for k in i[head]], pa.string()), pa.array(near, pa.int64()),
                                pa.array(self.n[j[head]], pa.int64()),
                                pa.array([self.words[k] for k in j[head]], pa.string())],
                               names=["word", "near", "best_n", "best"])


def _budgeted(own: np.ndarray, surplus: int, deficit: int) -> list[tuple[tuple[int, ...], int, int]]:
    """The paths over some levels that a search can take, with what is left of
    its budget."""
    out = [((), surplus, deficit)]
    for count in own.tolist():
        out = [(path + (count + d,), s - (d == 1), t - (d == -1)) for path, s, t in out for d in (0, 1, -1)
               if count + d >= 0 and s >= (d == 1) and t >= (d == -1)]
    return out


def _routed(vocab: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Words (node, word, n) and searches (node, word) by closed subtree."""
    def nodes(depth: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                words = batch.column(0).to_pylist()
                yield pa.record_batch([pa.array(_nodes(_paths(words), depth), pa.binary()), *batch.columns],
                                      names=["node", "word", "n"])
        return run

    def down(depth: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for a in range(0, batch.num_rows, SLICE):
                    part = batch.slice(a, SLICE)
                    words = part.column(0).to_pylist()
                    levels = _paths(words)[:, depth - STEP:depth]
                    kept, to, left = [], [], []
                    for k, (above, s, t) in enumerate(zip(*(part.column(c).to_pylist() for c in (1, 2, 3)))):
                        for path, s2, t2 in _budgeted(levels[k], s, t):
                            kept.append(words[k])
                            to.append(above + np.array(path, ">u4").tobytes())
                            left.append((s2, t2))
                    s3, t3 = np.array(left, np.int32).reshape(-1, 2).T
                    yield pa.record_batch([pa.array(kept, pa.string()), pa.array(to, pa.binary()), pa.array(s3),
                                           pa.array(t3)], names=["word", "node", "s", "t"])
        return run

    closed_words, closed_asks = [], []
    words = vocab.select("word", "n")
    asks = vocab.select("word", F.lit(b"").alias("node"), F.lit(1).alias("s"), F.lit(1).alias("t"))
    for depth in range(STEP, GROUPS + 1, STEP):
        placed = words.mapInArrow(nodes(depth), "node binary, word string, n bigint")
        sizes = placed.groupBy("node").agg(F.count(F.lit(1)).alias("held"))
        sized = sizes.withColumn("closed", (F.col("held") <= NODE) | F.lit(depth == GROUPS))
        dealt = stored(placed.join(sized, "node"), "trie-words")
        asked = stored(asks.mapInArrow(down(depth), "word string, node binary, s int, t int")
                       .join(sized, "node"), "trie-asks")
        closed_words.append(dealt.where("closed").select("node", "word", "n", "held"))
        closed_asks.append(asked.where("closed").select("node", "word", "held"))
        words, asks = dealt.where("not closed").select("word", "n"), asked.where("not closed").select("word", "node", "s", "t")
        if words.isEmpty():
            break
    for later in (closed_words, closed_asks):
        for other in later[1:]:
            later[0] = later[0].union(other)
    return closed_words[0], closed_asks[0]


def neighbours(vocab: DataFrame) -> DataFrame:
    """word, near (number of words one edit apart), best, best_n (the most
    frequent of them) of the words that have any. ``vocab``: word, n, each word
    once."""
    words, asks = _routed(vocab)
    loads = asks.groupBy("node").agg(F.ceil(F.count(F.lit(1)) / ASKS).cast("int").alias("copies"))
    each = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    blocks = F.ceil(F.col("held") / NODE).cast("int")
    some = lambda n: F.pmod(F.xxhash64("word"), n).cast("int")
    held = words.join(loads, "node").select("node", some(blocks).alias("block"), each(F.col("copies")).alias("copy"),
                                            F.lit(0).alias("kind"), "word", "n")
    asked = asks.join(loads, "node").select("node", each(blocks).alias("block"), some(F.col("copies")).alias("copy"),
                                            F.lit(1).alias("kind"), "word", F.lit(0).cast("long").alias("n"))
    cells = held.union(asked).repartition("node", "block", "copy").sortWithinPartitions("node", "block", "copy", "kind")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, words, n, trie = None, [], [], None
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in range(4))))
            texts, counts = batch.column(4).to_pylist(), batch.column(5).to_pylist()
            heads = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]] + [len(keys)]
            for a, b in zip(heads[:-1], heads[1:]):
                if keys[a][:3] != cell:
                    cell, words, n, trie = keys[a][:3], [], [], None
                if keys[a][3] == 0:
                    words += texts[a:b]
                    n += counts[a:b]
                elif words:
                    trie = trie or Trie(words, np.array(n, np.int64))
                    for k in range(a, b, SLICE):
                        yield trie.answers(texts[k:min(b, k + SLICE)])

    parts = cells.mapInArrow(search, "word string, near bigint, best_n bigint, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best"))
    return parts.groupBy("word").agg(F.sum("near").alias("near"), best.alias("b")) \
        .select("word", "near", F.col("b.best").alias("best"), (-F.col("b.less")).alias("best_n"))


def _roots(links: DataFrame) -> DataFrame:
    """word, root of every link (word, form): each round a word takes the root of
    its root, so chains halve. A form is more frequent than its word, so there
    are no circles."""
    roots = stored(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = stored(roots.join(on, "root", "left").select("word", "root", "further"), "roots")
        roots = moved.select("word", F.coalesce("further", "root").alias("root"))
        if moved.where("further is not null").isEmpty():
            return roots


def spelling_variants(docs: DataFrame, shortest: int = 6, fewest: int = 5, ratio: int = 5,
                      delete_every: int | None = None) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word that is counted. The
    form of a word is the most frequent word one edit apart if it is at least
    ``ratio`` times as frequent (else null); the root is where forms lead."""
    if ratio < 2:
        raise ValueError("a form must be more frequent than its word")
    vocab = stored(count_words(docs, shortest, fewest, delete_every), "words")
    own = vocab.join(neighbours(vocab), "word", "left")
    frequent = F.col("best_n") >= F.col("n") * ratio
    formed = stored(own.select("word", "n", F.coalesce("near", F.lit(0)).alias("n_near"),
                               F.when(frequent, F.col("best")).alias("form"),
                               F.when(frequent, F.col("best_n")).alias("form_n")), "forms")
    roots = _roots(formed.where("form is not null"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
