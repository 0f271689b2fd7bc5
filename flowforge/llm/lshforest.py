"""Near-duplicate documents by an LSH forest over MinHash signatures.

A document's set holds its distinct ``words``-word shingles (ASCII lower case).
Equal sets are one node from the start. A node has a signature of 64 minima;
tree t orders the nodes by the signature read from position 4t on (round the
end). Neighbours in such an order share the longest prefixes: a node is a
candidate partner of the next ``reach`` nodes that agree with it in at least 4
values, so sparse regions are searched down to 4 values and dense regions only
as deep as the longest prefixes there. Regions that hold more nodes than that
are not cut off: where such a region still has several components, each node
outside its largest one counts the shingles that it shares with all others by an
inverted list, so that every link between its components is found and no pairs
are formed.

Candidates that could reach the threshold (set sizes; 2-bit signatures, passed
unless five standard deviations below it) are confirmed on the full shingle
sets of both texts. Links give components.

Null or wordless texts have empty sets and link with nothing. Fewer words than
a shingle: the whole sequence is one shingle. Each row is judged by its own
text; sets whose smallest doc_id is the same are one group. Rows with a null doc_id take no part: their component is
null and they are kept. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowforge.llm.common import (
    bounded_batches, hash_windows, hash_words, lowered, mix, row_slices, scan_words, stored, string_bytes,
    text_or_empty)
from flowforge.llm.graph import components

VALUES = 64
TREES = 16
LEAST = 4  # values that candidates share at least
DEEP = 12  # values by which a tree is sorted
#: Nodes of a region that one task holds, about (two such blocks meet).
BLOCK = 2048
#: Ids of at most so many candidates are broadcast (16 bytes each).
MOST_ENDS = 500_000
_RNG = np.random.default_rng(20_11)
_TIMES = _RNG.integers(1 << 62, size=VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_XOR = _RNG.integers(1 << 63, size=VALUES, dtype=np.uint64)


def shingle_sets(data: np.ndarray, offs: np.ndarray, words: int) -> Iterator[np.ndarray]:
    """Each row's sorted distinct shingle hashes."""
    for a, b in row_slices(offs):
        part, at = lowered(data[offs[a]:offs[b]]), offs[a:b + 1] - offs[a]
        starts, ends, first = scan_words(part, at)
        hashed = hash_words(part, starts, ends)
        for i, j in zip(first[:-1], first[1:], strict=True):
            n = j - i
            yield np.unique(hash_windows(hashed[i:j], min(n, words) or 1)) if n >= words or not n \
                else mix(hash_windows(hashed[i:j], int(n)) + np.uint64(n), 1)


def signature(shingles: np.ndarray) -> np.ndarray:
    """64 minima (32 bits each) of a non-empty set."""
    low = np.full(VALUES, np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(shingles), 2048):
        low = np.minimum(low, ((shingles[a:a + 2048, None] ^ _XOR) * _TIMES).min(0))
    return (low >> np.uint64(32)).astype(np.uint32)


def document_sets(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, th (hash of the text), n_shingles, f1 and f2 (128-bit
    fingerprint of the set) and sig (null for an empty set)."""
    bounded_batches(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("n_shingles", pa.int64()), ("f1", pa.int64()),
                        ("f2", pa.int64()), ("sig", pa.binary())])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, f1, f2, sig = [], [], [], []
            for s in shingle_sets(*string_bytes(batch.column(2)), words):
                n.append(len(s))
                f1.append(int(mix(s, 0).sum(dtype=np.uint64).view(np.int64)))
                f2.append(int(np.bitwise_xor.reduce(mix(s, 1)).view(np.int64)) if len(s) else 0)
                sig.append(signature(s).astype(">u4").tobytes() if len(s) else None)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(f1, pa.int64()),
                                   pa.array(f2, pa.int64()), pa.array(sig, pa.binary())], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")) \
        .select("doc_id", F.xxhash64("text").alias("th"), "text")
    return rows.mapInArrow(
        sets, "doc_id bigint, th bigint, n_shingles bigint, f1 bigint, f2 bigint, sig binary")


def forest(nodes: DataFrame) -> DataFrame:
    """One row per node and tree: tree, key (its first values), rest (the
    following values), node, th, n, b0 and b1 (two bits of each minimum)."""
    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = batch.num_rows
            if not k:
                continue
            sig = np.frombuffer(b"".join(batch.column(3).to_pylist()), ">u4").reshape(k, VALUES)
            bits = [np.packbits((sig >> i & 1).astype(np.uint8), axis=1).view("<i8").ravel() for i in (0, 1)]
            for t in range(TREES):
                at = (np.arange(DEEP) + LEAST * t) % VALUES
                raw = np.ascontiguousarray(sig[:, at].astype(">u4"))
                rest = np.ascontiguousarray(raw[:, LEAST:]).tobytes()
                width = 4 * (DEEP - LEAST)
                key = np.ascontiguousarray(raw[:, :LEAST]).view("<u8")
                yield pa.record_batch([
                    pa.array(np.full(k, t, np.int32)), pa.array(mix(mix(key[:, 0]) ^ key[:, 1]).view(np.int64)),
                    pa.array([rest[i:i + width] for i in range(0, k * width, width)], pa.binary()),
                    batch.column(0), batch.column(1), batch.column(2), pa.array(bits[0]), pa.array(bits[1])],
                    names=["tree", "key", "rest", "node", "th", "n", "b0", "b1"])

    return nodes.select("node", "th", "n", "sig").mapInArrow(
        grow, "tree int, key bigint, rest binary, node bigint, th bigint, n bigint, b0 bigint, b1 bigint")


def neighbours(trees: DataFrame, reach: int, percent: int) -> DataFrame:
    """Pairs of nodes at most ``reach`` places apart in a region of a tree's
    order that may reach the threshold."""
    share = percent / 100
    equal = share + (1 - share) / 4  # of 2-bit values, at the threshold
    least = int(VALUES * equal - 5 * np.sqrt(VALUES * equal * (1 - equal)))
    names = ["a", "tha", "b", "thb"]

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None  # the last ``reach`` rows, from earlier batches
        for batch in batches:
            cols = [batch.column(i).to_numpy() for i in range(7)]
            held = 0
            if kept is not None:
                held = len(kept[0])
                cols = [np.concatenate([k, c]) for k, c in zip(kept, cols, strict=True)]
            tree, key, node, th, n, b0, b1 = cols
            # a new row meets the rows before it
            for gap in range(1, min(reach, len(tree) - 1) + 1):
                j = np.arange(max(gap, held), len(tree))
                j = j[(tree[j] == tree[j - gap]) & (key[j] == key[j - gap])]
                if not len(j):
                    break
                i = j - gap
                same = np.bitwise_count((~((b0[i] ^ b0[j]) | (b1[i] ^ b1[j]))).view(np.uint64))
                fits = (same >= least) & (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j]))
                j, i = j[fits], i[fits]
                if len(j):
                    first = node[i] < node[j]
                    a, b = np.where(first, i, j), np.where(first, j, i)
                    yield pa.record_batch([pa.array(x) for x in (node[a], th[a], node[b], th[b])], names=names)
            kept = [x[-reach:] for x in cols]

    ordered = trees.repartition("tree", "key").sortWithinPartitions("tree", "key", "rest", "node") \
        .select("tree", "key", "node", "th", "n", "b0", "b1")
    return ordered.mapInArrow(pairs, "a bigint, tha bigint, b bigint, thb bigint").distinct()


def _texts(ends: DataFrame, docs: DataFrame) -> DataFrame:
    """Compressed texts (t) of the documents in ``ends`` (id, h), stored."""
    ends = stored(ends.distinct(), "ends")
    if ends.count() <= MOST_ENDS:
        ends = F.broadcast(ends)

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = [zlib.compress(t.as_buffer().to_pybytes(), 1) for t in batch.column(2)]
            yield pa.record_batch([*batch.columns[:2], pa.array(z, pa.binary())], names=["id", "h", "t"])

    texts = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("id"), text_or_empty().alias("t")) \
        .withColumn("h", F.xxhash64("t")).join(ends, ["id", "h"]).select("id", "h", "t") \
        .mapInArrow(squeeze, "id bigint, h bigint, t binary")
    return stored(texts.groupBy("id", "h").agg(F.min("t").alias("t")), "texts")


def _sets_of(packed, words: int) -> Iterator[np.ndarray]:
    return shingle_sets(*string_bytes(pa.array([zlib.decompress(z) for z in packed], pa.binary())), words)


def confirmed(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs whose full sets reach the threshold: a, b."""
    ends = pairs.select(F.col("a").alias("id"), F.col("tha").alias("h")).union(pairs.select("b", "thb"))
    texts = _texts(ends, docs)
    one = texts.select(F.col("id").alias("a"), F.col("h").alias("tha"), F.col("t").alias("ta"))
    two = texts.select(F.col("id").alias("b"), F.col("h").alias("thb"), F.col("t").alias("tb"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (_sets_of([z.as_buffer() for z in batch.column(i)], words) for i in (2, 3))
            good = []
            for x, y in zip(left, right, strict=True):
                both = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.record_batch([c.filter(pa.array(good, pa.bool_())) for c in batch.columns[:2]], names=["a", "b"])

    return pairs.join(one, ["a", "tha"]).join(two, ["b", "thb"]).select("a", "b", "ta", "tb") \
        .mapInArrow(check, "a bigint, b bigint")


def region_links(members: list[np.ndarray], component: np.ndarray, percent: int) -> Iterator[tuple[int, int]]:
    """Links between different components of a region, on full sets, one for
    each node and other component: each node outside the region's largest
    component counts the shingles that it shares with every other node by an
    inverted list of shingles. No pair is formed but a link."""
    names, sizes = np.unique(component, return_counts=True)
    size = np.array([len(m) for m in members])
    shingle = np.unique(np.concatenate(members), return_inverse=True)[1]
    owner = np.repeat(np.arange(len(members)), size)
    order = np.argsort(shingle, kind="stable")
    lists, at = owner[order], np.searchsorted(shingle[order], np.arange(shingle.max() + 2))
    first = np.cumsum(size) - size
    for i in np.flatnonzero(component != names[np.argmax(sizes)]):
        own = shingle[first[i]:first[i] + size[i]]
        shared = np.bincount(np.concatenate([lists[at[s]:at[s + 1]] for s in own]), minlength=len(members))
        near = np.flatnonzero((100 * shared >= percent * (size + size[i] - shared)) & (component != component[i]))
        for j in near[np.unique(component[near], return_index=True)[1]]:
            yield int(i), int(j)


def dense_links(regions: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``regions``: tree, key, size, node, th, c (component). Links a, b between
    components inside each region. A region of more than ``BLOCK`` nodes is cut
    into blocks by hash, and every two blocks meet in a task of their own."""
    texts = _texts(regions.select(F.col("node").alias("id"), F.col("th").alias("h")), docs)
    parts = F.ceil(F.col("size") / BLOCK).cast("int")
    dealt = regions.withColumn("parts", parts).withColumn("own", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))) \
        .select("tree", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "th", "c") \
        .join(texts.select(F.col("id").alias("node"), F.col("h").alias("th"), "t"), ["node", "th"])

    def find(df: pd.DataFrame) -> pd.DataFrame:
        nodes, component = df["node"].to_numpy(), df["c"].to_numpy()
        found = list(region_links(list(_sets_of(df["t"], words)), component, percent)) \
            if (component != component[0]).any() else []
        ends = np.array([(nodes[i], nodes[j]) for i, j in found], np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": ends.min(1) if len(ends) else ends[:, 0], "b": ends.max(1) if len(ends) else ends[:, 1]})

    return dealt.groupBy("tree", "key", "i", "j").applyInPandas(find, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, reach: int = 4) -> DataFrame:
    """doc_id, th (hash of its text), n_shingles, component_id and kept for
    every row: documents with 100 * intersection >= percent * union are linked."""
    sets = stored(document_sets(docs, words), "sets")
    of_set = ["f1", "f2", "n_shingles"]
    distinct = sets.where("doc_id is not null and sig is not null").groupBy(*of_set).agg(
        F.min(F.struct("doc_id", "th", "sig")).alias("m"))
    nodes = stored(distinct.select("f1", "f2", F.col("n_shingles").alias("n"), F.col("m.doc_id").alias("node"),
                                   F.col("m.th").alias("th"), F.col("m.sig").alias("sig")), "nodes")
    trees = forest(nodes)
    pairs = stored(neighbours(trees, reach, percent), "pairs")
    links = stored(confirmed(pairs, docs, words, percent), "links")
    parts = components(links)
    member = parts.select(F.col("node").alias("_n"), "component")
    marked = trees.select("tree", "key", "node", "th").join(member, F.expr("node = _n"), "left") \
        .select("tree", "key", "node", "th", F.coalesce("component", "node").alias("c"))
    wide = marked.groupBy("tree", "key").agg(F.count(F.lit(1)).alias("size"), F.min("c").alias("x"),
                                             F.max("c").alias("y")).where(f"size > {reach + 1} and x <> y")
    regions = stored(marked.join(wide.select("tree", "key", "size"), ["tree", "key"]), "regions")
    more = stored(dense_links(regions, docs, words, percent), "links")
    if not more.isEmpty():
        parts = components(links.union(more))
    member = parts.select(F.col("node").alias("_n"), "component")
    of_nodes = nodes.join(member, F.expr("node = _n"), "left").select(
        F.col("f1").alias("_1"), F.col("f2").alias("_2"), F.col("n").alias("_k"),
        F.coalesce("component", "node").alias("_c"))
    own = sets.join(of_nodes, F.expr("f1 = _1 and f2 = _2 and n_shingles = _k"), "left") \
        .select("doc_id", "th", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("_c", "doc_id"))
                .alias("component_id"))
    return own.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
