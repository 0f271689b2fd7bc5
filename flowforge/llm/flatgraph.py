"""Near-dedup of vectors by cosine: robust-pruned flat graphs over cluster shards.

Vectors of one label are compared. Equal vectors are one node from the start.
Nodes are dealt to the shards of their ``overlap`` nearest pivots (nodes picked
by hash, bounded by ``max_pivots``); a shard that holds more than ``block``
nodes is cut into blocks by hash, and every block of queries meets every block
of nodes of its shard, so no shard needs one task. In each block a robust-pruned
neighbour graph is built; the adjacency lists that a node got in its shards are
united; then every node searches the graphs of its shards: greedily from the
block's medoids and from what it knows of itself there, and on through every
node found within range, until no neighbour of a node in range is left unseen.
Each link found is verified in double precision.

Recall is audited: a bounded set of queries is compared with all vectors of
their labels by brute force. Below ``least_recall`` the search is repeated with
twice the overlap and search width; ``Links.recall`` holds the last audit.

Vectors that are null, zero, or hold null or non-finite components, and rows
with a null label or id, link with nothing (each is its own component). Vectors
of different lengths have no cosine. Rows with one vec_id are one node of the
link graph. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowforge.llm.common import ship, stored
from flowforge.llm.graph import components

DEGREE = 16  # neighbours kept by pruning
POOL = 48  # candidates that pruning looks at
ALPHA = 1.2  # a neighbour is dropped if a kept one is nearer to it by this factor
ROUTE = 0.25  # a range search expands nodes up to this much below the threshold


def robust_prune(x: np.ndarray, degree: int = DEGREE, pool: int = POOL, alpha: float = ALPHA) -> np.ndarray:
    """Adjacency [node, degree] (-1: none) of unit vectors: of each node's
    nearest candidates, one is kept if no kept one is ``alpha`` times nearer to
    it than the node is; distances are 1 - cosine. Works in blocks of rows."""
    n = len(x)
    out = np.full((n, degree), -1, np.int64)
    if n < 2:
        return out
    pool = min(pool, n - 1)
    for a in range(0, n, 256):
        near = 1 - x[a:a + 256] @ x.T
        rows = np.arange(len(near))
        near[rows, a + rows] = np.inf
        cand = np.argpartition(near, pool - 1, axis=1)[:, :pool]
        dist = np.take_along_axis(near, cand, 1)
        order = np.argsort(dist, axis=1, kind="stable")
        cand, dist = np.take_along_axis(cand, order, 1), np.take_along_axis(dist, order, 1)
        between = 1 - np.einsum("ipd,iqd->ipq", x[cand], x[cand])
        alive = np.ones(cand.shape, bool)
        kept = np.zeros(len(near), np.int64)
        for p in range(pool):
            take = np.flatnonzero(alive[:, p] & (kept < degree))
            out[a + take, kept[take]] = cand[take, p]
            kept[take] += 1
            alive[take] &= ~(alpha * between[take, p] <= dist[take])
    return out


def medoids(x: np.ndarray, many: int = 8) -> np.ndarray:
    """The node nearest to the mean, then nodes far from all taken so far."""
    taken = [int(np.argmax(x @ x.mean(0)))]
    near = x @ x[taken[0]]
    while len(taken) < min(many, len(x)):
        taken.append(int(np.argmin(near)))
        near = np.maximum(near, x @ x[taken[-1]])
    return np.unique(taken)


def greedy_range(x: np.ndarray, lists: list[np.ndarray], queries: np.ndarray, starts: list[np.ndarray], least: float,
                 width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(query number, nodes within range) by best-first search of a block's
    graph: it goes on while an unexpanded node is among the ``width`` best seen
    or lies within reach of the threshold."""
    for i, q in enumerate(queries):
        seen = np.zeros(len(x), bool)
        nodes = starts[i]
        seen[nodes] = True
        score, fresh = x[nodes] @ q, np.ones(len(nodes), bool)
        while True:
            bar = np.partition(score, -width)[-width] if len(score) > width else -2.0
            go = np.flatnonzero(fresh & ((score >= bar) | (score >= least - ROUTE)))
            if not len(go):
                break
            go = go[np.argsort(-score[go], kind="stable")[:8]]
            fresh[go] = False
            more = np.unique(np.concatenate([lists[j] for j in nodes[go]]))
            more = more[~seen[more]]
            if len(more):
                seen[more] = True
                nodes = np.concatenate([nodes, more])
                score = np.concatenate([score, x[more] @ q])
                fresh = np.concatenate([fresh, np.ones(len(more), bool)])
        yield i, nodes[score >= least]


@dataclass
class Links:
    """pairs: a < b (node ids); nodes: node, copies, x; members: vec_id, node."""

    pairs: DataFrame
    nodes: DataFrame
    members: DataFrame
    recall: float


def _usable(vectors: DataFrame) -> DataFrame:
    """vec_id, label, x: unit vectors in double precision."""
    ok = F.expr("vec_id is not null and label is not null and v is not null and size(v) > 0 and "
                "forall(v, c -> c is not null and not isnan(c) and abs(c) < double('infinity')) and exists(v, c -> c <> 0)")
    top = F.expr("transform(v, c -> c / array_max(transform(v, d -> abs(d))))")  # no overflow in the norm
    norm = F.expr("sqrt(aggregate(t, 0d, (s, c) -> s + c * c))")
    return vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("string").alias("label"),
                          F.expr("transform(embedding, c -> cast(c as double))").alias("v")).where(ok) \
        .select("vec_id", "label", top.alias("t")).select("vec_id", "label", F.transform("t", lambda c: c / norm).alias("x"))


def _pivots(nodes: DataFrame, block: int, max_pivots: int) -> dict[tuple[str, int], np.ndarray]:
    """Pivots by (label, dimension): a share of the nodes by hash, thinned to
    pairs below cosine 0.9 so that one dense region does not hold them all."""
    sizes = {(r["label"], r["d"]): r["n"] for r in nodes.groupBy("label", F.size("x").alias("d")).agg(
        F.count(F.lit(1)).alias("n")).orderBy(F.desc("n")).limit(max_pivots).collect()}
    total = sum(sizes.values()) or 1
    share = min(1.0, max_pivots / total, 4 / block)
    place = F.pmod(F.xxhash64("node", F.lit("pivot")), F.lit(1 << 20)) < int(share * (1 << 20)) + 1
    found: dict[tuple[str, int], list] = {}
    for r in nodes.where(place).select("label", "x").limit(2 * max_pivots).collect():
        found.setdefault((r["label"], len(r["x"])), []).append(r["x"])
    out = {}
    for key, rows in found.items():
        x = np.array(sorted(rows))
        keep: list[int] = []
        for i in range(len(x)):
            if not keep or (x[keep] @ x[i]).max() < 0.9:
                keep.append(i)
        out[key] = x[keep]
    return out


def _sharded(nodes: DataFrame, pivots: dict, overlap: int, block: int) -> DataFrame:
    """node, x, shard (label, dimension and pivot), part and parts (blocks of
    the shard), one row per shard of a node."""
    known = nodes.sparkSession.sparkContext.broadcast(pivots)

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            for (label, d), own in df.groupby([df["label"], df["x"].map(len)]):
                p = known.value.get((label, d))
                near = np.zeros((len(own), 1), int) if p is None else \
                    np.argsort(-(np.stack(own["x"]) @ p.T), axis=1, kind="stable")[:, :overlap]
                for k in range(near.shape[1]):
                    yield pd.DataFrame({"node": own["node"], "x": own["x"],
                                        "shard": [f"{label}/{d}/{j}" for j in near[:, k]]})

    rows = stored(nodes.select("node", "label", "x").mapInPandas(deal, "node bigint, x array<double>, shard string"), "shards")
    parts = rows.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("parts"))
    return rows.join(parts, "shard").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))


def _adjacency(shards: DataFrame) -> DataFrame:
    """node and its united neighbour ids over all its blocks' graphs."""
    def build(df: pd.DataFrame) -> pd.DataFrame:
        ids = df["node"].to_numpy()
        lists = robust_prune(np.stack(df["x"]))
        return pd.DataFrame({"node": ids, "near": [ids[row[row >= 0]] for row in lists]})

    built = shards.select("node", "x", "shard", "part").groupBy("shard", "part") \
        .applyInPandas(build, "node bigint, near array<bigint>")
    return built.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))


def _search(shards: DataFrame, adjacency: DataFrame, least: float, width: int) -> DataFrame:
    """Links a < b that the range searches found, verified."""
    rows = shards.join(adjacency, "node")
    asks = rows.select("node", "x", "near", F.lit(False).alias("holds"), "shard", F.col("part").alias("ask"),
                       F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    holds = rows.select("node", "x", "near", F.lit(True).alias("holds"), "shard", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("ask"), "part")

    def find(df: pd.DataFrame) -> pd.DataFrame:
        held, asked = df[df["holds"]].sort_values("node"), df[~df["holds"]]
        out_a, out_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if len(held) and len(asked):
            x, ids = np.stack(held["x"]), held["node"].to_numpy()

            def here(row: np.ndarray) -> np.ndarray:
                at = np.minimum(np.searchsorted(ids, row), len(ids) - 1)
                return at[ids[at] == row]

            lists = [here(row) for row in held["near"]]
            # links of the graph lead both ways
            back: list[list] = [[] for _ in lists]
            for i, row in enumerate(lists):
                for j in row:
                    back[j].append(i)
            lists = [np.unique(np.concatenate([row, np.array(b, np.int64)])) for row, b in zip(lists, back, strict=True)]
            names, q, entries = asked["node"].to_numpy(), np.stack(asked["x"]), medoids(x)
            starts = [np.unique(np.concatenate([entries, here(np.append(row, name))]))
                      for row, name in zip(asked["near"], names, strict=True)]
            for i, found in greedy_range(x, lists, q, starts, least, width):
                other = ids[found[ids[found] != names[i]]]
                out_a.append(np.minimum(other, names[i]))
                out_b.append(np.maximum(other, names[i]))
        return pd.DataFrame({"a": np.concatenate(out_a), "b": np.concatenate(out_b)})

    return asks.unionByName(holds).groupBy("shard", "ask", "part").applyInPandas(find, "a bigint, b bigint").distinct()


def _audit(nodes: DataFrame, pairs: DataFrame, least: float, queries: int) -> float:
    """Share of the true links of a bounded query set that were found."""
    n = nodes.count()
    if not n:
        return 1.0
    picked = F.pmod(F.xxhash64("node", F.lit("audit")), F.lit(n)) < queries
    asked = nodes.where(picked).select("node", "label", "x").limit(4 * queries).collect()
    known = nodes.sparkSession.sparkContext.broadcast(asked)

    def brute(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            for (label, d), own in df.groupby([df["label"], df["x"].map(len)]):
                qs = [r for r in known.value if r["label"] == label and len(r["x"]) == d]
                if qs:
                    i, j = np.nonzero(np.stack(own["x"]) @ np.array([r["x"] for r in qs]).T >= least)
                    a, b = own["node"].to_numpy()[i], np.array([r["node"] for r in qs])[j]
                    yield pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})[a != b]

    true = nodes.select("node", "label", "x").mapInPandas(brute, "a bigint, b bigint").distinct()
    row = true.join(pairs.withColumn("hit", F.lit(1)), ["a", "b"], "left").agg(F.count(F.lit(1)), F.count("hit")).first()
    return row[1] / row[0] if row[0] else 1.0


def link_vectors(vectors: DataFrame, least: float = 0.93, block: int = 1024, overlap: int = 3, width: int = 24,
                 max_pivots: int = 8192, least_recall: float = 0.98, audit_queries: int = 200) -> Links:
    ship(vectors.sparkSession)
    good = _usable(vectors)
    members = stored(good.withColumn("g", F.sha2(F.concat_ws(",", "label", F.expr("transform(x, c -> cast(c as string))")),
                                                 256)), "vectors")
    groups = members.groupBy("g").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies"),
                                      F.first("label").alias("label"), F.first("x").alias("x"))
    nodes = stored(groups, "nodes")
    own = members.select("vec_id", "g").join(nodes.select("g", "node"), "g").select("vec_id", "node")
    pivots = _pivots(nodes, block, max_pivots)
    pairs = None
    for _ in range(3):
        shards = stored(_sharded(nodes, pivots, overlap, block), "sharded")
        found = _search(shards, _adjacency(shards), least, width)
        pairs = stored(found if pairs is None else found.union(pairs).distinct(), "links")
        recall = _audit(nodes, pairs, least, audit_queries)
        if recall >= least_recall:
            break
        overlap, width = 2 * overlap, 2 * width
    return Links(pairs, nodes, own, recall)


def near_vectors(vectors: DataFrame, least: float = 0.93, **options) -> DataFrame:
    """vec_id, n_links, component_id, kept and the audited recall, one row per
    row of ``vectors``."""
    links = link_vectors(vectors, least, **options)
    copies = links.nodes.select("node", "copies")
    sides = links.pairs.union(links.pairs.select("b", "a")).toDF("node", "other")
    linked = sides.join(copies.select(F.col("node").alias("other"), "copies"), "other") \
        .groupBy("node").agg(F.sum("copies").alias("others"))
    parts = components(links.pairs)
    of_node = copies.join(linked, "node", "left").join(parts, "node", "left").select(
        "node", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("component", "node").alias("c"))
    of_row = links.members.join(of_node, "node").groupBy("vec_id").agg(F.max("n").alias("n"), F.min("c").alias("c")) \
        .withColumnRenamed("vec_id", "_id")
    return vectors.select(F.col("vec_id").cast("long")).join(of_row, F.expr("vec_id = _id"), "left").select(
        "vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("c", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("c", "vec_id"), F.lit(True)).alias("kept"),
        F.lit(links.recall).alias("audited_recall"))
