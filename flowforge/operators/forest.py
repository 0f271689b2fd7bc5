"""Random forests by histograms over binned rows.

Features are binned once by quantile boundaries; a block of rows is then one
small matrix of bins. Every tree weighs each row by a Poisson(1) count and every
node draws its own features. While a node has many rows, its split comes from
sums: each task adds up class weights by (feature, bin) over its blocks, the sums
of a node meet in one shuffle, and only its best split reaches the driver; all
trees of a group share one job a level. A node of fewer rows is finished by one
task, which gets its rows and grows the whole subtree below it, all nodes of a
level at once; all such nodes of a group share one job. Counts are drawn from the
seed, the tree and the block, features from the seed, the tree and the node, so a
repeated task draws the same and the trees do not depend on where the line is
drawn (but for splits that are equally good up to rounding).

Spark ML's forest passes over all rows once for every few thousand nodes of a
level; trees that are grown until their leaves are pure have millions of nodes.
What is learnt is the same: ``max_bins`` bins, gini or entropy on weighted rows,
the same draws of features a node, leaves that vote with their class shares, and
importances by impurity, normalised in each tree.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowforge.operators.boosting import bin_rows, quantile_bounds
from flowforge.session import materialise, ship_package

BLOCK_ROWS = 32_768
#: A node of at most so many rows is finished by one task (less if there would
#: be too few such tasks).
LOCAL_ROWS = 1 << 21
#: Rows times trees that are grown at a time: bounds what a job shuffles.
GROUP_ROWS = 1 << 26
#: Rows that a task gets of the nodes that it finishes, about.
TASK_ROWS = 1 << 20
LEAST_GAIN = 1e-10  # share of a node's weight: far above rounding


@dataclass
class Settings:
    classes: int
    trees: int = 200
    max_depth: int = 30
    max_bins: int = 32
    features: int = 1  # drawn for each node
    min_rows: int = 1  # of a child
    impurity: str = "gini"
    bootstrap: bool = True
    seed: int = 42


def features_per_node(strategy: str, d: int, trees: int = 2) -> int:
    """How many of ``d`` features a node draws."""
    if strategy == "auto":
        strategy = "all" if trees == 1 else "sqrt"
    known = {"all": d, "sqrt": math.ceil(math.sqrt(d)), "log2": max(1, math.ceil(math.log2(d))),
             "onethird": math.ceil(d / 3)}
    if strategy not in known:
        raise ValueError(f"unknown feature subset strategy: {strategy}")
    return max(1, min(d, known[strategy]))


def drawn_features(ids: np.ndarray, tree: int, d: int, s: Settings) -> np.ndarray:
    """(nodes x s.features): the features of each node (by its number in the
    full binary tree)."""
    if s.features >= d:
        return np.tile(np.arange(d), (len(ids), 1))
    with np.errstate(over="ignore"):
        x = ids.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) \
            + np.arange(1, d + 1).astype(np.uint64)[None, :] * np.uint64(0xD1B54A32D192ED03) \
            + np.random.SeedSequence([s.seed, tree]).generate_state(1, np.uint64)[0]
        for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(by)
        x ^= x >> np.uint64(31)
    return np.argsort(x, 1, kind="stable")[:, :s.features]


def purity(sums: np.ndarray, impurity: str) -> np.ndarray:
    """Weight times (one minus impurity) of nodes with these class weights."""
    total = sums.sum(-1)
    safe = np.where(total > 0, total, 1.0)
    if impurity == "gini":
        return np.einsum("...k,...k->...", sums, sums) / safe
    return (sums * np.log2(np.maximum(sums, 1e-300))).sum(-1) - total * np.log2(safe)


def best_cuts(cell_sums: np.ndarray, cell_rows: np.ndarray | None, node: np.ndarray, total: np.ndarray,
              rows: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Of one feature a node: the best gain of each node and the cell after
    which it cuts (the first among equals). Cells are in order of (node, bin);
    every node has one. Rows of cells are only looked at if a child needs more
    than one (a child without rows gains nothing)."""
    first = np.searchsorted(node, np.arange(len(total)))
    left = np.cumsum(cell_sums, 0)
    left = np.maximum(left - np.concatenate([np.zeros_like(left[:1]), left])[first][node], 0)
    right = np.maximum(total[node] - left, 0)
    gain = purity(left, s.impurity) + purity(right, s.impurity) - purity(total, s.impurity)[node]
    if s.min_rows > 1:
        below = np.cumsum(cell_rows)
        below = below - np.concatenate([np.zeros_like(below[:1]), below])[first][node]
        gain = np.where((below >= s.min_rows) & (rows[node] - below >= s.min_rows), gain, 0.0)
    best = np.maximum.reduceat(gain, first)
    hit = np.flatnonzero(gain == best[node])[::-1]
    at = np.zeros(len(total), np.int64)
    at[node[hit]] = hit
    return best, at


def best_splits(columns: np.ndarray, place: np.ndarray, y: np.ndarray, w: np.ndarray, counts: np.ndarray,
                at: np.ndarray, drawn: np.ndarray, total: np.ndarray, rows: np.ndarray, s: Settings) -> tuple:
    """Gain, feature and bin of each node's best split; ``place``: each row's
    place in the columns, ``at``: its node. Sums of nodes of many rows are laid
    out whole, else only cells that hold rows."""
    n, k, wide = len(total), s.classes, s.max_bins
    gains, feature, cut = np.zeros(n), np.full(n, -1, np.int64), np.zeros(n, np.int64)
    flat, base, many = columns.reshape(-1), at * wide, n * wide * k <= len(y)
    for j in range(drawn.shape[1]):
        cell = base + flat.take((drawn[:, j] * columns.shape[1]).take(at) + place)
        if many:
            sums = np.bincount(cell * k + y, w, n * wide * k).reshape(n, wide, k)
            left = np.cumsum(sums, 1)
            right = np.maximum(total[:, None] - left, 0)
            found = purity(left, s.impurity) + purity(right, s.impurity) - purity(total, s.impurity)[:, None]
            if s.min_rows > 1:
                below = np.cumsum(np.bincount(cell, counts, n * wide).reshape(n, wide), 1)
                found = np.where((below >= s.min_rows) & (rows[:, None] - below >= s.min_rows), found, 0.0)
            where = found.argmax(1)
            gain = found[np.arange(n), where]
        else:
            filled = np.flatnonzero(np.bincount(cell, minlength=n * wide))
            short = np.zeros(n * wide, np.int64)
            short[filled] = np.arange(len(filled))
            short = short.take(cell)
            sums = np.bincount(short * k + y, w, len(filled) * k).reshape(-1, k)
            held = np.bincount(short, counts, len(filled)) if s.min_rows > 1 else None
            gain, where = best_cuts(sums, held, filled // wide, total, rows, s)
            where = filled[where] % wide
        better = gain > gains
        gains[better], feature[better], cut[better] = gain[better], drawn[better, j], where[better]
    feature[gains <= LEAST_GAIN * total.sum(1)] = -1
    return gains, feature, cut


def divisible(total: np.ndarray, rows: np.ndarray, s: Settings) -> np.ndarray:
    return ((total > 0).sum(1) > 1) & (rows >= 2 * s.min_rows)


def shares(total: np.ndarray) -> np.ndarray:
    weight = total.sum(1, keepdims=True)
    return np.where(weight > 0, total / np.where(weight > 0, weight, 1.0), 1.0 / total.shape[1]).astype(np.float32)


def grow_here(bins: np.ndarray, y: np.ndarray, w: np.ndarray, counts: np.ndarray, node: int, depth: int, tree: int,
              s: Settings) -> tuple:
    """The subtree below ``node`` from its rows: feature (-1: a leaf), bin, left
    child (the right one follows it), class shares, and gains by feature. Rows
    whose node ended are left behind level by level."""
    columns, d, k = np.ascontiguousarray(bins.T), bins.shape[1], s.classes
    w, counts, y = w * counts, counts.astype(float), y.astype(np.int64)
    place = np.arange(len(y))  # of each row in the columns
    ids, at = np.array([node], np.int64), np.zeros(len(y), np.int64)
    gains, size, levels = np.zeros(d), 0, []
    for level in range(depth + 1):
        n = len(ids)
        size += n
        # rows whose node ended above lie at n
        total = np.bincount(at * k + y, w, (n + 1) * k).reshape(-1, k)[:n]
        rows = np.bincount(at, counts, n + 1)[:n]
        feature, cut, left = np.full(n, -1, np.int16), np.zeros(n, np.uint8), np.zeros(n, np.int32)
        levels.append((feature, cut, left, shares(total)))
        open_ = np.flatnonzero(divisible(total, rows, s)) if level < depth else ()
        if not len(open_):
            break
        slot = np.full(n + 1, -1, np.int64)
        slot[open_] = np.arange(len(open_))
        at = slot.take(at)
        on = np.flatnonzero(at >= 0)
        if len(on) < len(at):
            place, y, w, counts, at = place.take(on), y.take(on), w.take(on), counts.take(on), at.take(on)
            if 2 * len(on) < columns.shape[1]:
                columns, place = columns.take(place, 1), np.arange(len(on))
        gain, f, b = best_splits(columns, place, y, w, counts, at, drawn_features(ids[open_], tree, d, s), total[open_],
                                 rows[open_], s)
        split = np.flatnonzero(f >= 0)
        if not len(split):
            break
        parents = open_[split]
        feature[parents], cut[parents], left[parents] = f[split], b[split], size + 2 * np.arange(len(split))
        gains += np.bincount(f[split], gain[split], d)
        ids = (2 * ids[parents][:, None] + np.array([1, 2])).ravel()
        child = np.full((len(open_), 2), len(ids), np.int64)
        child[split] = np.arange(len(ids)).reshape(-1, 2)
        right = columns.reshape(-1).take((np.maximum(f, 0) * columns.shape[1]).take(at) + place) > b.take(at)
        at = child.reshape(-1).take(2 * at + right)
    return *(np.concatenate([x[i] for x in levels]) for i in range(4)), gains


class Growing:
    """A tree's upper nodes while it grows."""

    def __init__(self, classes: int, d: int):
        self.feature, self.bin, self.left = [-1], [0], [0]
        self.value, self.gains, self.classes = [np.zeros(classes, np.float32)], np.zeros(d), classes

    def split(self, place: int, feature: int, cut: int) -> int:
        """Gives the node two children; returns the place of the left one."""
        self.feature[place], self.bin[place], self.left[place] = feature, cut, len(self.feature)
        for column, empty in ((self.feature, -1), (self.bin, 0), (self.left, 0)):
            column.extend((empty, empty))
        self.value += [np.zeros(self.classes, np.float32)] * 2
        return self.left[place]

    def arrays(self) -> tuple:
        return (np.array(self.feature, np.int16), np.array(self.bin, np.uint8), np.array(self.left, np.int32),
                np.stack(self.value))

    def grafted(self, parts: list[tuple]) -> tuple:
        """Arrays of the whole tree: subtrees (place, feature, bin, left, shares,
        gains) put in their places."""
        done = [list(self.arrays())]
        size, top = len(self.feature), done[0]
        for place, feature, cut, left, value, gains in parts:
            left = np.where(feature >= 0, left + (size - 1), 0).astype(np.int32)  # its root lies at ``place``
            for column, got in zip(top, (feature, cut, left, value)):
                column[place] = got[0]
            done.append([feature[1:], cut[1:], left[1:], value[1:]])
            size += len(feature) - 1
            self.gains += gains
        return tuple(np.concatenate([x[i] for x in done]) for i in range(4))


def ends(tree: tuple, bins: np.ndarray) -> np.ndarray:
    """The node in which each row ends. Nodes that end lead to themselves; rows
    that ended are left behind once they are many."""
    goes = tree[0] >= 0
    feature, cut = np.where(goes, tree[0], 0).astype(np.int64), np.where(goes, tree[1], 255).astype(np.uint8)
    left = np.where(goes, tree[2], np.arange(len(goes)))
    node, on = np.zeros(len(bins), np.int64), np.arange(len(bins))
    flat, first, here = np.ascontiguousarray(bins).reshape(-1), on * bins.shape[1], node
    while len(on):
        here = left.take(here) + (flat.take(first + feature.take(here)) > cut.take(here))
        go = goes.take(here)
        if 4 * np.count_nonzero(go) < 3 * len(go):
            node[on] = here
            more = np.flatnonzero(go)
            on, first, here = on.take(more), first.take(more), here.take(more)
    return node


def _counts(tree: int, number: int, rows: int, s: Settings) -> np.ndarray:
    if not s.bootstrap:
        return np.ones(rows, np.uint8)
    return np.random.default_rng([s.seed, tree, number]).poisson(1.0, rows).astype(np.uint8)


def _by_root(blocks: Iterator, trees: dict[int, tuple], roots: list[tuple]) -> Iterator[tuple]:
    """(place in ``roots``, block number, bins, labels, weights, counts) of the
    rows that lie in each root (tree, place, node number, depth)."""
    wanted: dict[int, list[int]] = {}
    for i, root in enumerate(roots):
        wanted.setdefault(root[0], []).append(i)
    for number, bins, y, w, drawn in blocks:
        for t, mine in wanted.items():
            counts, node = drawn[t], ends(trees[t], bins)
            slot = np.full(len(trees[t][0]), -1, np.int64)
            slot[[roots[i][1] for i in mine]] = mine
            at = slot.take(node)
            here = np.flatnonzero((counts > 0) & (w > 0) & (at >= 0))
            at = (at.take(here) - mine[0]).astype(np.int16 if mine[-1] - mine[0] < 1 << 15 else np.int64)
            here = here.take(np.argsort(at, kind="stable"))  # 16 bits: a radix sort
            held = np.bincount(at, minlength=1)
            for i, rows in zip(np.flatnonzero(held).tolist(), np.split(here, np.cumsum(held[held > 0])[:-1])):
                yield i + mine[0], number, bins.take(rows, 0), y.take(rows), w.take(rows), counts.take(rows)


def _level(blocks: RDD, trees: dict[int, tuple], active: list[tuple], d: int, s: Settings) -> list[tuple]:
    """One job: for each active node its place in ``active``, class weights,
    rows, and its best split with the rows of the left child."""
    wanted: dict[int, list[int]] = {}
    for i, root in enumerate(active):
        wanted.setdefault(root[0], []).append(i)
    drawn_of = {t: drawn_features(np.array([active[i][2] for i in mine]), t, d, s) for t, mine in wanted.items()}

    def add(task: int, it: Iterator) -> Iterator[tuple]:
        k, wide = s.classes, s.max_bins
        held = {t: np.zeros((len(mine), s.features, wide, k + 1)) for t, mine in wanted.items()}
        for _, bins, y, w, drawn in it:
            flat = np.ascontiguousarray(bins).reshape(-1)
            for t, mine in wanted.items():
                n, counts = len(mine), drawn[t]
                slot = np.full(len(trees[t][0]), -1, np.int64)
                slot[[active[i][1] for i in mine]] = np.arange(n)
                at = slot.take(ends(trees[t], bins))
                here = np.flatnonzero((counts > 0) & (w > 0) & (at >= 0))
                at, count, label = at.take(here), counts.take(here), y.take(here)
                weight, first = w.take(here) * count, here * d
                for j in range(s.features):
                    cell = at * wide + flat.take(first + drawn_of[t][:, j].take(at))
                    held[t][:, j, :, :-1] += np.bincount(cell * k + label, weight, n * wide * k).reshape(n, wide, k)
                    held[t][:, j, :, -1] += np.bincount(cell, count, n * wide).reshape(n, wide)
        for t, mine in wanted.items():
            for i, sums in zip(mine, held[t]):
                yield i, (task, sums)

    def split(it: Iterator[tuple]) -> Iterator[tuple]:
        held: dict[int, list] = {}
        for i, part in it:
            held.setdefault(i, []).append(part)
        for i, parts in held.items():
            sums = sum(x for _, x in sorted(parts, key=lambda p: p[0]))  # the same order on every run
            total, rows = sums[0, :, :-1].sum(0)[None], sums[0, :, -1].sum()[None]
            drawn = drawn_of[active[i][0]][wanted[active[i][0]].index(i)]
            best = (LEAST_GAIN * total.sum(), -1, 0, 0.0)
            for f, x in zip(drawn.tolist(), sums) if divisible(total, rows, s)[0] else ():
                gain, at = best_cuts(x[:, :-1], x[:, -1], np.zeros(s.max_bins, np.int64), total, rows, s)
                if gain[0] > best[0]:
                    best = (gain[0], f, int(at[0]), x[:at[0] + 1, -1].sum())
            yield i, total[0], rows[0], *best

    return blocks.mapPartitionsWithIndex(add).partitionBy(min(len(active), blocks.context.defaultParallelism), int) \
        .mapPartitions(split).collect()


def _subtrees(blocks: RDD, trees: dict[int, tuple], roots: list[tuple], rows: float, s: Settings) -> list[tuple]:
    """One job: the subtree below each root."""
    def send(it: Iterator) -> Iterator[tuple]:
        for i, *part in _by_root(it, trees, roots):
            yield i, part

    def finish(it: Iterator[tuple]) -> Iterator[tuple]:
        held: dict[int, list] = {}
        for i, part in it:
            held.setdefault(i, []).append(part)
        while held:
            i, parts = held.popitem()
            parts.sort(key=lambda p: p[0])
            tree, _, node, depth = roots[i]
            yield i, *grow_here(*(np.concatenate([p[c] for p in parts]) for c in (1, 2, 3, 4)), node, depth, tree, s)

    tasks = min(len(roots), max(4 * blocks.context.defaultParallelism, int(rows // TASK_ROWS)))
    return blocks.mapPartitions(send).partitionBy(tasks, int).mapPartitions(finish).collect()


def _grow(blocks: RDD, rows: int, numbers: range, d: int, s: Settings) -> list[tuple]:
    """(arrays, gains) of some trees."""
    growing = {t: Growing(s.classes, d) for t in numbers}
    most = min(LOCAL_ROWS, max(BLOCK_ROWS // 8, rows * len(numbers) // (4 * blocks.context.defaultParallelism)))
    small, active = [], []

    def sort_out(root: tuple, count: float) -> None:
        (small if count <= most or root[3] == 0 else active).append((count, root))

    for t in numbers:
        sort_out((t, 0, 0, s.max_depth), rows)
    blocks = blocks.map(lambda b: (*b, {t: _counts(t, b[0], len(b[2]), s) for t in numbers}))
    many = bool(active)
    if many:  # counts are drawn once for all levels
        blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)
    while active:
        roots = [r for _, r in active]
        active = []
        arrays = {t: growing[t].arrays() for t in {r[0] for r in roots}}
        for i, total, count, gain, feature, cut, left_rows in sorted(_level(blocks, arrays, roots, d, s), key=lambda x: x[0]):
            t, place, node, depth = roots[i]
            growing[t].value[place] = shares(total[None])[0]
            if feature >= 0:
                growing[t].gains[feature] += gain
                left = growing[t].split(place, feature, cut)
                sort_out((t, left, 2 * node + 1, depth - 1), left_rows)
                sort_out((t, left + 1, 2 * node + 2, depth - 1), count - left_rows)
    small.sort(key=lambda x: -x[0])  # large ones are dealt out first
    parts: dict[int, list] = {t: [] for t in numbers}
    if small:
        arrays, roots = {t: growing[t].arrays() for t in numbers}, [r for _, r in small]
        for i, *part in sorted(_subtrees(blocks, arrays, roots, sum(c for c, _ in small), s), key=lambda x: x[0]):
            parts[roots[i][0]].append((roots[i][1], *part))
    if many:
        blocks.unpersist()
    return [(growing[t].grafted(parts[t]), growing[t].gains) for t in numbers]


def _blocks(train: DataFrame, label_col: str, features_col: str, weight_col: str | None,
            bounds: list[np.ndarray]) -> tuple[RDD, int]:
    """Blocks (number, bins, labels, weights) of the training rows, written
    once; and the number of rows."""
    d = len(bounds)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        held, size, number = [], 0, TaskContext.get().partitionId() << 24

        def out() -> pa.RecordBatch:
            columns = [np.concatenate([h[i] for h in held]) for i in range(3)]
            return pa.record_batch([pa.array([number], pa.int64()), *(pa.array([c.tobytes()], pa.binary()) for c in columns)],
                                   names=["number", "bins", "y", "w"])

        for batch in batches:
            x, y, w = (batch.column(i) for i in range(3))
            x = x.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            for a in range(0, len(x), BLOCK_ROWS):
                here = slice(a, a + BLOCK_ROWS)
                held.append((bin_rows(x[here], bounds), y.to_numpy(zero_copy_only=False)[here].astype(np.int32),
                             w.to_numpy(zero_copy_only=False)[here].astype(float)))
                size += len(held[-1][1])
                if size >= BLOCK_ROWS:
                    yield out()
                    held, size, number = [], 0, number + 1
        if size:
            yield out()

    weight = F.col(weight_col).cast("double") if weight_col else F.lit(1.0)
    rows = train.select(vector_to_array(features_col).alias("x"), F.col(label_col).cast("int").alias("y"), weight.alias("w"))
    table = materialise(rows.mapInArrow(pack, "number bigint, bins binary, y binary, w binary"), "forest-blocks")
    n = int((table.agg(F.sum(F.octet_length("y"))).first()[0] or 0) // 4)

    def load(row) -> tuple:
        y = np.frombuffer(row.y, np.int32)
        return row.number, np.frombuffer(row.bins, np.uint8).reshape(len(y), d), y, np.frombuffer(row.w)

    cores = train.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(-(-n // BLOCK_ROWS), max(4 * cores, n // TASK_ROWS)))
    return table.repartitionByRange(tasks, "number").rdd.map(load), n


class ForestClassifier:
    """Settings of a forest, by the names of Spark ML's own."""

    def __init__(self, labelCol: str, featuresCol: str = "features", seed: int = 42, numTrees: int = 200,
                 maxDepth: int = 30, featureSubsetStrategy: str = "auto", weightCol: str | None = None,
                 minInstancesPerNode: int = 1, impurity: str = "gini", maxBins: int = 32, bootstrap: bool = True):
        if not (1 <= maxDepth <= 30 and 2 <= maxBins <= 256 and numTrees >= 1 and impurity in ("gini", "entropy")):
            raise ValueError("maxDepth must be 1 to 30, maxBins 2 to 256, numTrees 1 or more, impurity gini or entropy")
        self.label, self.features, self.weight, self.seed = labelCol, featuresCol, weightCol, seed
        self.trees, self.depth, self.strategy, self.bootstrap = numTrees, maxDepth, featureSubsetStrategy, bootstrap
        self.min_rows, self.impurity, self.max_bins = minInstancesPerNode, impurity, maxBins

    def getNumTrees(self) -> int:
        return self.trees

    def getMaxDepth(self) -> int:
        return self.depth

    def fit(self, train: DataFrame) -> ForestModel:
        ship_package(train.sparkSession)
        first = train.select(F.size(vector_to_array(self.features))).first()
        if first is None:
            raise ValueError("no rows to train on")
        d = first[0]
        classes = max(2, int(train.agg(F.max(F.col(self.label).cast("int"))).first()[0]) + 1)
        s = Settings(classes, self.trees, self.depth, self.max_bins, features_per_node(self.strategy, d, self.trees),
                     self.min_rows, self.impurity, self.bootstrap, self.seed)
        names = [f"f{j}" for j in range(d)]
        x = train.select(*[vector_to_array(self.features)[j].alias(n) for j, n in enumerate(names)])
        bounds = quantile_bounds(x, names, s.max_bins)
        blocks, rows = _blocks(train, self.label, self.features, self.weight, bounds)
        blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)
        group = max(1, min(s.trees, GROUP_ROWS // max(rows, 1)))
        grown = [g for t in range(0, s.trees, group) for g in _grow(blocks, rows, range(t, min(t + group, s.trees)), d, s)]
        blocks.unpersist()
        gains = np.stack([g for _, g in grown])
        weight = gains.sum(1, keepdims=True)
        gains = np.divide(gains, weight, out=np.zeros_like(gains), where=weight > 0).sum(0)
        return ForestModel(bounds, [t for t, _ in grown], gains / gains.sum() if gains.sum() > 0 else gains, classes,
                           self.features)


def forest_probabilities(x: np.ndarray, bounds: list[np.ndarray], trees: list[tuple], classes: int) -> np.ndarray:
    """Mean of the class shares of the leaves in which rows end."""
    bins, out = bin_rows(x, bounds), np.zeros((len(x), classes))
    for tree in trees:
        out += tree[3][ends(tree, bins)]
    total = out.sum(1, keepdims=True)  # 0 if no tree drew a row
    return np.where(total > 0, out / np.where(total > 0, total, 1.0), 1.0 / classes)


class ForestModel(Model):
    """A forest with ``probability`` (one per class code) and ``prediction``
    (the most probable class, the lowest among equals)."""

    def __init__(self, bounds, trees: list[tuple], importances: np.ndarray, classes: int, features_col: str = "features"):
        super().__init__()
        self.bounds, self.trees, self.importances = bounds, trees, importances
        self.classes, self.features_col, self._sent = classes, features_col, None

    @property
    def featureImportances(self) -> DenseVector:
        return DenseVector(self.importances)

    def getNumTrees(self) -> int:
        return len(self.trees)

    def _transform(self, df: DataFrame) -> DataFrame:
        sc = df.sparkSession.sparkContext
        ship_package(df.sparkSession)
        if self._sent is None or self._sent[0] != sc.applicationId:
            self._sent = sc.applicationId, sc.broadcast((self.bounds, self.trees, self.classes))
        sent = self._sent[1]

        @F.pandas_udf("array<double>")
        def score(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=object)
            return pd.Series(list(forest_probabilities(np.stack(x.to_numpy()), *sent.value)))

        scored = df.withColumn("probability", score(vector_to_array(self.features_col)))
        best = F.array_position("probability", F.array_max("probability")) - 1
        return scored.withColumn("prediction", best.cast("double")) \
            .withColumn("probability", array_to_vector("probability"))

    def save(self, path: str) -> None:
        """The trees as Parquet, boundaries and sizes as JSON."""
        from pyspark.sql import SparkSession
        spark = SparkSession.getActiveSession()
        rows = [(i, *(bytearray(a.tobytes()) for a in t)) for i, t in enumerate(self.trees)]
        spark.createDataFrame(rows, "tree int, feature binary, bin binary, left binary, value binary") \
            .write.mode("overwrite").parquet(f"{path}/trees")
        meta = {"bounds": [b.tolist() for b in self.bounds], "classes": self.classes, "features": self.features_col,
                "importances": self.importances.tolist()}
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1) \
            .write.mode("overwrite").json(f"{path}/metadata")

    @classmethod
    def load(cls, path: str) -> ForestModel:
        from pyspark.sql import SparkSession
        spark = SparkSession.getActiveSession()
        meta = json.loads(spark.read.json(f"{path}/metadata").first()["meta"])
        kinds = {"feature": np.int16, "bin": np.uint8, "left": np.int32, "value": np.float32}
        trees = [tuple(np.frombuffer(r[n], k) for n, k in kinds.items())
                 for r in spark.read.parquet(f"{path}/trees").orderBy("tree").collect()]  # a row per tree
        trees = [(*t[:3], t[3].reshape(-1, meta["classes"])) for t in trees]
        return cls([np.array(b, float) for b in meta["bounds"]], trees, np.array(meta["importances"]), meta["classes"],
                   meta["features"])
