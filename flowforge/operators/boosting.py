"""Gradient-boosted trees by histograms, with one softmax over all classes.

Features are binned once by quantile boundaries; a block of rows is then one
small matrix of bins. A round grows one tree per class (one in all for two
classes) on the gradients of the log loss. While a node has many rows, its split
comes from sums: every task adds up gradients and curvatures by (class, node,
feature, bin) over its blocks, the sums of a class meet in one shuffle, where the
best split of each node is found, and only those splits reach the driver (at
most classes x nodes rows); all classes of a level share one job. A node of few
rows is finished by one task, which gets its rows and grows the whole subtree
below it with the same sums (of two siblings the larger's are its parent's less
the other's), so the trees do not depend on where the line is drawn, gains that
differ by rounding alone being equal; all such nodes of a round share one job. The update of the scores rides
on the first job of the next round.

Blocks carry their own scores, so a round reads nothing but the blocks of the
round before. That per-partition state is why this stands on an RDD (as tree
induction in Spark ML does). It is kept on executors, spills to disk, and is cut
by a reliable checkpoint every ``cut_every`` rounds: a lost executor repeats at
most those rounds for its blocks.

Leaf weights and split gains are those of second-order boosting with an L2 term;
a child needs ``min_child_weight`` of curvature. Row and column sampling draw
from the seed, the round and the block, so a repeated task draws the same.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowforge.session import checkpoint_dir, materialise, ship_package

#: Rows of a block, and how many tasks are merged at a time before the last
#: merge of a level.
BLOCK_ROWS = 32_768
MERGED = 32
#: Blocks of a task, about, once every core has one.
TASK_BLOCKS = 8
#: Sums (node x feature x bin) of a class that a task holds at once.
HELD_SUMS = 1 << 18
#: A node is finished by one task if its rows have at most so many bins in all
#: (a level's job costs more than the sums of so many).
LOCAL_CELLS = 1 << 23
#: Rows that are added up at a time: what a core's cache holds.
ADD_ROWS = 1 << 15
LEAST_GAIN = 1e-6
#: Gains that differ by a smaller share are equal: sums that were added up in
#: another order, or taken from a parent's, differ by rounding.
SAME_GAIN = 1e-10


@dataclass
class Settings:
    rounds: int = 200
    learning_rate: float = 0.1
    max_depth: int = 7
    max_bins: int = 64
    reg_lambda: float = 1.0
    min_child_weight: float = 1.0
    subsample: float = 1.0
    colsample: float = 1.0
    seed: int = 42
    cut_every: int = 25

    def check(self) -> None:
        if not (1 <= self.max_depth <= 14 and 2 <= self.max_bins <= 256 and self.rounds >= 1):
            raise ValueError("max_depth must be 1 to 14, max_bins 2 to 256, rounds 1 or more")


class Tree:
    """A full binary tree in arrays: node i has children 2i + 1 and 2i + 2. A
    row goes right if its bin of ``feature`` exceeds ``bin``; feature -1 ends."""

    def __init__(self, depth: int):
        self.feature = np.full((1 << depth) - 1, -1, np.int16)
        self.bin = np.zeros((1 << depth) - 1, np.uint8)
        self.value = np.zeros((2 << depth) - 1)

    def nodes(self, bins: np.ndarray, depth: int) -> np.ndarray:
        """Each row's node after at most ``depth`` steps. Nodes that end lead to
        themselves, so that a step is the same for all rows."""
        node, inner = np.zeros(len(bins), np.int64), len(self.feature)
        if not inner or self.feature[0] < 0 or not depth:
            return node
        left = np.arange(len(self.value))
        goes = np.flatnonzero(self.feature >= 0)
        left[goes] = 2 * goes + 1
        feature, cut = np.zeros(len(left), np.int64), np.full(len(left), 255, np.uint8)
        feature[goes], cut[goes] = self.feature[goes], self.bin[goes]
        flat, first = np.ascontiguousarray(bins).reshape(-1), np.arange(len(bins)) * bins.shape[1]
        for _ in range(depth):
            node = left.take(node) + (flat.take(first + feature.take(node)) > cut.take(node))
        return node


def bin_rows(x: np.ndarray, bounds: list[np.ndarray]) -> np.ndarray:
    """Each value's number of boundaries below it (NaN: behind all)."""
    return np.stack([np.searchsorted(b, x[:, j], "left") for j, b in enumerate(bounds)], 1).astype(np.uint8) \
        if bounds else np.zeros((len(x), 0), np.uint8)


def probabilities(margin: np.ndarray) -> np.ndarray:
    """Softmax; for one column, its logistic and the rest."""
    if margin.shape[1] == 1:
        p = 1.0 / (1.0 + np.exp(-margin[:, 0]))
        return np.stack([1.0 - p, p], 1)
    e = np.exp(margin - margin.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def gradients(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p = probabilities(margin)
    if margin.shape[1] == 1:
        p = p[:, 1:]
        return p - (y == 1)[:, None], np.maximum(p * (1 - p), 1e-16)
    return p - (y[:, None] == np.arange(p.shape[1])), np.maximum(2 * p * (1 - p), 1e-16)


def node_sums(bins: np.ndarray, at: np.ndarray, g: np.ndarray, h: np.ndarray, nodes: int, features: range,
              cols: np.ndarray, max_bins: int) -> np.ndarray:
    """Gradient, curvature and rows by (node, feature, bin); ``at`` is each
    row's place among the nodes. Features that are not in ``cols`` stay zero."""
    out = np.zeros((nodes, len(features), max_bins, 3))
    used, base, size = set(cols.tolist()), at * max_bins, nodes * max_bins
    for i, j in enumerate(features):
        if j in used:
            to = base + bins[:, j]
            for c, w in enumerate((g, h, None)):
                out[:, i, :, c] = np.bincount(to, w, size).reshape(nodes, max_bins)
    return out


def pair_sums(columns: np.ndarray, at: np.ndarray, gh: np.ndarray, nodes: int, cols: np.ndarray,
              max_bins: int) -> np.ndarray:
    """Gradient and curvature by (node, feature, bin) from columns of bins;
    ``gh`` holds the two as one complex number a row."""
    out = np.zeros((nodes, len(columns), max_bins), complex)
    held = np.zeros((len(cols), nodes * max_bins), complex)
    for a in range(0, len(at), ADD_ROWS):
        here = slice(a, a + ADD_ROWS)
        base, part = at[here] * max_bins, gh[here]
        for i, j in enumerate(cols.tolist()):
            np.add.at(held[i], base + columns[j, here], part)
    out[:, cols] = held.reshape(len(cols), nodes, max_bins).transpose(1, 0, 2)
    return out.view(float).reshape(nodes, len(columns), max_bins, 2)


def sibling_sums(columns: np.ndarray, at: np.ndarray, gh: np.ndarray, nodes: int, cols: np.ndarray, max_bins: int,
                 pairs: np.ndarray, parents: np.ndarray) -> np.ndarray:
    """``pair_sums`` where of two siblings only the one of fewer rows is added
    up; the other is its parent less that. ``pairs``: left and right place,
    place of the parent in ``parents``."""
    rows = np.bincount(at, minlength=nodes)
    more = np.where(rows[pairs[:, 0]] > rows[pairs[:, 1]], pairs[:, 0], pairs[:, 1])
    added = np.ones(nodes, bool)
    added[more] = False
    here = np.flatnonzero(added[at])
    out = pair_sums(columns[:, here], at[here], gh[here], nodes, cols, max_bins)
    out[more] = parents[pairs[:, 2]] - out[pairs[:, 0] + pairs[:, 1] - more]
    return out


def best_splits(sums: np.ndarray, features: range, cols: np.ndarray, s: Settings) -> list[tuple]:
    """Per node: gain, feature, bin, left and total sums of the best split (the
    lowest feature and bin among equals; gain 0 and feature -1 if none helps)."""
    used, none = np.isin(np.array(features), cols), (0.0,) * sums.shape[-1]
    total = sums[:, np.argmax(used)].sum(1) if used.any() else np.zeros((len(sums), len(none)))
    left = np.cumsum(sums, 2)[:, :, :-1]
    right = total[:, None, None] - left
    score = lambda a: a[..., 0] ** 2 / (a[..., 1] + s.reg_lambda)
    gain = score(left) + score(right) - score(total)[:, None, None]
    ok = (left[..., 1] >= s.min_child_weight) & (right[..., 1] >= s.min_child_weight) & used[None, :, None]
    gain = np.where(ok & (gain > LEAST_GAIN), gain, 0.0)
    flat = gain.reshape(len(gain), -1)
    best = (flat >= flat.max(1, keepdims=True) * (1 - SAME_GAIN)).argmax(1)
    f, b = np.divmod(best, gain.shape[2])
    out = []
    for i in range(len(sums)):
        found = flat[i, best[i]] > 0
        out.append((float(flat[i, best[i]]), features[f[i]] if found else -1, int(b[i]),
                    tuple(left[i, f[i], b[i]]) if found else none, tuple(total[i])))
    return out


def _better(new: tuple, have: tuple | None) -> bool:
    """Features may lie in several pieces: the largest gain, then the lowest
    feature (a piece without any used feature has no totals and never wins)."""
    if have is None or not any(have[4]):
        return True
    if abs(new[0] - have[0]) <= SAME_GAIN * have[0]:
        return 0 <= new[1] < have[1]
    return new[0] > have[0] and new[1] >= 0


def _pieces(nodes: int, d: int, max_bins: int) -> list[range]:
    width = max(1, min(d, HELD_SUMS // (max(nodes, 1) * max_bins)))
    return [range(a, min(a + width, d)) for a in range(0, d, width)]


def _put(tree: Tree, node: int, split: tuple, s: Settings) -> list[tuple[int, tuple]]:
    """Write a node's split (or its value, if it has none) into the tree;
    returns its children with their sums."""
    leaf = lambda a: -s.learning_rate * a[0] / (a[1] + s.reg_lambda)
    _, feature, cut, left, total = split
    tree.value[node] = leaf(total)
    if feature < 0:
        return []
    tree.feature[node], tree.bin[node] = feature, cut
    right = tuple(t - x for t, x in zip(total, left))
    children = [(2 * node + 1, left), (2 * node + 2, right)]
    for child, sums in children:
        tree.value[child] = leaf(sums)
    return children


def grow_here(bins: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int, cols: np.ndarray, s: Settings) -> Tree:
    """A whole tree of at most ``depth`` levels from rows in memory. Rows whose
    node ended are left behind level by level. While the sums of a level are
    small enough to be held, siblings share theirs."""
    tree, active = Tree(depth), np.zeros(1, np.int64)
    columns, d = np.ascontiguousarray(bins.T), bins.shape[1]  # one feature's bins lie together
    at = np.zeros(len(g), np.int64)  # each row's place among the active nodes
    gh = g + 1j * h
    sums, pairs = None, np.zeros((0, 3), np.int64)
    for level in range(depth):
        pieces = _pieces(len(active), d, s.max_bins)
        if len(pieces) == 1:
            sums = sibling_sums(columns, at, gh, len(active), cols, s.max_bins, pairs, sums) if len(pairs) and sums is not None \
                else pair_sums(columns, at, gh, len(active), cols, s.max_bins)
            best = best_splits(sums, pieces[0], cols, s)
        else:
            sums, best = None, [None] * len(active)
            for features in pieces:
                mine = cols[(cols >= features.start) & (cols < features.stop)]
                part = pair_sums(columns[features.start:features.stop], at, gh, len(active), mine - features.start, s.max_bins)
                for i, found in enumerate(best_splits(part, features, cols, s)):
                    if _better(found, best[i]):
                        best[i] = found
        parents, active = active, np.array(
            [child for node, split in zip(active.tolist(), best)
             for child, sums in _put(tree, node, split, s) if sums[1] >= 2 * s.min_child_weight], np.int64)
        if not len(active) or level + 1 == depth:
            break
        slot = np.full((2 << depth) - 1, -1, np.int64)
        slot[active] = np.arange(len(active))
        both = slot[2 * parents + 1] >= 0, slot[2 * parents + 2] >= 0
        of = np.flatnonzero(both[0] & both[1])
        pairs = np.stack([slot[2 * parents[of] + 1], slot[2 * parents[of] + 2], of], 1)
        feature = tree.feature[parents].astype(np.int64)
        child = np.where(feature[:, None] >= 0, slot[2 * parents[:, None] + np.array([1, 2])], -1).reshape(-1)
        right = columns.reshape(-1).take(np.maximum(feature, 0).take(at) * len(at) + np.arange(len(at))) \
            > tree.bin[parents].take(at)
        at = child.take(2 * at + right)
        on = np.flatnonzero(at >= 0)
        if len(on) < len(at):
            columns, at, gh = columns[:, on], at[on], gh[on]
    return tree


def _chosen(number: int, rows: int, s: Settings, round_: int) -> np.ndarray:
    if s.subsample >= 1:
        return np.ones(rows, bool)
    return np.random.default_rng([s.seed, round_, number]).random(rows) < s.subsample


def _level(blocks: RDD, trees: list[Tree], active: list[list[int]], level: int, cols: np.ndarray, d: int,
           s: Settings, round_: int) -> list[tuple]:
    """One job: class, node and best split of every active node."""
    pieces = _pieces(max(map(len, active)), d, s.max_bins)
    groups = len(active) * len(pieces)

    def add(task: int, it: Iterator) -> Iterator[tuple]:
        mine = [(bins, *gradients(margin, y), _chosen(number, len(y), s, round_)) for number, bins, y, margin in it]
        for k, nodes in enumerate(active):
            slot = np.full((2 << s.max_depth) - 1, -1, np.int64)
            slot[nodes] = np.arange(len(nodes))
            rows = []
            for bins, g, h, chosen in mine if nodes else ():
                at = slot[trees[k].nodes(bins, level)]
                here = np.flatnonzero((at >= 0) & chosen)
                rows.append((bins[here], at[here], g[here, k], h[here, k]))
            for p, features in enumerate(pieces):
                if rows:
                    sums = sum(node_sums(*r, len(nodes), features, cols, s.max_bins) for r in rows).reshape(-1, 3)
                    filled = np.flatnonzero(sums[:, 2]).astype(np.int32)
                    yield task // MERGED * groups + k * len(pieces) + p, (task, filled, sums[filled])

    def merged(it: Iterator[tuple]) -> Iterator[tuple[int, np.ndarray]]:
        held: dict[int, list] = {}
        for key, part in it:
            held.setdefault(key, []).append(part)
        for key, parts in held.items():
            k, p = divmod(key % groups, len(pieces))
            total = np.zeros((len(active[k]) * len(pieces[p]) * s.max_bins, 3))
            for _, filled, sums in sorted(parts, key=lambda x: x[0]):  # the same order on every run
                total[filled] += sums
            yield key, total

    def merge_some(it: Iterator[tuple]) -> Iterator[tuple]:
        for key, total in merged(it):
            filled = np.flatnonzero(total[:, 2]).astype(np.int32)
            yield key // groups // MERGED * groups + key % groups, (key // groups, filled, total[filled])

    def split(it: Iterator[tuple]) -> Iterator[tuple]:
        for key, total in merged(it):
            k, p = divmod(key, len(pieces))
            shaped = total.reshape(len(active[k]), len(pieces[p]), s.max_bins, 3)
            for node, found in zip(active[k], best_splits(shaped, pieces[p], cols, s)):
                yield k, node, found

    sums = blocks.mapPartitionsWithIndex(add)
    tasks = -(-blocks.getNumPartitions() // MERGED)
    while tasks > 1:
        sums = sums.partitionBy(tasks * groups, int).mapPartitions(merge_some)
        tasks = -(-tasks // MERGED)
    return sums.partitionBy(min(groups, blocks.context.defaultParallelism), int).mapPartitions(split).collect()


def _subtrees(blocks: RDD, trees: list[Tree], roots: list[tuple[int, int]], cols: np.ndarray, s: Settings,
              round_: int) -> list[tuple]:
    """One job: the subtree below each of ``roots`` (class, node)."""
    def rows_of(it: Iterator) -> Iterator[tuple]:
        for number, bins, y, margin in it:
            g, h = gradients(margin, y)
            chosen, nodes = _chosen(number, len(y), s, round_), {}
            for i, (k, root) in enumerate(roots):
                if root == 0 and chosen.all():
                    yield i, (number, bins, np.ascontiguousarray(g[:, k]), np.ascontiguousarray(h[:, k]))
                    continue
                if k not in nodes:
                    nodes[k] = trees[k].nodes(bins, s.max_depth)
                here = np.flatnonzero((nodes[k] == root) & chosen)
                if len(here):
                    yield i, (number, bins[here], g[here, k], h[here, k])

    def finish(it: Iterator[tuple]) -> Iterator[tuple]:
        held: dict[int, list] = {}
        for i, part in it:
            held.setdefault(i, []).append(part)
        for i, parts in held.items():
            parts.sort(key=lambda x: x[0])
            depth = s.max_depth - ((roots[i][1] + 1).bit_length() - 1)
            tree = grow_here(*(np.concatenate([x[c] for x in parts]) for c in (1, 2, 3)), depth, cols, s)
            yield i, tree.feature, tree.bin, tree.value

    return blocks.mapPartitions(rows_of).partitionBy(min(len(roots), blocks.context.defaultParallelism), int) \
        .mapPartitions(finish).collect()


def _grafted(tree: Tree, root: int, feature: np.ndarray, cut: np.ndarray, value: np.ndarray) -> None:
    """Put a subtree's arrays in their places below ``root``."""
    for level in range((len(value) + 1).bit_length() - 1):
        here = slice((1 << level) - 1, (2 << level) - 1)
        there = slice((root + 1 << level) - 1, (root + 1 << level) - 1 + (1 << level))
        tree.value[there] = value[here]
        if here.stop <= len(feature):
            tree.feature[there], tree.bin[there] = feature[here], cut[here]


def _grow(blocks: RDD, rows: int, classes: int, d: int, s: Settings, round_: int) -> list[Tree]:
    """The trees of one round."""
    trees = [Tree(s.max_depth) for _ in range(classes)]
    rng = np.random.default_rng([s.seed, round_])
    cols = np.sort(rng.choice(d, max(1, round(s.colsample * d)), replace=False)) if s.colsample < 1 else np.arange(d)
    small: list[tuple[int, int]] = []
    active: list[list[int]] = [[] for _ in range(classes)]

    def sort_out(k: int, node: int, count: float) -> None:
        if count * d <= LOCAL_CELLS:
            small.append((k, node))
        else:
            active[k].append(node)

    for k in range(classes):
        sort_out(k, 0, rows)
    for level in range(s.max_depth):
        if not any(active):
            break
        best: dict[tuple[int, int], tuple] = {}
        for k, node, found in _level(blocks, trees, active, level, cols, d, s, round_):
            if _better(found, best.get((k, node))):
                best[k, node] = found
        active = [[] for _ in range(classes)]
        for (k, node), split in sorted(best.items()):
            for child, sums in _put(trees[k], node, split, s):
                if level + 1 < s.max_depth and sums[1] >= 2 * s.min_child_weight:
                    sort_out(k, child, sums[2])
    if small:
        for i, *arrays in _subtrees(blocks, trees, small, cols, s, round_):
            k, root = small[i]
            _grafted(trees[k], root, *arrays)
    return trees


def _moved(trees: list[Tree], depth: int):
    def run(block: tuple) -> tuple:
        number, bins, y, margin = block
        step = np.stack([t.value[t.nodes(bins, depth)] for t in trees], 1)
        return number, bins, y, margin + step
    return run


def quantile_bounds(x: DataFrame, names: list[str], max_bins: int) -> list[np.ndarray]:
    """Boundaries between at most ``max_bins`` bins of each column."""
    probs = [i / max_bins for i in range(1, max_bins)]
    found = x.approxQuantile(names, probs, 1.0 / (4 * max_bins))
    return [np.unique(np.array(b, float)) for b in found]


def _blocks(train: DataFrame, label_col: str, features_col: str, bounds: list[np.ndarray],
            columns: int) -> tuple[RDD, int]:
    """Blocks (number, bins, labels, scores) of the training rows, written once;
    and the number of rows."""
    spark = train.sparkSession
    d = len(bounds)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        held, size, number = [], 0, TaskContext.get().partitionId() << 24

        def out() -> pa.RecordBatch:
            bins, y = (np.concatenate([h[i] for h in held]) for i in (0, 1))
            return pa.record_batch([pa.array([number], pa.int64()), pa.array([bins.tobytes()], pa.binary()),
                                    pa.array([y.astype(np.int32).tobytes()], pa.binary())],
                                   names=["number", "bins", "y"])

        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            held.append((bin_rows(x, bounds), batch.column(1).to_numpy(zero_copy_only=False)))
            size += len(x)
            if size >= BLOCK_ROWS:
                yield out()
                held, size, number = [], 0, number + 1
        if size:
            yield out()

    rows = train.select(vector_to_array(features_col).alias("x"), F.col(label_col).cast("int").alias("y"))
    table = materialise(rows.mapInArrow(pack, "number bigint, bins binary, y binary"), "blocks")
    n = int((table.agg(F.sum(F.octet_length("y"))).first()[0] or 0) // 4)
    count = max(1, -(-n // BLOCK_ROWS))
    tasks = min(count, max(spark.sparkContext.defaultParallelism, count // TASK_BLOCKS))

    def load(row) -> tuple:
        y = np.frombuffer(row.y, np.int32)
        return row.number, np.frombuffer(row.bins, np.uint8).reshape(len(y), d), y, np.zeros((len(y), columns))

    return table.repartitionByRange(tasks, "number").rdd.map(load), n


def fit_boosted(train: DataFrame, label_col: str, classes: list[int], features_col: str = "features",
                **settings) -> BoostedModel:
    """Boosted trees for labels 0 .. max(classes); ``settings``: see Settings."""
    s = Settings(**settings)
    s.check()
    spark = train.sparkSession
    ship_package(spark)
    checkpoint_dir(spark)
    first = train.select(F.size(vector_to_array(features_col))).first()
    if first is None:
        raise ValueError("no rows to train on")
    d, width = first[0], max(classes) + 1
    columns = 1 if width == 2 else width
    names = [f"f{j}" for j in range(d)]
    x = train.select(*[vector_to_array(features_col)[j].alias(n) for j, n in enumerate(names)])
    bounds = quantile_bounds(x, names, s.max_bins)
    blocks, rows = _blocks(train, label_col, features_col, bounds, columns)
    blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)
    rounds: list[list[Tree]] = []
    older = None
    for i in range(s.rounds):
        rounds.append(_grow(blocks, rows, columns, d, s, i))
        if older is not None:  # this round's jobs have read ``blocks``, so it stands on its own
            older.unpersist()
        older, blocks = blocks, blocks.map(_moved(rounds[-1], s.max_depth)).persist(StorageLevel.MEMORY_AND_DISK)
        if (i + 1) % s.cut_every == 0 and i + 1 < s.rounds:
            blocks.checkpoint()
            blocks.count()
    older.unpersist()
    blocks.unpersist()
    stack = lambda what: np.array([[getattr(t, what) for t in r] for r in rounds])
    return BoostedModel(bounds, stack("feature"), stack("bin"), stack("value"), width, features_col)


class BoostedModel(Model):
    """Boosted trees with ``probability`` (one per class code) and
    ``prediction`` (the most probable class, the lowest among equals)."""

    def __init__(self, bounds, feature, bin_, value, classes: int, features_col: str = "features"):
        super().__init__()
        self.bounds, self.feature, self.bin, self.value = bounds, feature, bin_, value
        self.classes, self.features_col = classes, features_col

    @property
    def rounds(self) -> int:
        return len(self.feature)

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Summed scores of some rows, all trees of a round at once."""
        bins = bin_rows(x, self.bounds)
        n, columns = len(x), self.feature.shape[1]
        out, row, col = np.zeros((n, columns)), np.arange(n)[:, None], np.arange(columns)[None, :]
        inner = self.feature.shape[2]
        for feature, cut, value in zip(self.feature, self.bin, self.value):
            node = np.zeros((n, columns), np.int64)
            for level in range(inner.bit_length()):
                at = np.minimum(node, inner - 1)
                f = np.where(node < inner, feature[col, at], -1)
                node = np.where(f >= 0, 2 * node + 1 + (bins[row, np.maximum(f, 0)] > cut[col, at]), node)
            out += value[col, node]
        return out

    def _transform(self, df: DataFrame) -> DataFrame:
        ship_package(df.sparkSession)
        model = (self.bounds, self.feature, self.bin, self.value, self.classes)

        @F.pandas_udf("array<double>")
        def score(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=object)
            return pd.Series(list(probabilities(BoostedModel(*model).margins(np.stack(x.to_numpy())))))

        p = score(vector_to_array(self.features_col))
        scored = df.withColumn("probability", p)
        best = F.array_position("probability", F.array_max("probability")) - 1
        return scored.withColumn("prediction", best.cast("double")) \
            .withColumn("probability", array_to_vector("probability"))

    def save(self, path: str) -> None:
        """The trees as Parquet, boundaries and sizes as JSON."""
        from pyspark.sql import SparkSession
        spark = SparkSession.getActiveSession()
        rows = [(i, k, self.feature[i, k].tolist(), self.bin[i, k].tolist(), self.value[i, k].tolist())
                for i in range(self.rounds) for k in range(self.feature.shape[1])]
        spark.createDataFrame(rows, "round int, class int, feature array<int>, bin array<int>, value array<double>") \
            .write.mode("overwrite").parquet(f"{path}/trees")
        meta = {"bounds": [b.tolist() for b in self.bounds], "classes": self.classes, "features": self.features_col}
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1) \
            .write.mode("overwrite").json(f"{path}/metadata")

    @classmethod
    def load(cls, path: str) -> BoostedModel:
        from pyspark.sql import SparkSession
        spark = SparkSession.getActiveSession()
        meta = json.loads(spark.read.json(f"{path}/metadata").first()["meta"])
        rows = spark.read.parquet(f"{path}/trees").orderBy("round", "class").collect()  # rounds x classes trees
        columns = max(r["class"] for r in rows) + 1
        stack = lambda what, kind: np.array([r[what] for r in rows], kind).reshape(
            -1, columns, len(rows[0][what]))
        return cls([np.array(b, float) for b in meta["bounds"]], stack("feature", np.int16), stack("bin", np.uint8),
                   stack("value", float), meta["classes"], meta["features"])
