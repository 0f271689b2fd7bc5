"""Sums of a boosted tree: siblings share theirs, equal gains are told from
rounding, and few tasks read the blocks."""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from flowforge.operators import boosting as B


def _rows(n=900, d=4, bins=8):
    rng = np.random.default_rng(2)
    return rng.integers(0, bins, (n, d)).astype(np.uint8), rng.normal(size=n), rng.random(n) + 0.1


def test_sums_taken_from_a_parent_are_the_rows_own(monkeypatch):
    monkeypatch.setattr(B, "ADD_ROWS", 100)
    bins, g, h = _rows()
    columns, gh, cols = np.ascontiguousarray(bins.T), g + 1j * h, np.array([0, 2, 3])
    split = (bins[:, 0] > 2).astype(int)
    parents = B.pair_sums(columns, np.zeros(len(g), int), gh, 1, cols, 8)
    want = B.node_sums(bins, split, g, h, 2, range(4), cols, 8)[..., :2]
    got = B.sibling_sums(columns, split, gh, 2, cols, 8, np.array([[0, 1, 0]]), parents)
    assert np.allclose(got, want, atol=1e-12) and not got[:, 1].any()


def test_trees_do_not_depend_on_what_is_held(monkeypatch):
    bins, g, h = _rows()
    s = B.Settings(max_bins=8, max_depth=5)
    whole = B.grow_here(bins, g, h, 5, np.arange(4), s)
    monkeypatch.setattr(B, "HELD_SUMS", 16)  # no sums are held, so none come from a parent
    plain = B.grow_here(bins, g, h, 5, np.arange(4), s)
    assert (whole.feature >= 0).sum() > 10
    assert np.array_equal(whole.feature, plain.feature) and np.array_equal(whole.bin, plain.bin)
    assert np.allclose(whole.value, plain.value, atol=1e-12)


def test_the_first_of_equal_gains_wins_whatever_the_rounding():
    bins, g, h = _rows(d=1)
    one = B.pair_sums(np.ascontiguousarray(bins.T), np.zeros(len(g), int), g + 1j * h, 1, np.arange(1), 8)
    sums = np.concatenate([one, one * (1 + 1e-13)], 1)  # the second feature seems better by rounding alone
    (_, feature, *_), = B.best_splits(sums, range(2), np.arange(2), B.Settings(max_bins=8))
    assert feature == 0


def test_steps_through_a_tree_stop_where_it_ends():
    tree = B.Tree(3)
    tree.feature[[0, 2]], tree.bin[[0, 2]] = [1, 0], [3, 200]
    bins = np.array([[250, 0], [250, 9], [0, 9]], np.uint8)
    assert [tree.nodes(bins, depth).tolist() for depth in range(4)] == [[0] * 3, [1, 2, 2], [1, 6, 5], [1, 6, 5]]


def test_blocks_are_read_by_a_task_a_core(spark, monkeypatch):
    monkeypatch.setattr(B, "BLOCK_ROWS", 64)
    d = spark.range(2560).select((F.col("id") % 50).cast("double").alias("a"), (F.col("id") % 2).cast("int").alias("y"))
    data = VectorAssembler(inputCols=["a"], outputCol="features").transform(d)
    blocks, rows = B._blocks(data, "y", "features", [np.array([10.0, 30.0])], 1)
    assert rows == 2560 and blocks.getNumPartitions() <= spark.sparkContext.defaultParallelism
    assert sum(len(y) for _, _, y, _ in blocks.collect()) == 2560
