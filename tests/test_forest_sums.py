"""Splits of forests: the same whether sums are laid out whole or by filled
cells, and rows reach the nodes that they lie in."""

from __future__ import annotations

import numpy as np
import pytest

from flowforge.operators import forest as FO


def _rows(n, bins=6, d=3, classes=3):
    rng = np.random.default_rng(8)
    return rng.integers(0, bins, (n, d)).astype(np.uint8), rng.integers(0, classes, n), rng.integers(1, 4, n).astype(float)


@pytest.mark.parametrize("min_rows", [1, 5])
def test_splits_do_not_depend_on_how_sums_are_laid_out(min_rows):
    """Few rows a node are summed by filled cells, many rows as one block."""
    bins, y, w = _rows(400)
    found = []
    for wide in (8, 256):
        s = FO.Settings(3, max_bins=wide, features=2, min_rows=min_rows)
        at, drawn = np.arange(400) % 4, np.array([[0, 1], [2, 0], [1, 2], [0, 2]])
        total = np.bincount(at * 3 + y, w, 12).reshape(4, 3)
        columns = np.ascontiguousarray(bins.T)
        found.append(FO.best_splits(columns, np.arange(400), y, w, np.ones(400), at, drawn, total, np.bincount(at) * 1.0, s))
        assert (4 * wide * 3 <= 400) == (wide == 8)
    for a, b in zip(*found):
        assert np.array_equal(a, b)


def test_places_point_into_the_columns():
    """Rows may have left since the columns were cut."""
    bins, y, w = _rows(300)
    keep = np.flatnonzero(np.arange(300) % 3 > 0)
    s, one = FO.Settings(3, max_bins=8, features=3), np.zeros(len(keep), int)
    total = np.bincount(y[keep], w[keep], 3)[None]
    args = (y[keep], w[keep], np.ones(len(keep)), one, np.array([[0, 1, 2]]), total, np.array([len(keep)]), s)
    whole = FO.best_splits(np.ascontiguousarray(bins.T), keep, *args)
    cut = FO.best_splits(np.ascontiguousarray(bins[keep].T), np.arange(len(keep)), *args)
    assert all(np.array_equal(a, b) for a, b in zip(whole, cut))


def test_rows_reach_their_leaves():
    bins, y, w = _rows(500)
    s = FO.Settings(3, max_bins=8, features=3)
    feature, cut, left, value, _ = FO.grow_here(bins, y, w, np.ones(500), 0, 9, 0, s)
    assert (feature >= 0).sum() > 30
    want = []
    for row in bins:
        node = 0
        while feature[node] >= 0:
            node = left[node] + (row[feature[node]] > cut[node])
        want.append(node)
    assert FO.ends((feature, cut, left, value), bins).tolist() == want
    for node in set(want):
        here = np.array(want) == node
        assert np.allclose(value[node], np.bincount(y[here], w[here], 3) / w[here].sum(), atol=1e-6)


def test_rows_are_dealt_to_the_nodes_asked_for():
    """Roots of two trees, told alternately; some rows of a tree lie in none."""
    bins, y, w = _rows(200)
    drawn = np.random.default_rng(1).poisson(1.0, (2, 200)).astype(np.uint8)
    tree = (np.array([0, -1, 1, -1, -1], np.int16), np.array([2, 0, 3, 0, 0], np.uint8), np.array([1, 0, 3, 0, 0], np.int32))
    roots = [(0, 4, 6, 3), (1, 1, 1, 4), (0, 1, 1, 4), (1, 3, 5, 3)]
    got = {i: rows for i, _, *rows in FO._by_root([(7, bins, y, w, drawn)], {0: tree, 1: tree}, roots)}
    node = FO.ends(tree, bins)
    assert sorted(got) == [0, 1, 2, 3]
    for i, (b, labels, weights, counts) in got.items():
        own = drawn[roots[i][0]]
        here = (node == roots[i][1]) & (own > 0)
        assert np.array_equal(b, bins[here]) and np.array_equal(labels, y[here]) and np.array_equal(weights, w[here])
        assert np.array_equal(counts, own[here])
