"""The pivot search against brute force: many features of one variance, few
features that carry the spread, ties, copies, tiny classes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowforge.operators import neighbours as NB
from flowforge.operators import resample as RS


def _brute(x, keys, labels, k):
    out = {}
    for i in range(len(x)):
        same = [j for j in range(len(x)) if j != i and labels[j] == labels[i]]
        d2 = np.zeros(len(same))
        for f in range(x.shape[1]):
            d2 += (x[i, f] - x[same, f]) ** 2
        out[keys[i]] = sorted(np.sqrt(d2))[:k]
    return out


def _check(spark, x, labels, k=5, parts=4):
    cols = [f"f{i}" for i in range(x.shape[1])]
    rows = [(i, int(c), *map(float, v)) for i, (c, v) in enumerate(zip(labels, x))]
    df = spark.createDataFrame(rows, "flow_id long, Label_Multi int, " + ", ".join(f"{c} double" for c in cols)).repartition(parts)
    report = {}
    got = {}
    for r in RS.knn_within_class(df, cols, k=k, report=report).collect():
        got.setdefault(r["flow_id"], {})[r["nb_rank"]] = r["dist"]
    want = _brute(x, range(len(x)), labels, k)
    assert {i: w for i, w in want.items() if w}.keys() == got.keys()
    for i, d in got.items():
        assert sorted(d) == list(range(1, len(want[i]) + 1))
        assert [d[n] for n in sorted(d)] == pytest.approx(want[i], abs=1e-9)
    return report


@pytest.fixture(autouse=True)
def small_blocks(monkeypatch):
    monkeypatch.setattr(NB, "BLOCK_ROWS", 32)
    monkeypatch.setattr(NB, "PIVOTS", 16)


def test_thirty_features_of_one_variance(spark):
    rng = np.random.default_rng(3)
    _check(spark, rng.normal(size=(700, 30)), rng.integers(0, 2, 700))


def test_few_candidates_where_two_features_carry_the_spread(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1500, 6)) * np.array([1000, 800, 1, 1, 0.1, 0])
    report = _check(spark, x, np.zeros(1500, dtype=int))
    assert report["asking"] == 1500 and report["candidates_per_row"] < 1500 / 2


def test_a_class_eight_times_as_large_has_no_more_candidates_a_row(spark):
    seen = []
    for n in (1000, 8000):
        x = np.random.default_rng(7).normal(size=(n, 3)) * np.array([1000, 800, 600])
        df = spark.createDataFrame([(i, 0, *map(float, v)) for i, v in enumerate(x)],
                                   "flow_id long, Label_Multi int, a double, b double, c double")
        report = {}
        assert RS.knn_within_class(df, ["a", "b", "c"], report=report).count() == 5 * n
        seen.append(report["candidates_per_row"])
    assert seen[1] < 2 * seen[0]


def test_cuts_deal_every_vector_once_and_boxes_lose_none():
    rng = np.random.default_rng(8)
    x = np.r_[rng.normal(size=(500, 3)), np.zeros((90, 3)), rng.integers(0, 2, size=(300, 3))]
    parts = NB.cut_up(x, 32)
    assert sorted(np.concatenate(parts)) == list(range(len(x))) and max(map(len, parts)) <= 32
    nodes = NB.grown(x, 32)
    leaf, n = NB.leaf_of(nodes, x), sum(f < 0 for f, *_ in nodes)
    assert set(leaf) == set(range(n))
    los, his = (np.array([f(x[leaf == i], axis=0) for i in range(n)]) for f in (np.min, np.max))
    d, bound = np.sqrt(NB.square_distances(x[:40], x)), np.full(40, 0.4)
    hit = {int(leaf[j]) for j in np.flatnonzero((d <= 0.4).any(axis=0))}
    assert hit <= set(NB.cells_near(x[:40], bound, los, his).tolist())


def test_ties_copies_and_tiny_classes(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 6, size=(400, 3)).astype(float)  # a lattice: ties everywhere, many copies
    x[:140] = [2.0, 3.0, 1.0]  # a third of the rows are one vector
    labels = np.zeros(400, dtype=int)
    labels[-1], labels[-3:-1], labels[-9:-3] = 9, 8, 7  # classes of one, two and six rows
    _check(spark, x, labels, k=7)


def test_bounds_hold_and_blocks_beyond_them_hold_no_neighbour():
    rng = np.random.default_rng(6)
    x, pivots = rng.normal(size=(60, 4)), rng.normal(size=(8, 4))
    need = np.full(60, 3)
    dp = np.sqrt(NB.square_distances(x, pivots))
    bound = NB.upper_bounds(x[:20], need[:20], dp[:20])
    d = np.sqrt(NB.square_distances(x[:20], x))
    d[np.arange(20), np.arange(20)] = np.inf
    assert (np.sort(np.c_[d, dp[:20]], axis=1)[:, 2] <= bound + 1e-12).all()
    at = {p: (lo, hi) for p, lo, hi in NB.intervals(need[:20], bound, dp[:20])}
    for i in range(20):
        for j in np.flatnonzero(d[i] <= bound[i]):
            cell = dp[j].argmin()
            assert cell in at and at[cell][0] <= dp[j, cell] <= at[cell][1]
    assert NB.intervals(np.zeros(20, dtype=int), bound, dp[:20]) == []


def test_empty_table(spark):
    df = spark.createDataFrame([], "flow_id long, Label_Multi int, a double")
    assert RS.knn_within_class(df, ["a"]).count() == 0
    assert RS.smote_oversample(df, ["a"]).count() == 0
    one = spark.createDataFrame([(1, 0, 2.0)], "flow_id long, Label_Multi int, a double")
    assert RS.knn_within_class(one, ["a"]).count() == 0 and RS.smote_oversample(one, ["a"]).count() == 1
