"""Boosted trees against a plain booster on small inputs."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from flowforge.operators import boosting as B
from flowforge.operators import models as M
from flowforge.plans import training as T


def brute_boost(bins, y, classes, bounds, s):
    """Second-order boosting, one node at a time."""
    n, columns = len(y), 1 if classes == 2 else classes
    margin = [[0.0] * columns for _ in range(n)]

    def proba(m):
        if columns == 1:
            p = 1 / (1 + math.exp(-m[0]))
            return [p]
        e = [math.exp(x - max(m)) for x in m]
        return [x / sum(e) for x in e]

    forest = []
    for _ in range(s.rounds):
        p = [proba(m) for m in margin]
        trees = []
        for k in range(columns):
            target = [(yi == 1) if columns == 1 else (yi == k) for yi in y]
            g = [p[i][k] - target[i] for i in range(n)]
            h = [(1 if columns == 1 else 2) * p[i][k] * (1 - p[i][k]) for i in range(n)]
            tree = {}

            def build(node, rows, depth):
                G, H = sum(g[i] for i in rows), sum(h[i] for i in rows)
                value = -s.learning_rate * G / (H + s.reg_lambda)
                best = (B.LEAST_GAIN, None)
                if depth < s.max_depth:
                    for j in range(len(bounds)):
                        for b in range(len(bounds[j])):
                            left = [i for i in rows if bins[i][j] <= b]
                            gl, hl = sum(g[i] for i in left), sum(h[i] for i in left)
                            if hl < s.min_child_weight or H - hl < s.min_child_weight:
                                continue
                            gain = gl ** 2 / (hl + s.reg_lambda) + (G - gl) ** 2 / (H - hl + s.reg_lambda) \
                                - G ** 2 / (H + s.reg_lambda)
                            if gain > best[0] + 1e-9:
                                best = (gain, (j, b))
                if best[1] is None:
                    for i in rows:
                        margin[i][k] += value
                    tree[node] = (value,)
                    return
                j, b = best[1]
                tree[node] = (j, b)
                build(2 * node + 1, [i for i in rows if bins[i][j] <= b], depth + 1)
                build(2 * node + 2, [i for i in rows if bins[i][j] > b], depth + 1)

            build(0, list(range(n)), 0)
            trees.append(tree)
        forest.append(trees)
    return forest


def table(spark, n, classes, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        x = [rng.random(), rng.random() * 10, float(rng.randrange(7))]
        y = int(x[0] * classes) if rng.random() < 0.8 else rng.randrange(classes)
        rows.append((i, *x, y if x[2] < 5 else classes - 1))
    d = spark.createDataFrame(rows, "flow_id int, a double, b double, c double, y int").repartition(3)
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(d).cache()


@pytest.mark.parametrize("classes,cells", [(3, 1 << 22), (3, 0), (2, 200), (2, 0)])
def test_boosting_agrees_with_a_plain_booster(spark, monkeypatch, classes, cells):
    """By sums only, by whole subtrees only, and by both."""
    monkeypatch.setattr(B, "LOCAL_CELLS", cells)
    monkeypatch.setattr(B, "BLOCK_ROWS", 64)
    monkeypatch.setattr(B, "HELD_SUMS", 16)
    monkeypatch.setattr(B, "MERGED", 2)
    data = table(spark, 240, classes, classes)
    s = dict(rounds=3, learning_rate=0.3, max_depth=3, max_bins=8, cut_every=2)
    model = B.fit_boosted(data, "y", list(range(classes)), **s)
    rows = data.select("a", "b", "c", "y").collect()
    x = np.array([r[:3] for r in rows])
    bins = B.bin_rows(x, model.bounds)
    want = brute_boost(bins.tolist(), [r["y"] for r in rows], classes, model.bounds, B.Settings(**s))
    for trees, feature, cut, value in zip(want, model.feature, model.bin, model.value):
        for k, tree in enumerate(trees):
            for node, what in tree.items():
                if len(what) == 2:
                    assert (feature[k, node], cut[k, node]) == what
                else:
                    assert node >= feature.shape[1] or feature[k, node] == -1
                    assert value[k, node] == pytest.approx(what[0], abs=1e-9)


def test_boosting_learns_samples_and_keeps(spark):
    data = table(spark, 1200, 4, 9)
    few = B.fit_boosted(data, "y", [0, 1, 2, 3], rounds=2, subsample=0.7, colsample=0.7, seed=5)
    again = B.fit_boosted(data, "y", [0, 1, 2, 3], rounds=2, subsample=0.7, colsample=0.7, seed=5)
    assert np.array_equal(few.feature, again.feature) and np.allclose(few.value, again.value)
    many = B.fit_boosted(data, "y", [0, 1, 2, 3], rounds=30)
    hit = lambda m: m.transform(data).agg(F.avg((F.col("prediction") == F.col("y")).cast("double"))).first()[0]
    assert hit(many) > max(hit(few), 0.8) and many.rounds == 30
    path = T.model_path(spark, "test-boosted")
    M.save_model(many, path)
    back = M.load_model("BoostedTrees", "multi", path)
    assert M.predict_with_proba(many, data).exceptAll(M.predict_with_proba(back, data)).count() == 0


def test_boosting_edges(spark):
    data = table(spark, 60, 3, 1)
    with pytest.raises(ValueError):
        B.fit_boosted(data.where("y > 9"), "y", [0, 1, 2], rounds=1)
    with pytest.raises(ValueError):
        B.fit_boosted(data, "y", [0, 1, 2], max_depth=40)
    one = B.fit_boosted(data.where("y = 1"), "y", [0, 1, 2], rounds=2)  # nothing to split
    assert one.transform(data).where("prediction <> 1").count() == 0
    assert one.transform(data.where("y > 9")).count() == 0
