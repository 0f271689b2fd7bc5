"""Forests: few jobs whatever the depth, the same trees wherever the line between
shuffled sums and finished subtrees is drawn, and what a forest must obey."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from flowforge.operators import features as FE
from flowforge.operators import forest as FO
from flowforge.operators import models as M


@pytest.fixture(scope="module")
def noisy(spark):
    """Three classes: two by a rule, one at random, so pure leaves lie deep."""
    d = spark.range(4000).select(
        F.col("id").alias("flow_id"), *[(F.xxhash64(F.lit(j), "id") % 1000 / 1000.0).alias(f"f{j}") for j in range(4)],
        F.when(F.xxhash64(F.lit(9), "id") % 20 == 0, 2).otherwise((F.xxhash64(F.lit(0), "id") % 1000 > 0).cast("int"))
        .alias("Label_Multi"))
    return VectorAssembler(inputCols=[f"f{j}" for j in range(4)], outputCol="features").transform(d).cache()


def _jobs(spark, run):
    sc, group = spark.sparkContext, f"forest-{np.random.randint(1 << 30)}"
    sc.setJobGroup(group, "")
    try:
        out = run()
        return out, len(sc.statusTracker().getJobIdsForGroup(group))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_jobs_do_not_follow_the_nodes_of_a_forest(spark, noisy):
    """Spark ML's forest takes a job a level at least, more for many nodes."""
    est = M.make_estimator("RandomForest", "multi", 4000, "Label_Multi", None, params={"numTrees": 8})
    model, jobs = _jobs(spark, lambda: est.fit(noisy))
    depth = max(max(_depths(t)) for t in model.trees)
    assert depth > 12 and jobs <= 12
    names = [f"f{j}" for j in range(4)]
    top, jobs = _jobs(spark, lambda: FE.importance_topk(noisy.select(*names, "Label_Multi"), names, num_trees=8).collect())
    assert jobs <= 13 and sum(r["importance"] for r in top) == pytest.approx(1) and top[0]["feature"] == "f0"


def _depths(tree):
    feature, _, left, _ = tree
    depth = np.zeros(len(feature), int)
    stack = [(0, 0)]
    while stack:
        node, n = stack.pop()
        depth[node] = n
        if feature[node] >= 0:
            stack += [(left[node], n + 1), (left[node] + 1, n + 1)]
    return depth


def test_trees_do_not_depend_on_where_tasks_take_over(spark, noisy, monkeypatch):
    def grown():
        return FO.ForestClassifier("Label_Multi", numTrees=3, maxDepth=12, minInstancesPerNode=2).fit(noisy)
    whole = grown()
    monkeypatch.setattr(FO, "LOCAL_ROWS", 300)
    monkeypatch.setattr(FO, "GROUP_ROWS", 8000)  # two trees, then one
    cut = grown()
    x = np.random.default_rng(1).random((500, 4))
    for a, b in zip(whole.trees, cut.trees):
        assert len(a[0]) == len(b[0])
        assert np.array_equal(*(FO.forest_probabilities(x, whole.bounds, [t], 3) for t in (a, b)))
    assert np.allclose(whole.importances, cut.importances)


@pytest.mark.parametrize("impurity", ["gini", "entropy"])
def test_a_split_is_the_best_of_all(impurity):
    rng = np.random.default_rng(3)
    bins, y, w = rng.integers(0, 5, (60, 2)).astype(np.uint8), rng.integers(0, 3, 60), rng.random(60) + 0.5
    s = FO.Settings(3, max_bins=8, features=2, min_rows=4, impurity=impurity)
    feature, cut, *_ = FO.grow_here(bins, y, w, np.ones(60), 0, 1, 0, s)

    def badness(rows):
        p = np.bincount(y[rows], w[rows], 3)
        q = p[p > 0] / p.sum()
        return p.sum() * (1 - (q * q).sum() if impurity == "gini" else -(q * np.log2(q)).sum())

    def after(f, b):
        right = bins[:, f] > b
        return badness(right) + badness(~right) if min(right.sum(), (~right).sum()) >= 4 else np.inf
    want = min((after(f, b), f, b) for f in range(2) for b in range(5))
    assert after(feature[0], cut[0]) == pytest.approx(want[0])


def test_a_saved_forest_scores_alike(spark, noisy, tmp_path):
    weighed = noisy.withColumn("weight", F.lit(1.0) + F.col("Label_Multi"))
    model = M.fit_model("RandomForest", "multi", weighed, "Label_Multi", [0, 1, 2], 4000, "weight", {"numTrees": 5})
    M.save_model(model, str(tmp_path / "forest"))
    back = M.load_model("RandomForest", "multi", str(tmp_path / "forest"))
    rows = [m.transform(noisy).select("flow_id", "prediction", vector_to_array("probability").alias("p"), "Label_Multi")
            .orderBy("flow_id").collect() for m in (model, back)]
    assert rows[0] == rows[1]
    assert all(abs(sum(r["p"]) - 1) < 1e-9 and r["p"][int(r["prediction"])] == max(r["p"]) for r in rows[0])
    assert sum(r["prediction"] == r["Label_Multi"] for r in rows[0]) > 3800  # grown until pure
    assert back.featureImportances == model.featureImportances


def test_a_forest_of_few_or_equal_rows(spark):
    rows = spark.createDataFrame([(0, 1.0), (0, 1.0)], "y int, a double")
    d = VectorAssembler(inputCols=["a"], outputCol="features").transform(rows)
    model = FO.ForestClassifier("y", numTrees=3).fit(d)
    assert [r["prediction"] for r in model.transform(d).collect()] == [0.0, 0.0]
    with pytest.raises(ValueError):
        FO.ForestClassifier("y").fit(d.limit(0))
