"""A random search scores every draw on every fold."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from flowforge.operators import tune as TU
from flowforge.plans import q_tune as Q
from flowforge.plans import training as T


def test_every_candidate_meets_every_fold(monkeypatch):
    """The best in the mean is the worst on the first fold, where halving drops it."""
    met = []
    monkeypatch.setattr(TU.M, "fit_model", lambda family, task, train, *a: met.append((train, a[4])) or (train, a[4]))
    monkeypatch.setattr(TU, "weighted_f1", lambda m, valid, label: {0: 0.4, 1: 0.9, 2: 0.9}[m[0]] if m[1]["C"] == 10.0 else 0.5)
    folds = [TU.Fold(n, None, 1) for n in range(3)]
    draws = [{"C": c} for c in (0.01, 0.1, 1, 10, 100)]
    runs = TU.whole_search("LogisticRegression", "multi", folds, [0], draws)
    assert sorted((n, p["C"]) for n, p in met) == sorted((n, float(d["C"])) for n in range(3) for d in draws)
    assert [r["params"] for r in runs] == draws and all(len(r["scores"]) == 3 for r in runs)
    assert TU.best_candidate(runs, 3) == {"params": {"C": 10}, "scores": [0.4, 0.9, 0.9]}


@pytest.mark.parametrize("family,draws", [("DecisionTree", 15), ("LogisticRegression", 10)])
def test_registered_searches_leave_no_fold_out(spark, monkeypatch, family, draws):
    raw = spark.range(120).select(
        F.col("id").alias("flow_id"), (F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"),
        (F.col("id") % 2).cast("int").alias("Label_Multi"), (F.col("id") % 2).cast("int").alias("Label_Binary"),
        F.when(F.col("id") % 4 == 0, "test").otherwise("train").alias("split"))
    mapping = spark.createDataFrame([(0, "BENIGN"), (1, "Bot")], "code int, label string")
    monkeypatch.setattr(T, "prepare", lambda *a: T.Prepared(raw, ["a", "b"], {}, mapping, [0, 1], 90, raw))
    monkeypatch.setattr(TU.M, "fit_model", lambda *a: None)
    monkeypatch.setattr(TU, "weighted_f1", lambda *a: 0.5)
    _, (result,) = Q._search(spark, "", [family])
    assert result["fits"] == 3 * draws
