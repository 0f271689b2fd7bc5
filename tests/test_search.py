"""Search, refit, bundle and promotion."""

import pytest
from pyspark.sql import functions as F

from flowforge.operators import bundle as B
from flowforge.operators import models as M
from flowforge.operators import tune as TU
from flowforge.plans import training as T

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def prepared(spark):
    return T.prepare(spark, SF_SMALL)


def test_synthetic_rows_are_in_no_validation_fold(spark, prepared):
    train = prepared.raw.where(F.col("split") == "train")
    folds = TU.search_folds(train, prepared.cols, prepared.mapping, 2, oversample=True)
    original = {r[0] for r in train.select("flow_id").collect()}
    seen = []
    for f in folds:
        valid = [r[0] for r in f.valid.select("flow_id").collect()]
        fit = f.train.select("flow_id", "is_synthetic", "Label_Multi").collect()
        own = {r["flow_id"] for r in fit if not r["is_synthetic"]}
        assert set(valid) <= original and own == original - set(valid)
        made = [r for r in fit if r["is_synthetic"]]
        assert made and not {r["flow_id"] for r in made} & original
        per = f.train.groupBy("Label_Multi").count().collect()
        assert max(r["count"] for r in per) == min(r["count"] for r in per if r["count"] > 1)
        # scaled by the training fold's own original rows
        c = prepared.cols[0]
        row = f.train.where(~F.col("is_synthetic")).agg(F.avg(c), F.stddev_pop(c)).first()
        assert abs(row[0]) < 1e-9 and abs(row[1] - 1) < 1e-9
        seen += valid
    assert sorted(seen) == sorted(original)


def test_halving_keeps_the_better_half(monkeypatch):
    """Candidates by known scores: all meet the first fold, half the second, a quarter the third."""
    met = []

    def fit(family, task, train, *a):
        met.append((train, a[4]["minInstancesPerNode"]))
        return a[4]["minInstancesPerNode"]

    monkeypatch.setattr(TU.M, "fit_model", fit)
    monkeypatch.setattr(TU, "weighted_f1", lambda m, valid, label: 1 / (1 + abs(m - 6)))
    folds = [TU.Fold(n, None, 1) for n in range(3)]
    runs = TU.halving_search("DecisionTree", "multi", folds, [0], [{"min_samples_leaf": i} for i in range(9)])
    assert [len([m for m in met if m[0] == n]) for n in range(3)] == [9, 5, 3]
    assert TU.best_candidate(runs, 3)["params"] == {"min_samples_leaf": 6}
    assert {i for n, i in met if n == 2} == {5, 6, 7}


def test_bundle_alone_scores_raw_rows_and_promotion_switches(spark, prepared, tmp_path):
    store = str(tmp_path / "store")
    assert B.current(spark, store) is None
    raw = prepared.raw.where(F.col("split") == "test").select("flow_id", *prepared.cols)
    made = []
    for depth in (2, 8):
        m = M.fit_model("DecisionTree", "multi", prepared.split("train"), "Label_Multi", prepared.classes,
                        prepared.n_train, params={"maxDepth": depth})
        b = B.Bundle("DecisionTree", "multi", m, prepared.cols, prepared.scaler, prepared.mapping, {"max_depth": depth}, {"f1": 0.5})
        made.append((b, B.save_bundle(spark, store, b)))
    for n, (b, path) in enumerate(made):
        assert B.promote(spark, store, path, 0.5) == n + 1
        now = B.current(spark, store)
        assert now.params == b.params and now.features == prepared.cols and now.scores == {"f1": 0.5}
        got, want = now.score(raw)[0], b.score(raw)[0]
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert B.promote(spark, store, made[0][1], 0.6) == 3  # back to the first
    assert B.current(spark, store).params == {"max_depth": 2}
    assert [r["number"] for r in B.promotions(spark, store).collect()] == [1, 2, 3]


def test_unfinished_bundle_is_not_promoted(spark, prepared, tmp_path):
    store = str(tmp_path / "store")
    prepared.mapping.select("code", "label").write.parquet(f"{store}/DecisionTree-multi/x/mapping")
    with pytest.raises(ValueError):
        B.promote(spark, store, f"{store}/DecisionTree-multi/x", 1.0)
    assert B.current(spark, store) is None


def test_best_of_two_families_is_promoted(spark, prepared, tmp_path):
    train, test = (prepared.raw.where(F.col("split") == n) for n in ("train", "test"))
    results = TU.random_search_cv(["DecisionTree", "LogisticRegression"], train, test, prepared.cols, prepared.mapping,
                                  prepared.classes, n_iter=2, k=2)
    paths, report = TU.promote_search(spark, str(tmp_path), results)
    rows = {r["model_name"]: r for r in report.collect()}
    assert set(rows) == {"DecisionTree", "LogisticRegression"} and len(paths) == 2
    best = max(rows.values(), key=lambda r: r["tuned_f1"])
    assert B.current(spark, str(tmp_path)).name == best["model_name"]
    assert all(r["fits"] == 3 for r in results)  # two on the first fold, one on the second
