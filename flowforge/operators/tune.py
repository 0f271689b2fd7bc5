"""Hyper-parameter search.

The grid is a DataFrame (one row per combination, built by exploding each
axis). The search draws ``n_iter`` combinations in md5(id|seed) order and
scores them on weighted F1 over ``k`` stratified folds (from the hashed class
rank, so they are exact and partition-independent). Whatever is learnt from
rows (scaling, oversampling, class weights) is learnt inside each training
fold; validation folds hold original rows only. Folds are written once and
shared by all candidates and families. Every candidate meets every fold and the
highest mean score wins; the winner is fitted again on the full train split.
``halving`` prunes instead (the better half goes on after each fold): a cheaper
search that no registered query takes. Fits are Spark jobs; candidates run
concurrently.
"""

from __future__ import annotations

import json
import math
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowforge.functions.expr import hash_order
from flowforge.operators import evaluate as EV
from flowforge.operators import models as M
from flowforge.operators import resample as RS
from flowforge.operators import split as SP
from flowforge.operators.bundle import Bundle, promote, save_bundle
from flowforge.operators.features import class_quota_rank, stratified_cap
from flowforge.session import materialise

# The reference's search grids, by its parameter names.
PARAM_GRIDS = {
    "RandomForest": {
        "n_estimators": [100, 200, 300, 500],
        "max_depth": [10, 20, 30, None],
        "min_samples_leaf": [1, 2, 4],
        "max_features": ["sqrt", "log2"],
    },
    "BoostedTrees": {
        "n_estimators": [100, 200, 300, 500],
        "max_depth": [3, 5, 7, 10],
        "learning_rate": [0.01, 0.05, 0.1, 0.2],
        "subsample": [0.7, 0.8, 0.9, 1.0],
        "colsample_bytree": [0.7, 0.8, 0.9, 1.0],
        "min_child_weight": [1, 3, 5],
    },
    "DecisionTree": {
        "max_depth": [10, 15, 20, 25, 30, None],
        "min_samples_leaf": [1, 2, 4, 8],
        "criterion": ["gini", "entropy"],
    },
    "LogisticRegression": {
        "C": [0.01, 0.1, 1, 10, 100],
        "penalty": ["l1", "l2"],
    },
}
# The grids leave out the two axes without a Spark ML counterpart (split size,
# solver): draws that differ in them alone would repeat one fit.

# Settings of an untuned model (library defaults; None: unlimited).
UNTUNED = {
    "RandomForest": {"n_estimators": 100, "max_depth": None, "max_features": "sqrt"},
    "BoostedTrees": {"n_estimators": 100, "max_depth": 6, "learning_rate": 0.3},
    "DecisionTree": {"max_depth": None},
    "LogisticRegression": {"C": 1.0},
}


def param_space(spark: SparkSession, family: str) -> DataFrame:
    """(param_id, params map<string,string>): the full cross product, built by
    exploding one axis after another (generators, no joins)."""
    grid = PARAM_GRIDS[family]
    d = spark.range(1).select()
    for k, vals in grid.items():
        d = d.withColumn(k, F.explode(F.array(*[F.lit(json.dumps(v)) for v in vals])))
    keys = list(grid)
    m = F.create_map(*[x for k in keys for x in (F.lit(k), F.col(k))])
    w = Window.orderBy(*keys)  # grid size is bounded by the product of axis lengths
    return d.select(F.row_number().over(w).alias("param_id"), m.alias("params"))


def grid_size(family: str) -> int:
    return math.prod(len(v) for v in PARAM_GRIDS[family].values())


def to_spark_params(family: str, p: dict) -> dict:
    """Reference parameter names/values -> Spark ML estimator params."""
    out = {}
    for k, v in p.items():
        if k == "n_estimators":
            out["numTrees" if family == "RandomForest" else "maxIter"] = int(v)
        elif k == "max_depth":
            out["maxDepth"] = M.SPARK_MAX_DEPTH if v is None else min(int(v), M.SPARK_MAX_DEPTH)
        elif k == "min_samples_leaf":
            out["minInstancesPerNode"] = int(v)
        elif k == "min_child_weight":
            out["min_child_weight"] = float(v)
        elif k == "max_features":
            out["featureSubsetStrategy"] = str(v)
        elif k == "criterion":
            out["impurity"] = str(v)
        elif k == "learning_rate":
            out["stepSize"] = float(v)
        elif k == "subsample":
            out["subsample"] = float(v)
        elif k == "colsample_bytree":
            out["colsample"] = float(v)
        elif k == "C":
            out["C"] = float(v)
        elif k == "penalty":
            out["elasticNetParam"] = 1.0 if v == "l1" else 0.0
    return out


def sample_params(space: DataFrame, n_iter: int = 15, seed: int = 42) -> list[dict]:
    """``n_iter`` combinations without replacement in md5(param_id|seed)
    order (all of them when the grid is smaller)."""
    rows = (space.withColumn("_h", hash_order("param_id", seed)).orderBy("_h").limit(n_iter)
            .collect())  # n_iter rows
    return [{k: json.loads(v) for k, v in r["params"].items()} for r in rows]


def stratified_folds(df: DataFrame, k: int = 3, label_col: str = "Label_Multi", key: str = "flow_id",
                     seed: int = 42) -> DataFrame:
    """fold = (hashed rank inside the class - 1) mod k."""
    r = class_quota_rank(df, label_col, key, seed)
    return r.withColumn("fold", ((F.col("_rank") - 1) % k).cast("int")).drop("_rank", "_n")


def weighted_f1(model, data: DataFrame, label_col: str) -> float:
    p = model.transform(data).select(F.col(label_col).alias("y_true"),
                                     F.col("prediction").cast("int").alias("y_pred"))
    return EV.summary_metrics(p).first()["f1_weighted"]


@dataclass
class Fold:
    """Rows to fit and to validate on, scaled and vectorised alike."""
    train: DataFrame
    valid: DataFrame
    n_train: int


def fit_rows(train: DataFrame, cols: list[str], mapping: DataFrame, oversample: bool = False,
             key: str = "flow_id") -> tuple[DataFrame, dict]:
    """(rows to fit, scaler): the scaler is that of ``train`` itself (a stored
    table); with ``oversample`` every class then grows to the largest one's size
    (column ``is_synthetic``), which is written once; weights balance the rows
    that are fitted."""
    scaler = SP.scaler_params(SP.fit_standard_scaler(train, cols))
    rows = train.select(key, "Label_Multi", "Label_Binary", *cols).withColumn("is_synthetic", F.lit(False))
    if oversample:
        grown = RS.smote_oversample(train, cols, "Label_Multi", key)
        rows = materialise(SP.binary_from_multi(grown, mapping), "fit-rows")
    return SP.with_task_weights(vectors(rows, cols, scaler), rows), scaler


def vectors(rows: DataFrame, cols: list[str], scaler: dict) -> DataFrame:
    """Scaled feature vectors beside the other columns."""
    return VectorAssembler(inputCols=cols, outputCol="features").transform(SP.apply_standard_scaler(rows, scaler))


def search_folds(train: DataFrame, cols: list[str], mapping: DataFrame, k: int = 3, oversample: bool = False,
                 key: str = "flow_id", seed: int = 42) -> list[Fold]:
    """``k`` folds over raw (unscaled) rows, written once."""
    folded = materialise(stratified_folds(train, k, "Label_Multi", key, seed), "folds")
    out = []
    for f in range(k):
        fit, scaler = fit_rows(folded.where(F.col("fold") != f), cols, mapping, oversample, key)
        fit = materialise(fit, "fold-train")
        out.append(Fold(fit, materialise(vectors(folded.where(F.col("fold") == f), cols, scaler), "fold-valid"), fit.count()))
    return out


def fold_score(family: str, task: str, params: dict, fold: Fold, classes: list[int]) -> float:
    """Weighted F1 on the validation rows of a fit to the fold's training rows."""
    label_col = "Label_Binary" if task == "binary" else "Label_Multi"
    m = M.fit_model(family, task, fold.train, label_col, classes, fold.n_train, SP.weight_column(task),
                    to_spark_params(family, params))
    return weighted_f1(m, fold.valid, label_col)


def whole_search(family: str, task: str, folds: list[Fold], classes: list[int], candidates: list[dict],
                 parallelism: int = 4) -> list[dict]:
    """Every candidate's {params, scores}: one score per fold."""
    with ThreadPoolExecutor(max(1, parallelism)) as ex:
        scores = list(ex.map(lambda pf: fold_score(family, task, *pf, classes), [(p, f) for p in candidates for f in folds]))
    return [{"params": p, "scores": scores[i * len(folds):(i + 1) * len(folds)]} for i, p in enumerate(candidates)]


def halving_search(family: str, task: str, folds: list[Fold], classes: list[int], candidates: list[dict],
                   parallelism: int = 4) -> list[dict]:
    """Every candidate's {params, scores}: one score per fold that it met. After
    each fold the better half (rounded up; ties to the earlier draw) goes on, by
    the mean of the scores so far."""
    runs = [{"params": p, "scores": []} for p in candidates]
    left = list(range(len(runs)))
    for n, fold in enumerate(folds):
        with ThreadPoolExecutor(max(1, parallelism)) as ex:
            list(ex.map(lambda i: runs[i]["scores"].append(fold_score(family, task, runs[i]["params"], fold, classes)), left))
        if n + 1 < len(folds):
            left = sorted(left, key=lambda i: (-sum(runs[i]["scores"]), i))[:(len(left) + 1) // 2]
    return runs


def best_candidate(runs: list[dict], k: int) -> dict:
    """The highest mean score among those that met all ``k`` folds (ties: the
    earlier draw)."""
    whole = [r for r in runs if len(r["scores"]) == k]
    return max(whole, key=lambda r: sum(r["scores"]))


def untuned_baseline(family: str, task: str, tune: DataFrame, test: DataFrame, classes: list[int]):
    """Default parameters (balanced weights except boosted trees) fit on the
    tuning rows; returns (model, test weighted F1)."""
    label_col = "Label_Binary" if task == "binary" else "Label_Multi"
    m = M.fit_model(family, task, tune, label_col, classes, tune.count(), SP.weight_column(task),
                    to_spark_params(family, UNTUNED[family]))
    return m, weighted_f1(m, test, label_col)


def refit_best(family: str, task: str, train: DataFrame, test: DataFrame, classes: list[int],
               best: dict):
    """Refit the chosen reference-named parameters on the full train split;
    returns (model, test weighted F1)."""
    label_col = "Label_Binary" if task == "binary" else "Label_Multi"
    m = M.fit_model(family, task, train, label_col, classes, train.count(), SP.weight_column(task),
                    to_spark_params(family, best))
    return m, weighted_f1(m, test, label_col)


def search_family(family: str, folds: list[Fold], classes: list[int], task: str = "multi", n_iter: int = 15,
                  seed: int = 42, parallelism: int = 4, halving: bool = False) -> dict:
    """Seeded random search over the folds: the best parameters, their mean fold
    score, the number of fits and the seconds of the search."""
    spark = folds[0].train.sparkSession
    t0 = time.time()
    search = halving_search if halving else whole_search
    runs = search(family, task, folds, classes, sample_params(param_space(spark, family), n_iter, seed), parallelism)
    best = best_candidate(runs, len(folds))
    return {"params": best["params"], "cv_f1": sum(best["scores"]) / len(folds),
            "fits": sum(len(r["scores"]) for r in runs), "seconds": time.time() - t0}


def random_search_cv(families: list[str], train: DataFrame, test: DataFrame, cols: list[str], mapping: DataFrame,
                     classes: list[int], task: str = "multi", n_iter: int = 15, k: int = 3, seed: int = 42,
                     tuning_rows: int | None = None, oversample: bool = False, parallelism: int = 4,
                     halving: bool = True) -> list[dict]:
    """For each family: untuned baseline (defaults, on the tuning rows), search
    (``halving=False``: every candidate on every fold), refit of the best on the
    full train split, test scores. ``train`` and
    ``test`` are raw rows of stored tables, which fits and scores read through
    narrow steps; folds take a stratified sample of ``tuning_rows`` rows
    if train has more. One result per family, with its refitted model as a
    ``Bundle`` that scores raw rows."""
    tune_raw = train if tuning_rows is None else materialise(stratified_cap(train, tuning_rows), "tune-raw")
    folds = search_folds(tune_raw, cols, mapping, k, oversample, seed=seed)
    fit, scaler = fit_rows(train, cols, mapping, oversample)
    tune = fit if tuning_rows is None or train.count() <= tuning_rows else materialise(
        fit_rows(tune_raw, cols, mapping, oversample)[0], "tune-rows")
    held = vectors(test, cols, scaler)
    out = []
    for family in families:
        if family not in PARAM_GRIDS:
            continue
        _, original = untuned_baseline(family, task, tune, held, classes)
        best = search_family(family, folds, classes, task, n_iter, seed, parallelism, halving)
        model, tuned = refit_best(family, task, fit, held, classes, best["params"])
        scores = {"original_f1": original, "tuned_f1": tuned, "cv_f1": best["cv_f1"]}
        out.append({"model_name": family, "original_f1": original, "tuned_f1": tuned, "best_cv_f1": best["cv_f1"],
                    "best_params": {n: json.dumps(v) for n, v in best["params"].items()},
                    "search_time_sec": best["seconds"], "fits": best["fits"],
                    "bundle": Bundle(family, task, model, cols, scaler, mapping, best["params"], scores)})
    return out


def promote_search(spark: SparkSession, store: str, results: list[dict]) -> tuple[list[str], DataFrame]:
    """Save every tuned model as a bundle, then promote the best by test score
    (ties: name): (paths, report)."""
    paths = [save_bundle(spark, store, r["bundle"]) for r in results]
    report = report_frame(spark, results)
    best = promote_best(report).first()
    at = [r["model_name"] for r in results].index(best["best_model"])
    promote(spark, store, paths[at], best["best_tuned_f1"])
    return paths, report


def tuning_report(rows: DataFrame) -> DataFrame:
    """(model_name, original_f1, tuned_f1, improvement_pct, ...): improvement
    = (tuned - original) / original * 100, null when original is 0."""
    return rows.withColumn("improvement_pct", F.try_divide(
        (F.col("tuned_f1") - F.col("original_f1")) * 100.0, F.col("original_f1")))


def report_frame(spark: SparkSession, results: list[dict]) -> DataFrame:
    rows = [(r["model_name"], float(r["original_f1"]), float(r["tuned_f1"]), r["best_params"],
             float(r["search_time_sec"])) for r in results]
    d = spark.createDataFrame(rows, "model_name string, original_f1 double, tuned_f1 double, "
                                    "best_params map<string,string>, search_time_sec double")
    return tuning_report(d)


def promote_best(report: DataFrame) -> DataFrame:
    """The row with the highest tuned F1 (ties: name ascending) becomes the
    best model. The report has one row per tuned model."""
    w = Window.orderBy(F.col("tuned_f1").desc_nulls_last(), F.col("model_name"))
    return (report.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1)
            .select(F.col("model_name").alias("best_model"), F.col("tuned_f1").alias("best_tuned_f1")))

