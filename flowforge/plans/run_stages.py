"""End-to-end stage runner (the reference's script sequence), every stage
written as a table and read back by the next one:

cleaned -> profile tables -> final features -> split (partitionBy split)
-> oversampled train -> scaler -> models x tasks -> comparison (CSV export)
-> best model (model store) -> with tuning: search, refit, bundles, promotion
-> alerts on the test split.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from flowforge.operators import bundle as B
from flowforge.operators import evaluate as EV
from flowforge.operators import labels as L
from flowforge.operators import models as M
from flowforge.operators import profile as P
from flowforge.operators import resample as RS
from flowforge.operators import score as SC
from flowforge.operators import split as SP
from flowforge.operators import tune as TU
from flowforge.plans import stages as S
from flowforge.sources.store import export_csv, read_dataset, write_dataset


def run_stages(spark: SparkSession, sf_dir: str, out: str, models: list[str] | None = None,
               tasks=("binary", "multi"), oversample: bool = True, params: dict | None = None,
               tune: bool = False, n_iter: int = 15, tuning_rows: int = 500_000) -> dict:
    """Paths of all tables. With ``tune`` the two best multi-class models are
    searched, refitted and saved as bundles, and the best is promoted in the
    store ``bundles``; alerts then come from the promoted bundle."""
    paths = {}

    def put(name, df, **kw):
        paths[name] = f"{out}/{name}"
        write_dataset(df, paths[name], **kw)
        return read_dataset(spark, paths[name])

    cleaned = put("cleaned", S.cleaned(spark, sf_dir))
    mapping = put("label_mapping", L.label_mapping(cleaned.select("Label")))
    put("class_distribution", L.class_distribution(cleaned))
    put("dataset_summary", P.dataset_summary(cleaned))
    final, cols = S.final_dataset(spark, sf_dir, data=cleaned)
    split = put("split", SP.stratified_split(final, "Label_Multi", "flow_id"), partition_by=["split"])
    train = split.where(F.col("split") == "train")  # partition pruning
    resampled = None
    if oversample:
        resampled = put("train_resampled", RS.smote_oversample(train, cols, "Label_Multi", "flow_id"))
        resampled = SP.binary_from_multi(resampled, mapping)
    scaler = SP.scaler_params(put("scaler", SP.fit_standard_scaler(train, cols)))  # original train only
    fit_rows = SP.choose_training_set(train.drop("Label", "split"), resampled)
    vec = VectorAssembler(inputCols=cols, outputCol="features")
    fit_rows = vec.transform(SP.with_task_weights(SP.apply_standard_scaler(fit_rows, scaler), fit_rows)).persist()
    test = vec.transform(SP.apply_standard_scaler(split.where(F.col("split") == "test"), scaler))
    classes = sorted(r["code"] for r in mapping.select("code").collect())
    n_fit = fit_rows.count()
    rows, fitted = None, {}
    for name in models or M.MODEL_NAMES:
        for task in tasks:
            m, r = M.train_and_evaluate(name, task, fit_rows, test, classes, n_fit, SP.weight_column(task),
                                        (params or {}).get(name))
            fitted[(name, task)] = m
            r = r.cache()
            rows = r if rows is None else rows.unionByName(r)
    comparison = put("model_comparison", rows)
    export_csv(comparison, f"{out}/model_comparison_csv")
    best = EV.model_leaderboard(comparison).where((F.col("task") == "multi") & F.col("is_best")).first()
    best_model = fitted[(best["model_name"], "multi")]
    paths["best_model"] = f"{out}/best_model"
    M.save_model(best_model, paths["best_model"])
    raw = split.where(F.col("split") == "test").select("flow_id", *cols)
    if tune:
        names = [r["model_name"] for r in EV.top_k_models(comparison, 2).collect()]
        results = TU.random_search_cv(names, train, split.where(F.col("split") == "test"), cols, mapping, classes,
                                      n_iter=n_iter, tuning_rows=tuning_rows, oversample=oversample, halving=False)
        paths["bundles"] = f"{out}/bundles"
        _, report = TU.promote_search(spark, paths["bundles"], results)
        put("tuning_report", report)
        scored, rejected = B.current(spark, paths["bundles"]).score(raw)
    else:
        scored, rejected = SC.score_flows(raw, best_model, cols, mapping, scaler)
    put("rejects", rejected)
    attacks = SC.detect_attacks(scored).withColumn("confidence", F.col("Confidence") / 100.0)
    put("alerts", SC.build_alerts(attacks.withColumnRenamed("Predicted", "attack_type")))
    fit_rows.unpersist()
    return paths
