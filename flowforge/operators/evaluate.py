"""Evaluation over a predictions table.

Inputs are (group..., y_true, y_pred[, score]) rows. Everything reduces first
to confusion counts — at most groups x labels^2 rows — so the big table is
scanned once and every metric after that works on a tiny table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowforge.functions.expr import bounded_lookup, safe_div
from flowforge.functions.sequence import bucketed_cumsum, quantile_bucket


def confusion_counts(preds: DataFrame, true_col: str = "y_true", pred_col: str = "y_pred",
                     group: list[str] | None = None) -> DataFrame:
    g = group or []
    return preds.groupBy(*g, F.col(true_col).alias("y_true"), F.col(pred_col).alias("y_pred")).agg(
        F.count(F.lit(1)).cast("bigint").alias("count"))


def confusion_matrix(preds: DataFrame, true_col: str = "y_true", pred_col: str = "y_pred",
                     group: list[str] | None = None) -> DataFrame:
    """Counts for every (true, pred) pair of the labels present in y_true
    (zero cells included). The label grid is generated by exploding the
    per-group label list (bounded by the label count), not by a join."""
    g = group or []
    cc = confusion_counts(preds, true_col, pred_col, g)
    labs = cc.groupBy(*g).agg(F.array_sort(F.collect_set("y_true")).alias("_l"))
    grid = (labs.select(*g, F.explode("_l").alias("y_true"), "_l")
            .select(*g, "y_true", F.explode("_l").alias("y_pred")))
    return (grid.join(cc, [*g, "y_true", "y_pred"], "left")
            .select(*g, "y_true", "y_pred", F.coalesce("count", F.lit(0)).cast("bigint").alias("count")))


def class_metrics(preds: DataFrame, true_col: str = "y_true", pred_col: str = "y_pred",
                  group: list[str] | None = None) -> DataFrame:
    """Per class of y_true ∪ y_pred: support, predicted, tp, precision,
    recall, f1 (zero_division = 0)."""
    g = group or []
    cc = confusion_counts(preds, true_col, pred_col, g)
    roles = cc.select(*g, F.explode(F.array(
        F.struct(F.col("y_true").alias("label"), F.col("count").alias("s"), F.lit(0).cast("bigint").alias("p"),
                 F.when(F.col("y_true") == F.col("y_pred"), F.col("count")).otherwise(0).cast("bigint").alias("t")),
        F.struct(F.col("y_pred").alias("label"), F.lit(0).cast("bigint").alias("s"), F.col("count").alias("p"),
                 F.lit(0).cast("bigint").alias("t")))).alias("_r")).select(*g, "_r.*")
    per = roles.groupBy(*g, "label").agg(F.sum("s").alias("support"), F.sum("p").alias("predicted"),
                                         F.sum("t").alias("tp"))
    return per.select(
        *g, "label", F.col("support").cast("bigint"), F.col("predicted").cast("bigint"),
        F.col("tp").cast("bigint"),
        safe_div(F.col("tp"), F.col("predicted")).alias("precision"),
        safe_div(F.col("tp"), F.col("support")).alias("recall"),
        safe_div(2 * F.col("tp"), F.col("support") + F.col("predicted")).alias("f1"))


def summary_metrics(preds: DataFrame, true_col: str = "y_true", pred_col: str = "y_pred",
                    group: list[str] | None = None) -> DataFrame:
    """accuracy, support-weighted precision/recall/F1 and macro F1 (over the
    labels of y_true ∪ y_pred) per group."""
    g = group or []
    cm = class_metrics(preds, true_col, pred_col, g)
    s = F.col("support")
    return cm.groupBy(*g).agg(
        safe_div(F.sum("tp"), F.sum(s)).alias("accuracy"),
        safe_div(F.sum(s * F.col("precision")), F.sum(s)).alias("precision_weighted"),
        safe_div(F.sum(s * F.col("recall")), F.sum(s)).alias("recall_weighted"),
        safe_div(F.sum(s * F.col("f1")), F.sum(s)).alias("f1_weighted"),
        F.avg("f1").alias("f1_macro"))


def accuracy(preds: DataFrame, true_col: str = "y_true", pred_col: str = "y_pred",
             group: list[str] | None = None) -> DataFrame:
    g = group or []
    return preds.groupBy(*g).agg(F.avg((F.col(true_col) == F.col(pred_col)).cast("double"))
                                 .alias("accuracy"))


def classification_report(preds: DataFrame, true_col: str = "y_true", pred_col: str = "y_pred",
                          names: DataFrame | None = None) -> DataFrame:
    """Per-class rows plus 'accuracy', 'macro avg', 'weighted avg' rows:
    (row, precision, recall, f1, support)."""
    cm = class_metrics(preds, true_col, pred_col)
    if names is not None:
        cm = cm.join(names.select(F.col("code").alias("label"), F.col("label").alias("_name")),
                     "label", "left")
        row = F.coalesce(F.col("_name"), F.col("label").cast("string"))
    else:
        row = F.col("label").cast("string")
    per = cm.select(row.alias("row"), "precision", "recall", "f1", "support")
    s = F.col("support")
    tot = cm.agg(F.sum(s).alias("_S"), F.sum("tp").alias("_T"),
                 F.avg("precision").alias("_mp"), F.avg("recall").alias("_mr"), F.avg("f1").alias("_mf"),
                 safe_div(F.sum(s * F.col("precision")), F.sum(s)).alias("_wp"),
                 safe_div(F.sum(s * F.col("recall")), F.sum(s)).alias("_wr"),
                 safe_div(F.sum(s * F.col("f1")), F.sum(s)).alias("_wf"))
    acc = safe_div(F.col("_T"), F.col("_S"))
    summary = tot.select(F.explode(F.array(
        F.struct(F.lit("accuracy").alias("row"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), acc.cast("double").alias("f1"),
                 F.col("_S").alias("support")),
        _report_row("macro avg", "_mp", "_mr", "_mf"),
        _report_row("weighted avg", "_wp", "_wr", "_wf"))).alias("_r")
    ).select("_r.*")
    return per.unionByName(summary.select("row", "precision", "recall", "f1",
                                          F.col("support").cast("bigint")))


def _report_row(name: str, p: str, r: str, f: str):
    return F.struct(F.lit(name).alias("row"), F.col(p).cast("double").alias("precision"),
                    F.col(r).cast("double").alias("recall"), F.col(f).cast("double").alias("f1"),
                    F.col("_S").alias("support"))


def per_class_f1(preds: DataFrame, group: list[str], true_col: str = "y_true",
                 pred_col: str = "y_pred") -> DataFrame:
    """F1 per (group, class) over the classes present in y_true."""
    cm = class_metrics(preds, true_col, pred_col, group)
    return cm.where(F.col("support") > 0).select(*group, "label", "f1")


def _pos_neg_by_score(preds: DataFrame, label: F.Column, score: str, group: list[str]) -> DataFrame:
    return preds.groupBy(*group, F.col(score).alias("score")).agg(
        F.sum(label.cast("long")).alias("npos"), F.sum((1 - label.cast("long"))).alias("nneg"))


def roc_auc_binary(preds: DataFrame, label_col: str = "y_true", score_col: str = "score",
                   group: list[str] | None = None, positive=1) -> DataFrame:
    """Exact AUC with mid-ranks for ties: sum over distinct scores of
    npos * (negatives below + nneg / 2), over P * N. Null when a group has
    only one class. Buckets follow the quantiles of the distinct scores, so
    scores that pile up at 0 and 1 are spread as well."""
    g = group or []
    lab = (F.col(label_col) == F.lit(positive))
    s = _pos_neg_by_score(preds, lab, score_col, g)
    c = bucketed_cumsum(s, g, "score", quantile_bucket(s, "score"), ["nneg"])
    contrib = F.col("npos") * (F.col("cum_nneg") - F.col("nneg") + F.col("nneg") / 2.0)
    return c.groupBy(*g).agg(
        F.try_divide(F.sum(contrib), (F.sum("npos") * F.sum("nneg")).cast("double")).alias("roc_auc"))


def roc_auc_ovr_weighted(proba: DataFrame, true_col: str = "y_true", class_col: str = "class_id",
                         p_col: str = "p", group: list[str] | None = None) -> DataFrame:
    """One-vs-rest AUC per class weighted by class prevalence. Null when a
    scored class is absent from y_true (undefined, as in the reference)."""
    g = group or []
    lab = F.col(true_col) == F.col(class_col)
    per = roc_auc_binary(proba.withColumn("_pos", lab.cast("int")), "_pos", p_col, [*g, class_col])
    sup = proba.where(lab).groupBy(*g, class_col).agg(F.count(F.lit(1)).alias("_sup"))
    j = per.join(sup, [*g, class_col], "left")
    return j.groupBy(*g).agg(F.when(F.min(F.coalesce("_sup", F.lit(0))) == 0, F.lit(None))
                             .otherwise(F.sum(F.col("roc_auc") * F.col("_sup")) / F.sum("_sup"))
                             .cast("double").alias("roc_auc"))


def roc_curve(preds: DataFrame, label_col: str = "y_true", score_col: str = "score",
              group: list[str] | None = None, positive=1) -> DataFrame:
    """One point per distinct score (descending): threshold, fpr, tpr."""
    g = group or []
    lab = (F.col(label_col) == F.lit(positive))
    s = _pos_neg_by_score(preds, lab, score_col, g)
    c = bucketed_cumsum(s, g, "score", quantile_bucket(s, "score"), ["npos", "nneg"], desc=True)
    # totals by partial aggregation (one row per group), joined back
    total = s.groupBy(*g).agg(F.sum("npos").alias("_p"), F.sum("nneg").alias("_n"))
    c = c.join(bounded_lookup(total), g) if g else c.join(F.broadcast(total))
    return c.select(*g, F.col("score").alias("threshold"),
                    F.try_divide(F.col("cum_nneg").cast("double"), F.col("_n")).alias("fpr"),
                    F.try_divide(F.col("cum_npos").cast("double"), F.col("_p")).alias("tpr"))


def trapezoid_auc(curve: DataFrame, group: list[str] | None = None) -> DataFrame:
    """Area under the (fpr, tpr) points, starting from (0, 0)."""
    g = group or []
    w = Window.partitionBy(*g).orderBy(F.col("fpr"), F.col("tpr"))
    seg = curve.select(*g, "fpr", "tpr",
                       F.coalesce(F.lag("fpr").over(w), F.lit(0.0)).alias("_f0"),
                       F.coalesce(F.lag("tpr").over(w), F.lit(0.0)).alias("_t0"))
    return seg.groupBy(*g).agg(F.sum((F.col("fpr") - F.col("_f0")) * (F.col("tpr") + F.col("_t0")) / 2)
                               .alias("auc"))


def metrics_row(summary: DataFrame, auc: DataFrame | None, times: DataFrame | None,
                group: list[str]) -> DataFrame:
    """Metric columns rounded to 4 places, seconds to 1. A true AUC of 0.0
    stays 0.0 (T-9); a missing AUC is null."""
    d = summary
    if auc is not None:
        d = d.join(auc, group, "left")
    else:
        d = d.withColumn("roc_auc", F.lit(None).cast("double"))
    if times is not None:
        d = d.join(times, group, "left")
    else:
        d = d.withColumn("training_time_sec", F.lit(None).cast("double"))
    r4 = ["accuracy", "precision_weighted", "recall_weighted", "f1_weighted", "f1_macro", "roc_auc"]
    return d.select(*group, *[F.round(F.col(c), 4).alias(c) for c in r4],
                    F.round("training_time_sec", 1).alias("training_time_sec"))


def model_leaderboard(metrics: DataFrame) -> DataFrame:
    """Per task by weighted F1 descending (name tie-break): rank, is_best."""
    w = Window.partitionBy("task").orderBy(F.col("f1_weighted").desc_nulls_last(), F.col("model_name"))
    return metrics.withColumn("rank", F.row_number().over(w)).withColumn(
        "is_best", F.col("rank") == 1)


def top_k_models(metrics: DataFrame, k: int = 2, task: str = "multi") -> DataFrame:
    return (metrics.where(F.col("task") == task)
            .orderBy(F.col("f1_weighted").desc_nulls_last(), F.col("model_name")).limit(k))


METRIC_COLS = ["accuracy", "precision_weighted", "recall_weighted", "f1_weighted", "f1_macro", "roc_auc"]


def metrics_long(metrics: DataFrame) -> DataFrame:
    """Comparison-chart data: unpivoted metrics; a metric null for every row
    is dropped; roc_auc kept only for the binary task; remaining null -> 0."""
    long = metrics.unpivot(["model_name", "task"], METRIC_COLS, "metric", "value")
    present = long.groupBy("metric").agg(F.count("value").alias("_nn")).where(F.col("_nn") > 0)
    keep = long.join(present.select("metric"), "metric", "left_semi")
    keep = keep.where((F.col("metric") != "roc_auc") | (F.col("task") == "binary"))
    return keep.select("model_name", "task", "metric", F.coalesce("value", F.lit(0.0)).alias("value"))


def time_vs_quality(metrics: DataFrame, task: str = "multi") -> DataFrame:
    return metrics.where(F.col("task") == task).select(
        "model_name", "training_time_sec", "f1_weighted", "accuracy")
