"""Registered queries for split/scale (2.5) and evaluation (2.7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowforge.operators import evaluate as EV
from flowforge.operators import labels as L
from flowforge.operators import split as SP
from flowforge.plans import fixtures as FX
from flowforge.plans import stages as S
from flowforge.plans.catalog import register

FIN = S.FINAL_FEATURES


# ------------------------------------------------------------ SQL generators
def sql_metrics(src: str, g: list[str], p: str, yt: str = "y_true", yp: str = "y_pred") -> list[str]:
    """CTEs {p}cc / {p}pm (per class) / {p}sm (summary) over ``src``."""
    gs = ", ".join(g) + (", " if g else "")
    gb = ("GROUP BY " + ", ".join(g)) if g else ""
    return [
        f"{p}cc AS (SELECT {gs}{yt} AS y_true, {yp} AS y_pred, count(*) AS c FROM {src} GROUP BY {gs}{yt}, {yp})",
        f"""{p}ro AS (SELECT {gs}y_true AS label, c AS s, 0 AS pr, CASE WHEN y_true = y_pred THEN c ELSE 0 END AS t FROM {p}cc
  UNION ALL SELECT {gs}y_pred AS label, 0 AS s, c AS pr, 0 AS t FROM {p}cc)""",
        f"""{p}pm AS (SELECT {gs}label, CAST(sum(s) AS BIGINT) AS support, CAST(sum(pr) AS BIGINT) AS predicted, CAST(sum(t) AS BIGINT) AS tp,
  coalesce(CAST(sum(t) AS DOUBLE) / NULLIF(CAST(sum(pr) AS DOUBLE), 0), 0) AS precision,
  coalesce(CAST(sum(t) AS DOUBLE) / NULLIF(CAST(sum(s) AS DOUBLE), 0), 0) AS recall,
  coalesce(CAST(2 * sum(t) AS DOUBLE) / NULLIF(CAST(sum(s) + sum(pr) AS DOUBLE), 0), 0) AS f1
  FROM {p}ro GROUP BY {gs}label)""",
        f"""{p}sm AS (SELECT {gs}CAST(sum(tp) AS DOUBLE) / CAST(sum(support) AS DOUBLE) AS accuracy,
  sum(support * precision) / CAST(sum(support) AS DOUBLE) AS precision_weighted,
  sum(support * recall) / CAST(sum(support) AS DOUBLE) AS recall_weighted,
  sum(support * f1) / CAST(sum(support) AS DOUBLE) AS f1_weighted, avg(f1) AS f1_macro FROM {p}pm {gb})"""]


def sql_auc(src: str, g: list[str], p: str, label: str, score: str) -> list[str]:
    gs = ", ".join(g) + (", " if g else "")
    part = ("PARTITION BY " + ", ".join(g)) if g else ""
    gb = ("GROUP BY " + ", ".join(g)) if g else ""
    return [
        f"""{p}sc AS (SELECT {gs}{score} AS score, sum(CASE WHEN {label} THEN 1 ELSE 0 END) AS npos,
  sum(CASE WHEN {label} THEN 0 ELSE 1 END) AS nneg FROM {src} GROUP BY {gs}{score})""",
        f"""{p}cu AS (SELECT {gs}score, npos, nneg, sum(nneg) OVER ({part} ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cneg FROM {p}sc)""",
        f"""{p}auc AS (SELECT {gs}CAST(sum(npos * (cneg - nneg + nneg / 2.0)) AS DOUBLE) / NULLIF(CAST(sum(npos) * sum(nneg) AS DOUBLE), 0) AS roc_auc
  FROM {p}cu {gb})"""]


MG = ["model_name", "task"]
METRIC_CTES = [*sql_metrics("model_preds", MG, "m_"),
               *sql_auc("model_preds WHERE task = 'binary'", MG, "a_", "y_true = 1", "score"),
               """mm AS (SELECT s.model_name, s.task, round(s.accuracy, 4) AS accuracy,
  round(s.precision_weighted, 4) AS precision_weighted, round(s.recall_weighted, 4) AS recall_weighted,
  round(s.f1_weighted, 4) AS f1_weighted, round(s.f1_macro, 4) AS f1_macro, round(a.roc_auc, 4) AS roc_auc,
  round(t.training_time_sec, 1) AS training_time_sec
  FROM m_sm s LEFT JOIN a_auc a ON s.model_name = a.model_name AND s.task = a.task
  LEFT JOIN train_seconds t ON s.model_name = t.model_name AND s.task = t.task)"""]
SQL_MODEL_METRICS = FX.with_views(["model_preds"], *METRIC_CTES)


def model_metrics(spark, sf):
    mp = FX.model_preds(spark, sf)
    summ = EV.summary_metrics(mp, group=MG)
    auc = EV.roc_auc_binary(mp.where(F.col("task") == "binary"), "y_true", "score", MG)
    return EV.metrics_row(summ, auc, FX.train_seconds(spark), MG)


# ------------------------------------------------------------------ 2.5
@register("stratified_split", S.sql_split() + "SELECT flow_id, Label_Multi, split FROM spl")
def q_stratified_split(spark, sf):
    d, _ = S.split_dataset(spark, sf)
    return d.select("flow_id", "Label_Multi", "split")


@register("split_class_counts", S.sql_split() + """SELECT split, CAST(count(*) AS BIGINT) AS rows,
  CAST(sum(CASE WHEN Label_Binary = 0 THEN 1 ELSE 0 END) AS BIGINT) AS benign,
  CAST(sum(CASE WHEN Label_Binary = 1 THEN 1 ELSE 0 END) AS BIGINT) AS attack FROM spl GROUP BY split""")
def q_split_class_counts(spark, sf):
    d, _ = S.split_dataset(spark, sf)
    return SP.split_class_counts(d)


@register("balanced_class_weights", S.sql_split() + """SELECT Label_Multi,
  CAST(sum(count(*)) OVER () AS DOUBLE) / (count(*) OVER () * count(*)) AS weight FROM spl WHERE split = 'train' GROUP BY Label_Multi""")
def q_balanced_class_weights(spark, sf):
    d, _ = S.split_dataset(spark, sf)
    return SP.balanced_class_weights(d.where(F.col("split") == "train"))


SQL_SCALER = "sc_p AS (" + "\nUNION ALL ".join(
    f"SELECT {i} AS pos, '{c}' AS feature, avg({c}) AS mean, CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS scale "
    f"FROM spl WHERE split = 'train'" for i, c in enumerate(FIN)) + ")"


@register("fit_standard_scaler", S.sql_split(SQL_SCALER) + "SELECT * FROM sc_p")
def q_fit_standard_scaler(spark, sf):
    d, cols = S.split_dataset(spark, sf)
    return SP.fit_standard_scaler(d.where(F.col("split") == "train"), cols)


@register("apply_standard_scaler", S.sql_split(SQL_SCALER) + "SELECT s.flow_id, s.split, " + ", ".join(
    f"round((CAST(s.{c} AS DOUBLE) - (SELECT mean FROM sc_p WHERE feature = '{c}')) / (SELECT scale FROM sc_p WHERE feature = '{c}'), 7) AS {c}"
    for c in FIN) + " FROM spl s")
def q_apply_standard_scaler(spark, sf):
    d, cols = S.split_dataset(spark, sf)
    params = SP.scaler_params(SP.fit_standard_scaler(d.where(F.col("split") == "train"), cols))
    out = SP.apply_standard_scaler(d.select("flow_id", "split", *cols), params)
    # scaled values near 0 come from x - mean: fixed decimals, not significant
    # digits, keep the two engines' last-bit mean differences out of the check
    return out.select("flow_id", "split", *[F.round(c, 7).alias(c) for c in cols])


@register("binary_from_multi", S.sql_cleaned() + """SELECT flow_id, Label_Multi,
  CAST(CASE WHEN Label_Multi <> (SELECT min(Label_Multi) FROM cleaned WHERE Label = 'BENIGN') THEN 1 ELSE 0 END AS INT) AS Label_Binary FROM cleaned""")
def q_binary_from_multi(spark, sf):
    c = S.cleaned(spark, sf)
    return SP.binary_from_multi(c.select("flow_id", "Label_Multi"), L.label_mapping(c.select("Label")))


@register("split_xy", S.sql_split() + "\nUNION ALL ".join(
    f"SELECT flow_id, split, Label_Multi, Label_Binary, {i} AS pos, CAST({c} AS DOUBLE) AS value FROM spl"
    for i, c in enumerate(S.FINAL_FEATURES)))
def q_split_xy(spark, sf):
    """Feature vectors + labels, one row per vector entry."""
    d, cols = S.split_dataset(spark, sf)
    from pyspark.ml.functions import vector_to_array
    return SP.split_xy(d, cols).select("flow_id", "split", "Label_Multi", "Label_Binary",
                                       F.posexplode(vector_to_array("features")).alias("pos", "value"))


@register("choose_training_set_resampled", S.sql_split() + "SELECT flow_id, Label_Multi FROM spl WHERE split = 'val'")
def q_choose_training_set_resampled(spark, sf):
    """A resampled set is given (the validation rows stand in for it): it is chosen."""
    d, _ = S.split_dataset(spark, sf)
    return SP.choose_training_set(d.where(F.col("split") == "train"), d.where(F.col("split") == "val")) \
        .select("flow_id", "Label_Multi")


@register("choose_training_set", S.sql_split() + "SELECT flow_id, Label_Multi FROM spl WHERE split = 'train'")
def q_choose_training_set(spark, sf):
    """No resampled set given -> the original train rows."""
    d, _ = S.split_dataset(spark, sf)
    return SP.choose_training_set(d.where(F.col("split") == "train"), None).select("flow_id", "Label_Multi")


# ------------------------------------------------------------------ 2.7
@register("confusion_matrix", FX.with_views(["preds"], """cc AS (SELECT y_true, y_pred, count(*) AS c FROM preds GROUP BY 1, 2),
labs AS (SELECT DISTINCT y_true AS l FROM preds)""") + """SELECT a.l AS y_true, b.l AS y_pred, CAST(coalesce(cc.c, 0) AS BIGINT) AS count
FROM labs a CROSS JOIN labs b LEFT JOIN cc ON cc.y_true = a.l AND cc.y_pred = b.l""")
def q_confusion_matrix(spark, sf):
    return EV.confusion_matrix(FX.preds(spark, sf))


@register("accuracy", FX.with_views(["preds"]) +
          "SELECT avg(CASE WHEN y_true = y_pred THEN 1.0 ELSE 0.0 END)::DOUBLE AS accuracy FROM preds")
def q_accuracy(spark, sf):
    return EV.accuracy(FX.preds(spark, sf))


@register("weighted_prf", FX.with_views(["preds"], *sql_metrics("preds", [], "p_")) +
          "SELECT accuracy, precision_weighted, recall_weighted, f1_weighted, f1_macro FROM p_sm")
def q_weighted_prf(spark, sf):
    return EV.summary_metrics(FX.preds(spark, sf))


@register("macro_f1", FX.with_views(["preds"], *sql_metrics("preds", [], "p_")) + "SELECT f1_macro FROM p_sm")
def q_macro_f1(spark, sf):
    return EV.summary_metrics(FX.preds(spark, sf)).select("f1_macro")


@register("classification_report", FX.with_views(["preds"], *sql_metrics("preds", [], "p_"), """nm AS (
  SELECT DISTINCT trim(label) AS name, CAST(dense_rank() OVER (ORDER BY trim(label)) - 1 AS INT) AS code FROM flows)""") +
          """SELECT coalesce(nm.name, CAST(pm.label AS VARCHAR)) AS row, pm.precision, pm.recall, pm.f1, pm.support
FROM p_pm pm LEFT JOIN nm ON nm.code = pm.label
UNION ALL SELECT 'accuracy', NULL, NULL, accuracy, CAST((SELECT sum(support) FROM p_pm) AS BIGINT) FROM p_sm
UNION ALL SELECT 'macro avg', (SELECT avg(precision) FROM p_pm), (SELECT avg(recall) FROM p_pm), f1_macro, CAST((SELECT sum(support) FROM p_pm) AS BIGINT) FROM p_sm
UNION ALL SELECT 'weighted avg', precision_weighted, recall_weighted, f1_weighted, CAST((SELECT sum(support) FROM p_pm) AS BIGINT) FROM p_sm""")
def q_classification_report(spark, sf):
    names = L.label_mapping(FX.flows(spark, sf).select(F.trim("label").alias("Label")))
    return EV.classification_report(FX.preds(spark, sf), names=names)


@register("per_class_f1", FX.with_views(["model_preds"], *sql_metrics("model_preds WHERE task = 'multi'", ["model_name"], "m_")) +
          "SELECT model_name, label, f1 FROM m_pm WHERE support > 0")
def q_per_class_f1(spark, sf):
    mp = FX.model_preds(spark, sf).where(F.col("task") == "multi")
    return EV.per_class_f1(mp, ["model_name"])


@register("roc_auc_binary", FX.with_views(["preds"], *sql_auc("preds", [], "b_", "y_true <> 0", "p_attack")) +
          "SELECT roc_auc FROM b_auc")
def q_roc_auc_binary(spark, sf):
    p = FX.preds(spark, sf).withColumn("is_attack", (F.col("y_true") != 0).cast("int"))
    return EV.roc_auc_binary(p, "is_attack", "p_attack")


@register("roc_auc_ovr_weighted", FX.with_views(["preds_proba"], *sql_auc("preds_proba", ["class_id"], "o_", "y_true = class_id", "p"),
                                                 "o_sup AS (SELECT y_true AS class_id, count(*) AS sup FROM preds_proba WHERE y_true = class_id GROUP BY 1)") +
          "SELECT sum(a.roc_auc * s.sup) / sum(s.sup) AS roc_auc FROM o_auc a JOIN o_sup s ON a.class_id = s.class_id")
def q_roc_auc_ovr_weighted(spark, sf):
    return EV.roc_auc_ovr_weighted(FX.preds_proba(spark, sf))


@register("roc_curve", FX.with_views(["preds"], """rc AS (SELECT p_attack AS s, sum(CASE WHEN y_true <> 0 THEN 1 ELSE 0 END) AS npos,
  sum(CASE WHEN y_true <> 0 THEN 0 ELSE 1 END) AS nneg FROM preds GROUP BY p_attack)""") + """SELECT s AS threshold,
  CAST(sum(nneg) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) / CAST(sum(nneg) OVER () AS DOUBLE) AS fpr,
  CAST(sum(npos) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) / CAST(sum(npos) OVER () AS DOUBLE) AS tpr FROM rc""")
def q_roc_curve(spark, sf):
    p = FX.preds(spark, sf).withColumn("is_attack", (F.col("y_true") != 0).cast("int"))
    return EV.roc_curve(p, "is_attack", "p_attack")


@register("metrics_row", SQL_MODEL_METRICS + "SELECT * FROM mm")
def q_metrics_row(spark, sf):
    return model_metrics(spark, sf)


@register("model_leaderboard", SQL_MODEL_METRICS +
          """SELECT *, row_number() OVER (PARTITION BY task ORDER BY f1_weighted DESC NULLS LAST, model_name) AS rank,
  row_number() OVER (PARTITION BY task ORDER BY f1_weighted DESC NULLS LAST, model_name) = 1 AS is_best FROM mm""")
def q_model_leaderboard(spark, sf):
    return EV.model_leaderboard(model_metrics(spark, sf)).withColumn("rank", F.col("rank").cast("bigint"))


@register("top_k_models", SQL_MODEL_METRICS +
          "SELECT * FROM mm WHERE task = 'multi' ORDER BY f1_weighted DESC NULLS LAST, model_name LIMIT 2")
def q_top_k_models(spark, sf):
    return EV.top_k_models(model_metrics(spark, sf), 2)


@register("metrics_long", SQL_MODEL_METRICS + """, ml AS (
  SELECT model_name, task, 'accuracy' AS metric, accuracy AS value FROM mm
  UNION ALL SELECT model_name, task, 'precision_weighted', precision_weighted FROM mm
  UNION ALL SELECT model_name, task, 'recall_weighted', recall_weighted FROM mm
  UNION ALL SELECT model_name, task, 'f1_weighted', f1_weighted FROM mm
  UNION ALL SELECT model_name, task, 'f1_macro', f1_macro FROM mm
  UNION ALL SELECT model_name, task, 'roc_auc', roc_auc FROM mm)
SELECT model_name, task, metric, coalesce(value, 0.0)::DOUBLE AS value FROM ml
WHERE metric IN (SELECT metric FROM ml GROUP BY metric HAVING count(value) > 0)
  AND (metric <> 'roc_auc' OR task = 'binary')""")
def q_metrics_long(spark, sf):
    return EV.metrics_long(model_metrics(spark, sf))


@register("time_vs_quality", SQL_MODEL_METRICS +
          "SELECT model_name, training_time_sec, f1_weighted, accuracy FROM mm WHERE task = 'multi'")
def q_time_vs_quality(spark, sf):
    return EV.time_vs_quality(model_metrics(spark, sf))
