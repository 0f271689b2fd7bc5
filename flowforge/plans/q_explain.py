"""Registered explainability queries (2.8): the linear path is checked
against SQL; sampled Shapley is held against what attributions must obey."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowforge.functions.expr import hash_order
from flowforge.operators import explain as X
from flowforge.operators import labels as L
from flowforge.operators import models as M
from flowforge.operators.profile import sample_rows
from flowforge.plans import fixtures as FX
from flowforge.plans import stages as S
from flowforge.plans import training as T
from flowforge.plans.catalog import register

# Linear model coefficients of the FIXTURES.md linear_coef view.
LINEAR_COEF = [(0, "sum_qty", -0.01), (0, "n_items", -0.2), (0, "mean_qty", 0.05),
               (1, "sum_qty", 0.02), (1, "n_items", 0.3), (1, "mean_qty", -0.04)]
LIN_FEATS = ["mean_qty", "n_items", "sum_qty"]

LIN_CTES = [
    S.SQL_FINAL, S.SQL_SPLIT,
    "linear_coef AS (SELECT * FROM (VALUES " + ", ".join(
        f"({c}, '{f}', CAST({v} AS DOUBLE))" for c, f, v in LINEAR_COEF) + ") AS v(class_id, feature, coef))",
    "ex AS (SELECT * FROM spl WHERE split = 'test')",
    "smp AS (SELECT * FROM ex ORDER BY md5(CAST(flow_id AS VARCHAR) || '|42'), flow_id LIMIT 500)",
    "bgm AS (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, avg(CAST({c} AS DOUBLE)) AS m FROM ex" for c in LIN_FEATS) + ")",
    "exl AS (" + " UNION ALL ".join(f"SELECT flow_id, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM ex" for c in LIN_FEATS) + ")",
    """la AS (SELECT e.flow_id, c.class_id, e.feature, e.value, c.coef * (e.value - b.m) AS attribution
  FROM exl e JOIN linear_coef c ON c.feature = e.feature JOIN bgm b ON b.feature = e.feature)""",
    """gi AS (SELECT feature, avg(a) AS importance FROM (SELECT flow_id, feature, avg(abs(attribution)) AS a FROM la GROUP BY 1, 2) t GROUP BY feature)""",
    """gir AS (SELECT feature, importance, row_number() OVER (ORDER BY importance DESC, feature) AS rank FROM gi)"""]
SQL_LIN = FX.with_views(["flows"], *S.clean_ctes(), *LIN_CTES)


def linear_coef(spark):
    return spark.createDataFrame(LINEAR_COEF, "class_id int, feature string, coef double")


def _lin(spark, sf):
    d, _ = S.split_dataset(spark, sf)
    ex = d.where(F.col("split") == "test")
    bgm = X.background_means(ex, LIN_FEATS)
    return d, ex, X.linear_attribution(ex, linear_coef(spark), bgm)


@register("explain_sample", SQL_LIN + "SELECT flow_id, Label_Multi FROM smp")
def q_explain_sample(spark, sf):
    d, _ = S.split_dataset(spark, sf)
    return X.explain_sample(d.where(F.col("split") == "test"), 500).select("flow_id", "Label_Multi")


@register("linear_attribution", SQL_LIN + "SELECT * FROM la")
def q_linear_attribution(spark, sf):
    return _lin(spark, sf)[2]


@register("global_importance", SQL_LIN + "SELECT feature, importance, CAST(rank AS INT) AS rank FROM gir")
def q_global_importance(spark, sf):
    return X.global_importance(_lin(spark, sf)[2]).withColumn("rank", F.col("rank").cast("int"))


@register("attribution_long", SQL_LIN +
          "SELECT flow_id, feature, value, avg(abs(attribution)) AS attribution FROM la GROUP BY flow_id, feature, value")
def q_attribution_long(spark, sf):
    return X.attribution_long(_lin(spark, sf)[2])


@register("dependence_pairs", SQL_LIN + """SELECT feature, flow_id, value, attribution FROM la
WHERE class_id = 0 AND feature IN (SELECT feature FROM gir WHERE rank <= 3)""")
def q_dependence_pairs(spark, sf):
    a = _lin(spark, sf)[2]
    return X.dependence_pairs(a, X.global_importance(a, 3), 0)


@register("local_explanations", FX.with_views(["preds"], *S.clean_ctes(), *LIN_CTES, """ord AS (
  SELECT flow_id, md5(CAST(flow_id AS VARCHAR) || '|42') AS o FROM ex)""", """ok AS (SELECT p.flow_id, p.y_true, o.o
  FROM preds p JOIN ord o ON o.flow_id = p.flow_id
  WHERE p.y_true = p.y_pred AND p.y_true <> (SELECT CAST(min(Label_Multi) AS INT) FROM cleaned WHERE Label = 'BENIGN') AND p.y_true IN (SELECT class_id FROM la))""",
    "fst AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY y_true ORDER BY o, flow_id) AS r FROM ok) t WHERE r = 1)",
    "fc AS (SELECT * FROM (SELECT *, dense_rank() OVER (ORDER BY y_true) AS c FROM fst) t WHERE c <= 3)",
    "lr AS (SELECT la.* FROM la JOIN fc ON fc.flow_id = la.flow_id AND fc.y_true = la.class_id)") +
    """SELECT class_id, flow_id, rank, feature, value, attribution FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY class_id ORDER BY abs(attribution) DESC, feature) AS INT) AS rank FROM lr) t
WHERE rank <= 10""")
def q_local_explanations(spark, sf):
    d, ex, a = _lin(spark, sf)
    preds = FX.preds(spark, sf).select("flow_id", "y_true", "y_pred")
    order = ex.select("flow_id", hash_order("flow_id", 42).alias("ord"))
    benign = L.benign_code(L.label_mapping(S.cleaned(spark, sf).select("Label")))
    return X.local_explanations(a, preds, order, benign_code=benign).withColumn("rank", F.col("rank").cast("int"))


@register("shapley_attribution", FX.with_views(["flows"], *S.clean_ctes(), *LIN_CTES) + f"""SELECT flow_id, class_id,
  CAST({len(S.FINAL_FEATURES)} AS BIGINT) AS n_features, TRUE AS sums_to_score, TRUE AS own_score, TRUE AS error_known
FROM smp, (SELECT DISTINCT Label_Multi AS class_id FROM cleaned) c""")
def q_shapley_attribution(spark, sf):
    """Sampled Shapley (20 orders in antithetic pairs, twice as many while a
    standard error exceeds 0.05; 100-row background) of the depth-20 tree's
    probability of every class, for 500 test rows. Per row and class:
    attributions sum to the class's score less its mean on the background, and
    the score is the model's."""
    p = T.prepare(spark, sf)
    m = M.fit_model("DecisionTree", "multi", p.split("train"), "Label_Multi", p.classes, p.n_train)
    ex = X.explain_sample(p.split("test"), 500)
    bg = sample_rows(p.split("train"), 100)
    att = X.shapley_attribution(m, ex, bg, p.cols, n_perm=20, tolerance=0.05, max_perm=40)
    gap = F.abs(F.sum("attribution") - (F.first("score") - F.first("base")))
    rows = att.groupBy("flow_id", "class_id").agg(
        F.countDistinct("feature").alias("n_features"), (gap < 1e-9).alias("sums_to_score"),
        F.first("score").alias("_score"), F.bool_and(F.col("std_error") >= 0).alias("error_known"))
    own = M.predict_with_proba(m, ex, "flow_id").select("flow_id", "probability")
    return rows.join(own, "flow_id").select(
        "flow_id", "class_id", "n_features", "sums_to_score",
        (F.abs(F.get("probability", F.col("class_id")) - F.col("_score")) < 1e-12).alias("own_score"), "error_known")
