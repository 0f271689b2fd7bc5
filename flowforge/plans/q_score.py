"""Registered queries for scoring summaries and alerts (2.9) over the
deterministic prediction fixtures."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowforge.operators import labels as L
from flowforge.operators import score as SC
from flowforge.operators import split as SP
from flowforge.plans import fixtures as FX
from flowforge.plans import stages as S
from flowforge.plans.catalog import register
from flowforge.plans.q_eval import METRIC_CTES, model_metrics
from flowforge.session import materialise

HIGH = "('DDoS', 'DoS Hulk', 'DoS GoldenEye', 'Bot')"
MEDIUM = "('PortScan', 'FTP-Patator', 'SSH-Patator')"

SQL_BASE = ["""nm AS (SELECT DISTINCT trim(label) AS name, CAST(dense_rank() OVER (ORDER BY trim(label)) - 1 AS INT) AS code FROM flows)""",
            """cf AS (SELECT flow_id, max(p) AS confidence FROM preds_proba GROUP BY flow_id)""",
            """base AS (SELECT p.flow_id, nm.name AS attack_type, cf.confidence FROM preds p JOIN cf ON p.flow_id = cf.flow_id
  LEFT JOIN nm ON nm.code = p.y_pred)""",
            """att AS (SELECT * FROM base WHERE attack_type IS DISTINCT FROM 'BENIGN')""",
            f"""sev AS (SELECT *, CASE WHEN attack_type IN {HIGH} THEN 'High' WHEN attack_type IN {MEDIUM} THEN 'Medium' ELSE 'Low' END AS severity FROM att)""",
            """alr AS (SELECT printf('ALT-%05d', row_number() OVER (ORDER BY flow_id)) AS alert_id,
  TIMESTAMP '2024-01-01 00:00:00' + to_seconds(CAST((row_number() OVER (ORDER BY flow_id) - 1) * 3 - floor(count(*) OVER () / 100) * 3600 AS BIGINT)) AS timestamp,
  attack_type, round(confidence * 100, 1) AS confidence_pct, severity, flow_id FROM sev)""",
            """flt AS (SELECT * FROM alr WHERE severity IN ('High', 'Medium') AND attack_type IN ('DDoS', 'PortScan', 'FTP-Patator', 'DoS slowloris'))"""]
SQL_ALERTS = FX.with_views(["preds_proba"], *SQL_BASE)


def names(spark, sf):
    return L.label_mapping(FX.flows(spark, sf).select(F.trim("label").alias("Label")))


def scored(spark, sf):
    """Decoded predictions with confidence = max class probability."""
    conf = FX.preds_proba(spark, sf).groupBy("flow_id").agg(F.max("p").alias("confidence"))
    p = FX.preds(spark, sf).select("flow_id", "y_pred").join(conf, "flow_id")
    return L.decode_label(p, names(spark, sf), "y_pred", "attack_type").drop("y_pred")


def alerts(spark, sf):
    return SC.build_alerts(SC.detect_attacks(scored(spark, sf), "attack_type"))


def filtered(spark, sf):
    return SC.filter_alerts(alerts(spark, sf), ["High", "Medium"],
                            ["DDoS", "PortScan", "FTP-Patator", "DoS slowloris"])


@register("detect_attacks", SQL_ALERTS + "SELECT flow_id, attack_type, confidence FROM att")
def q_detect_attacks(spark, sf):
    return SC.detect_attacks(scored(spark, sf), "attack_type").select("flow_id", "attack_type", "confidence")


@register("severity", SQL_ALERTS + "SELECT flow_id, attack_type, severity FROM sev")
def q_severity(spark, sf):
    return SC.severity(SC.detect_attacks(scored(spark, sf), "attack_type")).select(
        "flow_id", "attack_type", "severity")


@register("severity_counts", SQL_ALERTS + """SELECT CAST(count(*) AS BIGINT) AS total,
  CAST(sum(CASE WHEN severity = 'High' THEN 1 ELSE 0 END) AS BIGINT) AS high,
  CAST(sum(CASE WHEN severity = 'Medium' THEN 1 ELSE 0 END) AS BIGINT) AS medium,
  CAST(sum(CASE WHEN severity = 'Low' THEN 1 ELSE 0 END) AS BIGINT) AS low FROM sev""")
def q_severity_counts(spark, sf):
    return SC.severity_counts(SC.severity(SC.detect_attacks(scored(spark, sf), "attack_type")))


@register("build_alerts", SQL_ALERTS + "SELECT * FROM alr")
def q_build_alerts(spark, sf):
    return alerts(spark, sf)


@register("filter_alerts", SQL_ALERTS + "SELECT * FROM flt")
def q_filter_alerts(spark, sf):
    return filtered(spark, sf)


@register("alerts_by_type", SQL_ALERTS + "SELECT attack_type, CAST(count(*) AS BIGINT) AS count FROM flt GROUP BY 1")
def q_alerts_by_type(spark, sf):
    return SC.alerts_by_type(filtered(spark, sf))


@register("alerts_by_severity", SQL_ALERTS + "SELECT severity, CAST(count(*) AS BIGINT) AS count FROM flt GROUP BY 1")
def q_alerts_by_severity(spark, sf):
    return SC.alerts_by_severity(filtered(spark, sf))


@register("alert_feed", SQL_ALERTS +
          "SELECT alert_id, timestamp, attack_type, confidence_pct, severity FROM flt ORDER BY CAST(substr(alert_id, 5) AS BIGINT) LIMIT 500")
def q_alert_feed(spark, sf):
    return SC.alert_feed(filtered(spark, sf), 500)


@register("score_summary", SQL_ALERTS + """SELECT CAST(sum(CASE WHEN attack_type = 'BENIGN' THEN 1 ELSE 0 END) AS BIGINT) AS n_benign,
  CAST(sum(CASE WHEN attack_type = 'BENIGN' THEN 0 ELSE 1 END) AS BIGINT) AS n_attack FROM base""")
def q_score_summary(spark, sf):
    return SC.score_summary(scored(spark, sf), "attack_type")


@register("score_preview", SQL_ALERTS + """SELECT flow_id, CASE WHEN attack_type = 'BENIGN' THEN 'Benign' ELSE 'Attack' END AS Status,
  attack_type AS Predicted, round(confidence * 100, 1) AS Confidence FROM base ORDER BY flow_id LIMIT 500""")
def q_score_preview(spark, sf):
    s = (scored(spark, sf).withColumnRenamed("attack_type", "Predicted")
         .withColumn("Confidence", F.round(F.col("confidence") * 100, 1))
         .withColumn("Status", F.when(F.col("Predicted") == "BENIGN", "Benign").otherwise("Attack")))
    return SC.score_preview(s, 500)


@register("top_class_probabilities", FX.with_views(["preds_proba"], SQL_BASE[0]) + """SELECT flow_id, rank, class_id, nm.name AS class_name,
  round(p * 100, 2) AS probability_pct FROM (SELECT flow_id, class_id, p,
  row_number() OVER (PARTITION BY flow_id ORDER BY p DESC, class_id) AS rank FROM preds_proba) t
LEFT JOIN nm ON nm.code = t.class_id WHERE rank <= 5""")
def q_top_class_probabilities(spark, sf):
    return SC.top_class_probabilities(FX.preds_proba(spark, sf), names(spark, sf), 5).withColumn(
        "rank", F.col("rank").cast("bigint"))


FIN = S.FINAL_FEATURES
_SCALED = ("tr AS (SELECT * FROM spl WHERE split = 'train')",
           "sp AS (" + "\nUNION ALL ".join(
               f"SELECT '{c}' AS feature, avg({c}) AS m, CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS s FROM tr"
               for c in FIN) + ")",
           )


@register("feature_defaults", S.sql_split(*_SCALED) + "\nUNION ALL ".join(
    f"SELECT {i} AS pos, '{c}' AS feature, round(quantile_cont((CAST({c} AS DOUBLE) - (SELECT m FROM sp WHERE feature = '{c}')) "
    f"/ (SELECT s FROM sp WHERE feature = '{c}'), 0.5), 7) AS \"default\" FROM tr" for i, c in enumerate(FIN)))
def q_feature_defaults(spark, sf):
    d, cols = S.split_dataset(spark, sf)
    tr = materialise(d.where(F.col("split") == "train").select("flow_id", *cols), "train")  # read by every pass
    params = SP.scaler_params(SP.fit_standard_scaler(tr, cols))
    out = SC.feature_defaults(SP.apply_standard_scaler(tr.select("flow_id", *cols), params), cols)
    return out.withColumn("default", F.round("default", 7))


@register("overview_kpis", FX.with_views(["model_preds"], *METRIC_CTES, *S.clean_ctes()) + """
SELECT 'n_rows' AS kpi, CAST(count(*) AS DOUBLE) AS value FROM cleaned
UNION ALL SELECT 'n_features', CAST(10 AS DOUBLE)
UNION ALL SELECT 'n_labels', CAST(count(DISTINCT Label) AS DOUBLE) FROM cleaned
UNION ALL SELECT 'best_f1_multi', CAST(max(f1_weighted) AS DOUBLE) FROM mm WHERE task = 'multi'""")
def q_overview_kpis(spark, sf):
    return SC.overview_kpis(S.cleaned(spark, sf), len(FIN), model_metrics(spark, sf))
