"""Scoring and alerts.

Scoring is narrow (``model.transform`` + column expressions + a label-count
bounded lookup); the only shuffles are the summary aggregates and the exact
alert numbering, which uses bucketed offsets instead of one global window.
"""

from __future__ import annotations

import datetime as dt

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowforge.functions.quantiles import exact_quantiles, quantile_wide
from flowforge.functions.sequence import global_row_number
from flowforge.operators.labels import BENIGN

# Attack type -> alert severity; anything else is Low.
SEVERITY = [("DDoS", "High"), ("DoS Hulk", "High"), ("DoS GoldenEye", "High"), ("Bot", "High"),
            ("PortScan", "Medium"), ("FTP-Patator", "Medium"), ("SSH-Patator", "Medium")]
DEFAULT_BASE_TS = dt.datetime(2024, 1, 1, 0, 0, 0)


def validate_features(df: DataFrame, required: list[str]) -> None:
    """Raise listing (up to 10) required feature columns that are missing."""
    have = {c.strip() for c in df.columns}
    missing = [f for f in required if f not in have]
    if missing:
        raise ValueError(f"Missing features in input: {missing[:10]}"
                         + ("..." if len(missing) > 10 else ""))


def score_flows(df: DataFrame, model, features: list[str], mapping: DataFrame,
                scaler: dict[str, tuple[float, float]] | None = None,
                reject_invalid: bool = True, must_have: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Select features, scale, predict; adds Predicted, Confidence (% 1 dp)
    and Status to the input columns. Rows with null/NaN/inf features cannot
    be scored (the reference crashes on them): they go to the second frame, as
    do rows with a null in a ``must_have`` column.

    ``model`` is a fitted Spark ML model with ``featuresCol='features'`` that
    outputs ``prediction`` and ``probability``."""
    from pyspark.ml.feature import VectorAssembler
    validate_features(df, features)
    d = df.toDF(*[c.strip() for c in df.columns])
    ok = F.lit(True)
    for c in must_have:
        ok = ok & F.col(f"`{c}`").isNotNull()
    for c in features:
        x = F.col(f"`{c}`").cast("double")
        ok = ok & x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    base = d.withColumn("_ok", ok if reject_invalid else F.lit(True))
    for c in features:
        x = F.col(f"`{c}`").cast("double")
        if scaler and c in scaler:
            m, s = scaler[c]
            x = (x - F.lit(m)) / F.lit(s)
        base = base.withColumn(f"_x_{c}", x)
    good = base.where("_ok")
    bad = base.where(~F.col("_ok")).drop("_ok", *[f"_x_{c}" for c in features])
    vec = VectorAssembler(inputCols=[f"_x_{c}" for c in features], outputCol="features").transform(good)
    pred = model.transform(vec)
    names = mapping.select(F.col("code").cast("double").alias("prediction"), F.col("label").alias("Predicted"))
    out = (pred.join(names, "prediction", "left")
           .withColumn("Confidence", F.round(F.array_max(vector_to_array("probability")) * 100, 1))
           .withColumn("Status", F.when(F.col("Predicted") == BENIGN, "Benign").otherwise("Attack")))
    drop = ["_ok", "features", "rawPrediction", "probability", "prediction",
            *[f"_x_{c}" for c in features]]
    return out.drop(*[c for c in drop if c in out.columns]), bad


def score_summary(scored: DataFrame, pred_col: str = "Predicted") -> DataFrame:
    b = F.col(pred_col) == BENIGN
    return scored.agg(F.sum(F.when(b, 1).otherwise(0)).cast("bigint").alias("n_benign"),
                      F.sum(F.when(b, 0).otherwise(1)).cast("bigint").alias("n_attack"))


def score_preview(scored: DataFrame, n: int = 500, key: str = "flow_id") -> DataFrame:
    return scored.orderBy(key).limit(n).select(key, "Status", "Predicted", "Confidence")


def feature_defaults(scaled_train: DataFrame, features: list[str], n: int | None = None,
                     key: str = "flow_id") -> DataFrame:
    """(feature, default): median of the training rows (of the first ``n`` by
    key, if given); 0.0 for every feature when there is no training data."""
    first = scaled_train if n is None else scaled_train.orderBy(key).limit(n)
    long = first.unpivot([key], [F.col(c).cast("double").alias(c) for c in features], "feature", "value")
    med = quantile_wide(exact_quantiles(long, ["feature"], "value", [0.5]), ["feature"], {0.5: "default"})
    spark = scaled_train.sparkSession
    allf = spark.createDataFrame([(i, f) for i, f in enumerate(features)], "pos int, feature string")
    return allf.join(med, "feature", "left").select("pos", "feature",
                                                    F.coalesce("default", F.lit(0.0)).alias("default"))


def partial_records(spark: SparkSession, records: list[dict], features: list[str],
                    defaults: DataFrame, n_given: int = 10) -> DataFrame:
    """Batch of partial records: the first ``n_given`` features may be given,
    the rest come from ``defaults`` (T-8: values are taken in the space the
    defaults live in — scaled — as the reference's manual path does)."""
    given = features[:n_given]
    rows = [(i, *[(None if r.get(f) is None else float(r[f])) for f in given]) for i, r in enumerate(records)]
    schema = "rec_id int, " + ", ".join(f"`{f}` double" for f in given)
    rec = spark.createDataFrame(rows, schema)
    dv = {r["feature"]: r["default"] for r in defaults.collect()}  # one row per feature
    return rec.select("rec_id", *[(F.coalesce(F.col(f"`{f}`"), F.lit(dv.get(f, 0.0))) if f in given
                                   else F.lit(dv.get(f, 0.0))).cast("double").alias(f) for f in features])


def top_class_probabilities(proba_long: DataFrame, names: DataFrame, k: int = 5,
                            key: str = "flow_id") -> DataFrame:
    """k most probable classes per row (percent, 2 dp). Long input
    (key, class_id, p); the window partitions by row key (k-bounded work)."""
    w = Window.partitionBy(key).orderBy(F.col("p").desc(), F.col("class_id"))
    top = proba_long.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    nm = names.select(F.col("code").alias("class_id"), F.col("label").alias("class_name"))
    return top.join(nm, "class_id", "left").select(
        key, "rank", "class_id", "class_name", F.round(F.col("p") * 100, 2).alias("probability_pct"))


def detect_attacks(scored: DataFrame, pred_col: str = "Predicted") -> DataFrame:
    """All rows but those predicted benign; a class that cannot be decoded
    counts as an attack, as in ``score_summary``."""
    return scored.where(~F.col(pred_col).eqNullSafe(BENIGN))


def severity(df: DataFrame, type_col: str = "attack_type") -> DataFrame:
    """High / Medium from the fixed 7-entry map, else Low (an expression: no
    join for a map of literals)."""
    known = F.create_map(*[F.lit(x) for pair in SEVERITY for x in pair])
    return df.withColumn("severity", F.coalesce(F.try_element_at(known, F.col(type_col)), F.lit("Low")))


def severity_counts(alerts: DataFrame) -> DataFrame:
    s = F.col("severity")
    return alerts.agg(F.count(F.lit(1)).cast("bigint").alias("total"),
                      *[F.sum(F.when(s == v, 1).otherwise(0)).cast("bigint").alias(v.lower())
                        for v in ("High", "Medium", "Low")])


def build_alerts(attacks: DataFrame, order_col: str = "flow_id", type_col: str = "attack_type",
                 conf_col: str = "confidence", base_ts: dt.datetime | None = None,
                 tie_cols: list[str] | None = None) -> DataFrame:
    """Alert ID ``ALT-%05d`` numbered in row order (by ``order_col``, then
    ``tie_cols``: by default all other columns that can be ordered) over the
    attack rows; time = base + 3 s * (i - 1) with base = base_ts - floor(n/100)
    hours (base_ts is an argument: T-10). Numbering is exact and distributed
    (offsets of ranges over the composite key), not a single-partition window:
    one order value that a third of the rows share spreads over ranges."""
    base = F.lit((base_ts or DEFAULT_BASE_TS).strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    if tie_cols is None:
        tie_cols = [f.name for f in attacks.schema.fields if f.name != order_col
                    and isinstance(f.dataType, T.AtomicType) and not isinstance(f.dataType, T.VariantType)]
    r = severity(global_row_number(attacks, [order_col, *tie_cols], "_i", "_n"), type_col)
    secs = (F.col("_i") - 1) * 3 - F.floor(F.col("_n") / 100) * 3600
    return r.select(
        F.format_string("ALT-%05d", F.col("_i")).alias("alert_id"),
        F.timestamp_add("SECOND", secs, base).alias("timestamp"),
        F.col(type_col).alias("attack_type"),
        F.round(F.col(conf_col) * 100, 1).alias("confidence_pct"),
        "severity", order_col)


def filter_alerts(alerts: DataFrame, severities: list[str] | None = None,
                  types: list[str] | None = None) -> DataFrame:
    d = alerts
    if severities is not None:
        d = d.where(F.col("severity").isin(severities))
    if types is not None:
        d = d.where(F.col("attack_type").isin(types))
    return d


def alerts_by_type(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("attack_type").agg(F.count(F.lit(1)).cast("bigint").alias("count"))


def alerts_by_severity(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("severity").agg(F.count(F.lit(1)).cast("bigint").alias("count"))


def alert_feed(alerts: DataFrame, n: int = 500) -> DataFrame:
    """First ``n`` alerts by the number in their id (a top-n, not a full sort)."""
    return alerts.orderBy(F.expr("cast(substring(alert_id, 5) as bigint)")).limit(n).select(
        "alert_id", "timestamp", "attack_type", "confidence_pct", "severity")


def overview_kpis(data: DataFrame, n_features: int, metrics: DataFrame | None,
                  label_col: str = "Label") -> DataFrame:
    """Long form (kpi, value): rows, features, distinct labels, best multi F1."""
    a = data.agg(F.count(F.lit(1)).cast("double").alias("n_rows"),
                 F.lit(float(n_features)).alias("n_features"),
                 F.countDistinct(label_col).cast("double").alias("n_labels"))
    long = a.unpivot([], ["n_rows", "n_features", "n_labels"], "kpi", "value")
    if metrics is not None:
        best = metrics.where(F.col("task") == "multi").agg(F.max("f1_weighted").cast("double").alias("best_f1_multi"))
        long = long.unionByName(best.unpivot([], ["best_f1_multi"], "kpi", "value"))
    return long
