"""Answers that were wrong once, each on a small input of its own."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from flowforge.operators import evaluate as EV
from flowforge.operators import labels as L
from flowforge.operators import models as M
from flowforge.operators import resample as RS
from flowforge.operators import score as SC
from flowforge.operators import split as SP
from flowforge.operators import tune as TU
from flowforge.sources import flows_csv as SRC


def test_alert_feed_orders_by_number(spark):
    df = spark.createDataFrame([("ALT-100000", 2), ("ALT-10001", 1), ("ALT-99999", 3)], "alert_id string, flow_id int") \
        .withColumns({c: F.lit("x") for c in ("timestamp", "attack_type", "confidence_pct", "severity")})
    assert [r["alert_id"] for r in SC.alert_feed(df).collect()] == ["ALT-10001", "ALT-99999", "ALT-100000"]


@pytest.mark.parametrize("stored", [False, True])
def test_alerts_over_generated_and_stored_rows(spark, tmp_path, stored):
    df = spark.range(1000).select(F.col("id").alias("flow_id"), F.when(F.col("id") % 3 == 0, "DDoS").otherwise("Bot")
                                  .alias("attack_type"), F.lit(0.5).alias("confidence"))
    if stored:
        df.write.parquet(str(tmp_path / "a"))
        df = spark.read.parquet(str(tmp_path / "a"))
    rows = SC.build_alerts(df).orderBy("flow_id").collect()
    assert [r["alert_id"] for r in rows[:2]] == ["ALT-00001", "ALT-00002"] and len(rows) == 1000


def test_a_repeated_order_value_spreads_over_ranges(spark):
    """A third of the rows share one order value: numbers are those of one sort,
    no range holds much more than its share."""
    from pyspark.sql import Window
    from flowforge.functions.sequence import ranged
    df = spark.range(24000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise((F.col("id") * 7919) % 5000).alias("at"),
        F.md5(F.col("id").cast("string")).alias("flow"), F.lit("Bot").alias("attack_type"), F.lit(0.5).alias("confidence"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small ranges would be one
    try:
        sizes = [r["count"] for r in ranged(df, ["at", "flow"]).groupBy("_range").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(sizes) == 24000 and max(sizes) < 24000 / 8 * 1.5
    got = SC.build_alerts(df, "at", tie_cols=["flow"])
    assert got.select("alert_id").distinct().count() == 24000
    order = Window.orderBy("at", "flow")
    want = df.withColumn("alert_id", F.format_string("ALT-%05d", F.row_number().over(order))).select("alert_id", "at")
    assert got.select("alert_id", "at").exceptAll(want).count() == 0


def test_infinite_features_are_rejected(spark):
    class Same:
        def transform(self, df):
            from pyspark.ml.functions import array_to_vector
            return df.withColumn("prediction", F.lit(0.0)).withColumn("probability", array_to_vector(F.array(F.lit(1.0))))

    df = spark.createDataFrame([(1, 1.0), (2, float("inf")), (3, float("nan")), (4, None), (None, 2.0)], "flow_id int, a double")
    names = spark.createDataFrame([(0, "BENIGN", 1)], "code int, label string, count long")
    good, bad = SC.score_flows(df, Same(), ["a"], names, must_have=("flow_id",))
    assert [r["flow_id"] for r in good.collect()] == [1]
    assert {r["flow_id"] for r in bad.collect()} == {2, 3, 4, None} and bad.columns == df.columns


def test_undecodable_class_is_an_attack_everywhere(spark):
    df = spark.createDataFrame([(1, "BENIGN"), (2, None), (3, "Bot")], "flow_id int, Predicted string")
    assert sorted(r["flow_id"] for r in SC.detect_attacks(df).collect()) == [2, 3]
    assert tuple(SC.score_summary(df).first()) == (1, 2)


def test_header_only_file_is_present(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "xa.csv").write_text("x,y\n")
    paths = [str(tmp_path / n) for n in ("a.csv", "xa.csv", "none.csv")]
    got = {r["path"]: tuple(r)[1:] for r in SRC.source_inventory(spark, paths).collect()}
    assert got[paths[0]] == (True, 1, 8) and got[paths[1]] == (True, 0, 4) and got[paths[2]][0] is False


def test_replacement_character_in_valid_utf8_is_kept(spark, tmp_path):
    (tmp_path / "u.csv").write_bytes("x,y\n1,a�é\n".encode())
    (tmp_path / "l.csv").write_bytes("x,y\n2,café\n".encode("latin-1"))
    rows = SRC.read_flows(spark, [str(tmp_path / "u.csv"), str(tmp_path / "l.csv")]).collect()
    assert {r["x"]: r["y"] for r in rows} == {1: "a�é", 2: "café"}


def test_smote_with_one_feature(spark):
    df = spark.createDataFrame([(i, 0, float(i)) for i in range(12)] + [(100 + i, 1, float(i)) for i in range(4)],
                               "flow_id long, Label_Multi int, a double")
    out = RS.smote_oversample(df, ["a"], k=3)
    assert {r["Label_Multi"]: r["count"] for r in RS.resampled_class_counts(out).collect()} == {0: 12, 1: 12}


def test_neighbour_search_loses_no_rows(spark):
    df = spark.createDataFrame([(i, 0, float(i * i), float(-i)) for i in range(50)],
                               "flow_id long, Label_Multi int, a double, b double")
    got = RS.knn_within_class(df, ["a", "b"], k=20).groupBy("flow_id").agg(F.countDistinct("nb_rank").alias("n")).collect()
    assert len(got) == 50 and {r["n"] for r in got} == {20}


def test_weights_balance_the_labels_of_each_task(spark):
    rows = [(i, 0, 0) for i in range(6)] + [(10 + i, 1, 1) for i in range(3)] + [(20, 2, 1)]
    df = spark.createDataFrame(rows, "flow_id long, Label_Multi int, Label_Binary int")
    got = {(r["Label_Multi"]): (r["weight"], r["weight_binary"]) for r in SP.with_task_weights(df, df).collect()}
    assert got[0] == pytest.approx((10 / 18, 10 / 12)) and got[1] == pytest.approx((10 / 9, 10 / 8))
    assert got[2] == pytest.approx((10 / 3, 10 / 8))
    assert SP.weight_column("binary") == "weight_binary" and SP.weight_column("multi") == "weight"


def test_untuned_settings_reach_the_estimator():
    made = {n: M.make_estimator(n, "multi", 100, "y", None, params=TU.to_spark_params(n, p))
            for n, p in TU.UNTUNED.items()}
    assert made["DecisionTree"].getMaxDepth() == M.SPARK_MAX_DEPTH
    assert made["RandomForest"].getNumTrees() == 100
    assert (made["BoostedTrees"]["maxIter"], made["BoostedTrees"]["stepSize"], made["BoostedTrees"]["maxDepth"]) == (100, 0.3, 6)


def test_roc_has_no_single_partition_and_piled_scores_are_exact(spark):
    df = spark.range(4000).select(F.expr("cast(id % 3 = 0 as int)").alias("y_true"), F.expr(
        "case when id % 5 = 0 then 0.0 when id % 5 = 1 then 1.0 else 1.0 - 1.0 / (2 + id) end").alias("score"))
    curve = EV.roc_curve(df)
    plan = curve._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan.split("BroadcastExchange")[0]
    area = EV.trapezoid_auc(curve).first()["auc"]
    assert area == pytest.approx(EV.roc_auc_binary(df).first()["roc_auc"])
    pos = [r["score"] for r in df.where("y_true = 1").collect()]
    neg = [r["score"] for r in df.where("y_true = 0").collect()]
    brute = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    assert area == pytest.approx(brute)


def test_benign_code_is_looked_up(spark):
    m = spark.createDataFrame([(0, "Attack", 1), (1, "BENIGN", 5)], "code int, label string, count long")
    assert L.benign_code(m) == 1 and L.benign_code(m.where("code = 0")) is None


def test_lookup_beyond_its_bound_is_not_broadcast(spark):
    from flowforge.functions.expr import bounded_lookup
    small, large = spark.range(5), spark.range(50)
    assert bounded_lookup(large, most=10) is large
    assert "ResolvedHint" in bounded_lookup(small, most=10)._jdf.queryExecution().analyzed().toString()


def test_train_all_grows_the_operators_forest(spark, monkeypatch):
    from flowforge.plans import q_models as Q
    asked = {}

    def train_all(p, names=None, params=None):
        asked.update(params or {})
        return {}, spark.createDataFrame([("RandomForest",), ("BoostedTrees",)], "model_name string")

    monkeypatch.setattr(Q.T, "prepare", lambda spark, sf: None)
    monkeypatch.setattr(Q.T, "train_all", train_all)
    rows = {r["model_name"]: r for r in Q.q_train_all(spark, "").collect()}
    assert "RandomForest" not in asked and rows["RandomForest"]["trees"] == 200
    assert asked["BoostedTrees"]["maxIter"] == rows["BoostedTrees"]["rounds"]
