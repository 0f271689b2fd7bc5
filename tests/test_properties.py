"""Property tests for the operators with no SQL oracle."""

import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from flowforge.functions.quantiles import exact_quantiles
from flowforge.functions.sequence import bucketed_rank, global_row_number, md5_bucket
from flowforge.functions.expr import hash_order
from flowforge.operators import explain as X
from flowforge.operators import features as FE
from flowforge.operators import models as M
from flowforge.operators import resample as RS
from flowforge.operators import split as SP
from flowforge.operators import tune as TU
from flowforge.plans import stages as S
from flowforge.plans import training as T

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def prepared(spark):
    return T.prepare(spark, SF_SMALL)


def test_exact_quantiles_match_spark_percentile(spark):
    df = spark.range(0, 2000).select((F.col("id") % 7).alias("g"),
                                     ((F.col("id") * 7919) % 1009 / 7.0).alias("v"))
    df = df.unionByName(spark.range(0, 600).select(F.lit(3).cast("long").alias("g"), F.lit(5.0).alias("v")))
    ours = {(r["g"], r["prob"]): r["q"] for r in exact_quantiles(df, ["g"], "v", [0.01, 0.25, 0.5, 0.99]).collect()}
    ref = df.groupBy("g").agg(F.percentile("v", [0.01, 0.25, 0.5, 0.99]).alias("p")).collect()
    for r in ref:
        for p, q in zip([0.01, 0.25, 0.5, 0.99], r["p"]):
            assert math.isclose(ours[(r["g"], p)], q, rel_tol=1e-12, abs_tol=1e-12)


def test_bucketed_rank_equals_row_number(spark):
    df = spark.range(0, 5000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("c"))
    d = df.withColumn("h", hash_order("k", 42))
    ours = bucketed_rank(d, ["c"], ["h", "k"], md5_bucket("h"))
    ref = d.withColumn("r", F.row_number().over(Window.partitionBy("c").orderBy("h", "k")))
    j = ours.join(ref, ["k"]).where(F.col("_rank") != F.col("r"))
    assert j.count() == 0
    g = global_row_number(df.select("k"), "k", "i", "n")
    assert g.where(F.col("i") != F.col("k") + 1).count() == 0


def test_split_is_partition_independent(spark):
    d, _ = S.final_dataset(spark, SF_SMALL)
    a = SP.stratified_split(d.repartition(1), "Label_Multi", "flow_id").select("flow_id", "split")
    b = SP.stratified_split(d.repartition(7), "Label_Multi", "flow_id").select("flow_id", "split")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    counts = {r["split"]: r["count"] for r in a.groupBy("split").count().collect()}
    total = sum(counts.values())
    assert abs(counts["train"] / total - 0.70) < 0.02


def test_scaler_centres_train(spark, prepared):
    tr = prepared.split("train")
    for c in prepared.cols:
        row = tr.agg(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).first()
        assert abs(row["m"]) < 1e-9
        assert abs(row["s"] - 1.0) < 1e-9


def test_smote_properties(spark):
    d, cols = S.split_dataset(spark, SF_SMALL)
    train = d.where(F.col("split") == "train")
    out = RS.smote_oversample(train, cols, k=5).cache()
    counts = {r["Label_Multi"]: r["count"] for r in RS.resampled_class_counts(out).collect()}
    orig = {r["Label_Multi"]: r["count"] for r in train.groupBy("Label_Multi").count().collect()}
    majority = max(orig.values())
    for c, n in orig.items():
        assert counts[c] == (majority if n >= 2 else n)
    # originals unchanged
    o = out.where(~F.col("is_synthetic")).select("flow_id", *cols)
    assert o.exceptAll(train.select("flow_id", *[F.col(c).cast("double") for c in cols])).count() == 0
    # each synthetic value lies within the class's bounding box
    box = train.groupBy("Label_Multi").agg(*[F.min(c).alias(f"lo_{c}") for c in cols],
                                           *[F.max(c).alias(f"hi_{c}") for c in cols])
    s = out.where("is_synthetic").join(box, "Label_Multi")
    bad = s.where(" OR ".join(f"({c} < lo_{c} - 1e-9 OR {c} > hi_{c} + 1e-9)" for c in cols))
    assert bad.count() == 0
    out.unpersist()


def test_knn_is_exact(spark):
    df = spark.range(0, 300).select(F.col("id").alias("flow_id"), (F.col("id") % 2).alias("Label_Multi"),
                                    ((F.col("id") * 37) % 101).cast("double").alias("a"),
                                    ((F.col("id") * 53) % 97).cast("double").alias("b"),
                                    ((F.col("id") * 11) % 13).cast("double").alias("c"))
    nb = RS.knn_within_class(df, ["a", "b", "c"], k=5)
    pts = df.toPandas()
    got = {}
    for r in nb.collect():
        got.setdefault(r["flow_id"], []).append(r["dist"])
    for _, r in pts.iterrows():
        same = pts[(pts.Label_Multi == r.Label_Multi) & (pts.flow_id != r.flow_id)]
        d = sorted(((same.a - r.a) ** 2 + (same.b - r.b) ** 2 + (same.c - r.c) ** 2) ** 0.5)[:5]
        assert [round(x, 9) for x in sorted(got[r.flow_id])] == [round(x, 9) for x in d]


def test_tree_beats_majority_and_probabilities_sum_to_one(spark, prepared):
    m = M.fit_model("DecisionTree", "multi", prepared.split("train"), "Label_Multi",
                    prepared.classes, prepared.n_train)
    p = M.predict_with_proba(m, prepared.split("test"), "flow_id", "Label_Multi")
    acc = p.agg(F.avg((F.col("prediction") == F.col("Label_Multi")).cast("double"))).first()[0]
    assert acc > 0.85
    sums = p.select(F.aggregate("probability", F.lit(0.0), lambda a, x: a + x).alias("s"))
    assert sums.where(F.abs(F.col("s") - 1.0) > 1e-9).count() == 0


def test_ovr_boosted_trees_probabilities(spark, prepared):
    m = M.fit_model("BoostedTrees", "multi", prepared.split("train"), "Label_Multi", prepared.classes,
                    prepared.n_train, params={"maxIter": 5})
    p = M.predict_with_proba(m, prepared.split("test"), "flow_id", "Label_Multi")
    sums = p.select(F.aggregate("probability", F.lit(0.0), lambda a, x: a + x).alias("s"))
    assert sums.where(F.abs(F.col("s") - 1.0) > 1e-9).count() == 0
    arg = p.select("prediction", F.array_position("probability", F.array_max("probability")).alias("a"))
    assert arg.where(F.col("prediction") != F.col("a") - 1).count() == 0


def test_save_load_same_predictions(spark, prepared):
    m = M.fit_model("BoostedTrees", "multi", prepared.split("train"), "Label_Multi", prepared.classes,
                    prepared.n_train, params={"maxIter": 3})
    path = T.model_path(spark, "test-ovr")
    M.save_model(m, path)
    back = M.load_model("BoostedTrees", "multi", path)
    a = M.predict_with_proba(m, prepared.split("test"))
    b = M.predict_with_proba(back, prepared.split("test"))
    assert a.exceptAll(b).count() == 0


class Blend:
    """Two classes, p1 = a * b + c / 4 within [0, 1]: exact Shapley values are known."""

    def transform(self, df):
        from pyspark.ml.functions import array_to_vector, vector_to_array
        v = vector_to_array("features")
        p1 = v[0] * v[1] + v[2] / 4
        return df.withColumn("probability", array_to_vector(F.array(1 - p1, p1))).withColumn("prediction", F.lit(0.0))


def test_shapley_of_every_class(spark, prepared):
    m = M.fit_model("DecisionTree", "multi", prepared.split("train"), "Label_Multi", prepared.classes,
                    prepared.n_train)
    rows = X.explain_sample(prepared.split("test"), 20)
    from flowforge.operators.profile import sample_rows
    bg = sample_rows(prepared.split("train"), 30)
    att = X.shapley_attribution(m, rows, bg, prepared.cols, n_perm=4).cache()
    assert att.count() == 20 * len(prepared.cols) * len(prepared.classes)
    per = att.groupBy("flow_id", "class_id").agg(F.sum("attribution").alias("s"), F.first("score").alias("fx"),
                                                 F.first("base").alias("b"))
    assert per.where(F.abs(F.col("s") - (F.col("fx") - F.col("b"))) > 1e-9).count() == 0
    assert per.where(~F.col("b").between(0, 1)).count() == 0
    # over the classes of a row a feature's attributions cancel
    assert att.groupBy("flow_id", "feature").agg(F.sum("attribution").alias("s")).where(F.abs("s") > 1e-9).count() == 0


def test_shapley_is_exact_for_pairwise_interactions(spark):
    """An antithetic pair gives a product of two features its exact share."""
    rows = spark.createDataFrame([(1, 0.8, 0.9, 0.4), (2, 0.1, 0.5, 1.0)], "flow_id long, a double, b double, c double")
    bg = spark.createDataFrame([(0.2, 0.3, 0.6)], "a double, b double, c double")
    got = {(r["flow_id"], r["feature"], r["class_id"]): r for r in
           X.shapley_attribution(Blend(), rows, bg, ["a", "b", "c"], n_perm=4, tolerance=1e-6).collect()}
    for k, a, b, c in [(1, 0.8, 0.9, 0.4), (2, 0.1, 0.5, 1.0)]:
        want = {"a": (a - 0.2) * (b + 0.3) / 2, "b": (b - 0.3) * (a + 0.2) / 2, "c": (c - 0.6) / 4}
        for f, v in want.items():
            assert math.isclose(got[k, f, 1]["attribution"], v, abs_tol=1e-12)
            assert math.isclose(got[k, f, 0]["attribution"], -v, abs_tol=1e-12)
            assert got[k, f, 1]["std_error"] < 1e-9 and math.isclose(got[k, f, 1]["base"], 0.21)


def test_shapley_stop_rule_and_edges(spark):
    """More orders only for rows whose error is large; empty sides; a large background."""
    rows = spark.createDataFrame([(1, 0.8, 0.9, 0.4), (2, 0.5, 0.5, 0.5)], "flow_id long, a double, b double, c double")
    one = spark.createDataFrame([(0.5, 0.5, 0.5)] * 3, "a double, b double, c double")
    mixed = spark.createDataFrame([(i / 40, 1 - i / 40, 0.5) for i in range(40)], "a double, b double, c double")
    err = [X.shapley_attribution(Blend(), rows, mixed, ["a", "b", "c"], n_perm=4, tolerance=t, max_perm=64)
           .agg(F.max("std_error")).first()[0] for t in (None, 0.03)]
    assert err[1] < err[0]
    flat = X.shapley_attribution(Blend(), rows.where("flow_id = 2"), one, ["a", "b", "c"], n_perm=4)
    assert flat.where(F.abs("attribution") > 1e-12).count() == 0
    for r, b in ((rows.limit(0), one), (rows, one.limit(0))):
        none = X.shapley_attribution(Blend(), r, b, ["a", "b", "c"])
        assert none.count() == 0 and none.columns == flat.columns
    with pytest.raises(ValueError):
        X.shapley_attribution(Blend(), rows, spark.range(X.MOST_BACKGROUND + 1).selectExpr("0.1 a", "0.1 b", "0.1 c"), ["a", "b", "c"])


def test_param_space_sizes(spark):
    assert {f: TU.grid_size(f) for f in TU.PARAM_GRIDS} == {
        "RandomForest": 96, "BoostedTrees": 3072, "DecisionTree": 48, "LogisticRegression": 10}
    assert TU.param_space(spark, "DecisionTree").count() == 48
    assert len(TU.sample_params(TU.param_space(spark, "DecisionTree"), 15)) == 15
    assert len(TU.sample_params(TU.param_space(spark, "LogisticRegression"), 15)) == 10
    assert TU.to_spark_params("RandomForest", {"max_depth": None, "min_samples_split": 5}) == {"maxDepth": 30}


def test_stratified_cap(spark):
    d, _ = S.final_dataset(spark, SF_SMALL)
    n = d.count()
    capped = FE.stratified_cap(d, n // 2)
    assert abs(capped.count() - n // 2) <= 6  # per-class rounding


def test_stream_equals_batch(spark, prepared, tmpdir_path):
    from flowforge.operators import score as SC
    from flowforge.streaming.score_stream import score_stream
    m = M.fit_model("DecisionTree", "multi", prepared.split("train"), "Label_Multi", prepared.classes,
                    prepared.n_train)
    d, cols = S.split_dataset(spark, SF_SMALL)
    raw = d.where(F.col("split") == "test").select("flow_id", *cols)
    raw.repartition(3).write.parquet(f"{tmpdir_path}/in")
    q = score_stream(spark, f"{tmpdir_path}/in", raw.schema, m, cols, prepared.mapping, prepared.scaler,
                     f"{tmpdir_path}/out", f"{tmpdir_path}/ckpt", max_files_per_trigger=1)
    q.awaitTermination()
    streamed = spark.read.parquet(f"{tmpdir_path}/out").select("flow_id", "attack_type", "severity")
    scored, _ = SC.score_flows(raw, m, cols, prepared.mapping, prepared.scaler)
    batch = SC.severity(SC.detect_attacks(scored).withColumnRenamed("Predicted", "attack_type")).select(
        "flow_id", "attack_type", "severity")
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_stream_gives_a_flow_one_alert(spark, prepared, tmp_path):
    """Copies in one file, in a later file, and long after; rows without key or
    time and rows that cannot be scored go to the rejects."""
    from flowforge.streaming.score_stream import score_stream
    m = M.fit_model("DecisionTree", "multi", prepared.split("train"), "Label_Multi", prepared.classes,
                    prepared.n_train)
    raw = prepared.raw.where(F.col("split") == "test").select("flow_id", *prepared.cols).limit(300)
    at = raw.withColumn("at", F.timestamp_seconds(F.col("flow_id") * 60)).toPandas().sort_values("flow_id")
    first, second = at.iloc[:150], at.iloc[150:]
    odd = second.head(3).copy()
    odd["flow_id"], odd[prepared.cols[0]] = [-1, -2, -3], [float("nan"), 1.0, 1.0]
    odd["at"] = [second["at"].iloc[0], None, second["at"].iloc[0]]
    schema = raw.withColumn("at", F.lit(None).cast("timestamp")).schema

    def arrive(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    def run():
        score_stream(spark, f"{tmp_path}/in", schema, m, prepared.cols, prepared.mapping, prepared.scaler,
                     f"{tmp_path}/out", f"{tmp_path}/ckpt", max_files_per_trigger=1, event_time="at",
                     delay="30 days", rejects_dir=f"{tmp_path}/bad").awaitTermination()
        for q in spark.streams.active:
            q.awaitTermination()
        rows = spark.read.parquet(f"{tmp_path}/out").groupBy("flow_id").count().collect()
        return {r["flow_id"]: r["count"] for r in rows}

    import pandas as pd
    arrive(pd.concat([first, first.head(20)]))
    arrive(pd.concat([second, odd, first.tail(20)]))
    once = run()
    assert set(once.values()) == {1} and -2 not in once and -1 not in once
    arrive(first)  # a restarted query sees old files under new names
    arrive(second)
    assert run() == once
    bad = {r["flow_id"] for r in spark.read.parquet(f"{tmp_path}/bad").collect()}
    assert bad == {-1, -2}


def test_run_stages_end_to_end(spark, tmpdir_path):
    from flowforge.plans.run_stages import run_stages
    paths = run_stages(spark, SF_SMALL, f"{tmpdir_path}/out", models=["DecisionTree"], tune=True, n_iter=2)
    comp = spark.read.parquet(paths["model_comparison"]).collect()
    assert {(r["model_name"], r["task"]) for r in comp} == {("DecisionTree", "binary"), ("DecisionTree", "multi")}
    assert all(r["f1_weighted"] > 0.8 for r in comp)
    res = spark.read.parquet(paths["train_resampled"])
    counts = [r["count"] for r in res.groupBy("Label_Multi").count().collect()]
    assert len(set(counts)) == 1  # every class at the majority count
    report = spark.read.parquet(paths["tuning_report"]).collect()
    assert [r["model_name"] for r in report] == ["DecisionTree"] and report[0]["tuned_f1"] > 0.8
    alerts = spark.read.parquet(paths["alerts"])
    assert alerts.where(F.col("alert_id") == "ALT-00001").count() == 1
    assert spark.read.parquet(paths["split"]).where("split = 'test'").count() > 0


def test_knn_exact_with_hot_duplicate_group(spark):
    base = spark.range(0, 100).select(F.col("id").alias("flow_id"), F.lit(0).cast("long").alias("Label_Multi"),
                                      ((F.col("id") * 37) % 101).cast("double").alias("a"),
                                      ((F.col("id") * 53) % 97).cast("double").alias("b"))
    dup = spark.range(100, 300).select(F.col("id").alias("flow_id"), F.lit(0).cast("long").alias("Label_Multi"),
                                       F.lit(5.0).alias("a"), F.lit(7.0).alias("b"))
    df = base.unionByName(dup)
    nb = RS.knn_within_class(df, ["a", "b"], k=5)
    pts = df.toPandas()
    got = {}
    for r in nb.collect():
        got.setdefault(r["flow_id"], []).append(r["dist"])
    for _, r in pts.iterrows():
        other = pts[pts.flow_id != r.flow_id]
        d = sorted(((other.a - r.a) ** 2 + (other.b - r.b) ** 2) ** 0.5)[:5]
        assert [round(x, 9) for x in sorted(got[r.flow_id])] == [round(x, 9) for x in d]
