"""Registered streaming query: test flows arrive as parquet files in order of
their time, parts of them twice; a streaming query scores them into alerts and
the alert table is held against batch scoring, row by row."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from flowforge.operators import models as M
from flowforge.operators import score as SC
from flowforge.plans import fixtures as FX
from flowforge.plans import stages as S
from flowforge.plans import training as T
from flowforge.plans.catalog import register
from flowforge.session import checkpoint_dir
from flowforge.streaming.score_stream import score_stream

#: Files arrive in so many spans of time, oldest first.
SPANS = 3


@register("score_stream", S.sql_split() + "SELECT flow_id, TRUE AS one_alert_if_attack, TRUE AS same_alert FROM spl WHERE split = 'test'")
def q_score_stream(spark, sf):
    """Test flows written span by span, then the last and the first span again:
    every flow has as many alerts as batch scoring gives it (0 or 1), and the
    same one."""
    p = T.prepare(spark, sf)
    m = M.fit_model("DecisionTree", "multi", p.split("train"), "Label_Multi", p.classes, p.n_train)
    times = FX.flows(spark, sf).select("flow_id", F.col("flow_ts").cast("timestamp").alias("flow_ts"))
    raw = p.raw.where(F.col("split") == "test").select("flow_id", *p.cols).join(times, "flow_id")
    root = f"{checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex[:8]}"
    at = F.unix_timestamp("flow_ts")
    cuts = raw.agg(F.percentile_approx(at, [(i + 1) / SPANS for i in range(SPANS - 1)]).alias("c"),
                   F.min(at).alias("lo"), F.max(at).alias("hi")).first()
    ends = [cuts["lo"] or 0, *(cuts["c"] or [0] * (SPANS - 1)), (cuts["hi"] or 0) + 1]
    spans = [raw.where((at >= a) & (at < b)) for a, b in zip(ends, ends[1:])]
    for part in [*spans, spans[-1], spans[0]]:
        part.repartition(2).write.mode("append").parquet(f"{root}/incoming")
    widest = max(b - a for a, b in zip(ends, ends[1:]))
    q = score_stream(spark, f"{root}/incoming", raw.schema, m, p.cols, p.mapping, p.scaler,
                     f"{root}/alerts", f"{root}/checkpoint", max_files_per_trigger=2,
                     event_time="flow_ts", delay=f"{widest + 1} seconds")
    q.awaitTermination()
    alert = F.struct("attack_type", "Confidence", "severity")
    streamed = spark.read.parquet(f"{root}/alerts").groupBy("flow_id").agg(
        F.count(F.lit(1)).alias("_n"), F.min(alert).alias("_stream"))
    scored, _ = SC.score_flows(raw, m, p.cols, p.mapping, p.scaler)
    batch = SC.severity(SC.detect_attacks(scored).withColumnRenamed("Predicted", "attack_type"))
    both = raw.select("flow_id").join(batch.select("flow_id", alert.alias("_batch")), "flow_id", "left") \
        .join(streamed, "flow_id", "left")
    wanted = F.when(F.col("_batch").isNull(), 0).otherwise(1)
    return both.select("flow_id", (F.coalesce("_n", F.lit(0)) == wanted).alias("one_alert_if_attack"),
                       F.col("_stream").eqNullSafe(F.col("_batch")).alias("same_alert"))
