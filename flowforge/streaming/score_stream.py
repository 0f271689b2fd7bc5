"""Streaming scoring into alerts (re-aim of the 'real-time monitoring' the
reference documents but implements as a batch upload).

File source -> one row per flow (a stateful step: watermark on the flow's own
time, duplicates removed by key) -> the same ``score_flows`` chain as batch
(narrow transforms plus static lookups) -> attack filter -> severity -> parquet
sink. The sink's log names the files of each batch and the checkpoint lies in
the shared folder, so a batch that is run again adds nothing. Sequential alert
ids are a batch notion (global order) and are assigned by ``build_alerts`` when
the alert table is read back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowforge.operators import score as SC


def first_arrivals(stream: DataFrame, key: str, event_time: str, delay: str) -> DataFrame:
    """One row per ``key``: the first that arrives. ``delay`` is how far the
    input is out of order: a key is held until the watermark (greatest
    ``event_time`` seen by earlier batches, less ``delay``) has passed its
    expiry, so the state holds the keys of that span only. A copy is dropped
    whenever it comes: within the span as a known key, later because it lies
    below the watermark. Rows without key or time are dropped here and belong
    to the rejects."""
    known = stream.where(F.col(key).isNotNull() & F.col(event_time).isNotNull())
    return (known.withColumn("_event_time", F.col(event_time).cast("timestamp"))
            .withWatermark("_event_time", delay).dropDuplicatesWithinWatermark([key]).drop("_event_time"))


def alert_stream(stream: DataFrame, model, features: list[str], mapping: DataFrame,
                 scaler: dict | None) -> DataFrame:
    scored, _ = SC.score_flows(stream, model, features, mapping, scaler)
    attacks = SC.detect_attacks(scored, "Predicted").withColumnRenamed("Predicted", "attack_type")
    return SC.severity(attacks, "attack_type")


def score_stream(spark: SparkSession, source_dir: str, schema: T.StructType, model,
                 features: list[str], mapping: DataFrame, scaler: dict | None,
                 sink_dir: str, checkpoint: str, fmt: str = "parquet",
                 available_now: bool = True, max_files_per_trigger: int | None = None,
                 rejects_dir: str | None = None, key: str = "flow_id",
                 event_time: str | None = None, delay: str = "1 day"):
    """Start the streaming query; with ``available_now`` it processes what is
    there and stops (call ``.awaitTermination()``). With ``event_time`` a flow
    raises one alert however often it is delivered (``first_arrivals``); without
    it every delivered row is scored. Rows that cannot be scored (null, NaN or
    infinite features; with ``event_time`` also no key or time) go to
    ``rejects_dir``, if given, by a second query over the same source."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    flows = reader.load(source_dir)
    if event_time:
        flows = first_arrivals(flows, key, event_time, delay)
    alerts = alert_stream(flows, model, features, mapping, scaler)
    w = (alerts.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint))
    when = {"availableNow": True} if available_now else {"processingTime": "10 seconds"}
    if rejects_dir:
        _, rejected = SC.score_flows(reader.load(source_dir), model, features, mapping, scaler,
                                     must_have=(key, event_time) if event_time else ())
        rejected.writeStream.format("parquet").outputMode("append").option(
            "checkpointLocation", f"{checkpoint}-rejects").trigger(**when).start(rejects_dir)
    return w.trigger(**when).start(sink_dir)
