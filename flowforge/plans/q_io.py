"""Registered sources and sinks (2.1): the flow table goes to the shared folder
as CSV or as stage tables and comes back through the library's own readers."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from flowforge.plans import fixtures as FX
from flowforge.plans import stages as S
from flowforge.plans.catalog import register
from flowforge.session import checkpoint_dir, materialise
from flowforge.sources import flows_csv as SRC
from flowforge.sources import store

COLUMNS = ["flow_id", *FX.FEATURES, "label"]
_LIST = ", ".join(COLUMNS)


def _folder(spark, name):
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _csv_files(spark, sf, encoding="UTF-8"):
    """The flows as CSV files with padded and repeated header names; their paths."""
    path = _folder(spark, "flows-csv")
    rows = FX.flows(spark, sf).select(*COLUMNS)
    rows.repartition(4, "flow_id").toDF(*[f" {c} " for c in COLUMNS]).write.option("header", True) \
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False) \
        .option("encoding", encoding).csv(path)
    return [r["path"] for r in spark.read.format("binaryFile").load(path).select("path").collect()]  # file names


@register("read_flows_csv", FX.with_views(["flows"]) + f"SELECT {_LIST} FROM flows")
def q_read_flows_csv(spark, sf):
    """CSV ingest: headers trimmed, types found, infinities kept."""
    return SRC.read_flows(spark, _csv_files(spark, sf)).select(*COLUMNS)


@register("read_encoding_fallback", FX.with_views(["flows"]) + "SELECT flow_id, label || ' é' AS label FROM flows")
def q_read_encoding_fallback(spark, sf):
    """Latin-1 files with bytes that are no UTF-8 are read as Latin-1."""
    path = _folder(spark, "flows-latin1")
    FX.flows(spark, sf).select("flow_id", F.concat("label", F.lit(" é")).alias("label")).repartition(2, "flow_id") \
        .write.option("header", True).option("encoding", "ISO-8859-1") \
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    files = [r["path"] for r in spark.read.format("binaryFile").load(path).select("path").collect()]
    return SRC.read_flows(spark, files)


@register("source_inventory", FX.with_views(["flows"]) + """SELECT CAST(4 AS BIGINT) AS files, CAST(1 AS BIGINT) AS absent,
  CAST(count(*) AS BIGINT) AS rows, TRUE AS sized FROM flows""")
def q_source_inventory(spark, sf):
    """Files and rows found among the expected ones, one of which is not there."""
    files = _csv_files(spark, sf)
    inv = SRC.source_inventory(spark, [*files, files[0] + ".missing"])
    return inv.agg(F.count(F.when(F.col("present"), 1)).alias("files"), F.count(F.when(~F.col("present"), 1)).alias("absent"),
                   F.sum("rows").alias("rows"), (F.min("size_bytes") > 0).alias("sized"))


def _put(spark, path, data):
    """A file with the given bytes, through the file system of the shared folder."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at)
    out.write(bytearray(data))
    out.close()


#: Rows of a packed file, about.
PACKED_ROWS = 250_000


@register("skip_bad_file", FX.with_views(["flows"]) + """SELECT 'kept' AS result, CAST(count(*) AS BIGINT) AS n,
  CAST(sum(flow_id) AS BIGINT) AS ids FROM flows
UNION ALL SELECT 'columns', CAST(count(*) AS BIGINT), NULL FROM flows WHERE trim(label) = 'Bot'
UNION ALL SELECT 'missing', 1, NULL UNION ALL SELECT 'damaged', 1, NULL UNION ALL SELECT 'empty', 1, NULL""")
def q_skip_bad_file(spark, sf):
    """All flows as packed CSV files, among files that are missing, empty or cut
    short and one whose rows lack columns: what is kept, and what is rejected
    and why."""
    path = _folder(spark, "flows-packed")
    flows = materialise(FX.flows(spark, sf).select(*COLUMNS), "flows")  # written whole and in part
    # a packed file is one task's work, so their number follows the rows
    flows.repartition(max(4, -(-flows.count() // PACKED_ROWS)), "flow_id").write.option("header", True) \
        .option("compression", "gzip") \
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    files = [r["path"] for r in spark.read.format("binaryFile").load(path).select("path").collect()]  # file names
    start = spark.read.format("binaryFile").load(files[0]).select(F.expr("substring(content, 1, 500)")).first()[0]
    other = _folder(spark, "flows-bad")
    _put(spark, f"{other}/cut.csv.gz", start)
    _put(spark, f"{other}/empty.csv", b"")
    short = f"{other}/short"
    flows.where("trim(label) = 'Bot'").select(F.concat_ws(",", "flow_id", "label").alias(",".join(COLUMNS))) \
        .repartition(1).write.option("header", True).option("quoteAll", False).option("quote", "").csv(short)
    kept, rejects = SRC.read_flows_checked(
        spark, [*files, f"{other}/cut.csv.gz", f"{other}/empty.csv", short, f"{other}/none.csv"])
    return kept.agg(F.lit("kept").alias("result"), F.count(F.lit(1)).alias("n"), F.sum("flow_id").alias("ids")) \
        .unionByName(rejects.groupBy(F.col("reason").alias("result")).agg(
            F.count(F.lit(1)).alias("n"), F.lit(None).cast("bigint").alias("ids")))


@register("write_dataset", S.sql_split() + "SELECT flow_id, Label_Multi, split FROM spl")
def q_write_dataset(spark, sf):
    """The split as a stage table partitioned by split, read back."""
    d, _ = S.split_dataset(spark, sf)
    path = _folder(spark, "split")
    store.write_dataset(d, path, partition_by=["split"])
    return store.read_dataset(spark, path).select("flow_id", "Label_Multi", F.col("split").cast("string"))


@register("read_dataset", S.sql_split() + "SELECT flow_id, Label_Multi FROM spl WHERE split = 'val'")
def q_read_dataset(spark, sf):
    """The validation split of a stage table (its partition alone is read)."""
    d, _ = S.split_dataset(spark, sf)
    path = _folder(spark, "split")
    store.write_dataset(d, path, partition_by=["split"])
    return store.read_dataset(spark, path).where("split = 'val'").select("flow_id", "Label_Multi")


@register("export_csv", S.sql_cleaned() + "SELECT Label AS label, CAST(count(*) AS BIGINT) AS count FROM cleaned GROUP BY 1")
def q_export_csv(spark, sf):
    """The class distribution as a CSV export, read back."""
    from flowforge.operators import labels as L
    path = _folder(spark, "export")
    store.export_csv(L.class_distribution(S.cleaned(spark, sf)), path)
    return store.read_dataset(spark, path, "csv").select("label", F.col("count").cast("bigint"))
