"""Steps that meet every row: splits and caps rank only the buckets that need it,
label codes come from the written table, the search reads stored rows."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from flowforge.functions.expr import hash_order
from flowforge.operators import features as FE
from flowforge.operators import labels as L
from flowforge.operators import split as SP
from flowforge.plans import stages as S
from flowforge.session import materialise

SF = "/root/testdata/sf0.001"


def _rows(spark, n=30_000):
    """Repeated and null keys, a null label, a class of three rows."""
    key = F.when(F.col("id") % 501 == 0, None).otherwise(F.col("id") % (n - 2000))
    label = F.when(F.col("id") % 997 == 0, None).when(F.col("id") < 3, 2).otherwise((F.col("id") % 3 == 0).cast("int"))
    return spark.range(n).select(key.alias("flow_id"), label.alias("Label_Multi"), (F.col("id") * 0.5).alias("x"))


def _ranked(d):
    """Ranks as one window a class gives them: null keys first, then left out."""
    d = d.where("Label_Multi is not null").withColumn("_h", hash_order("flow_id", 42))
    w = Window.partitionBy("Label_Multi")
    return d.withColumn("r", F.row_number().over(w.orderBy("_h", "flow_id"))).withColumn("n", F.count(F.lit(1)).over(w)) \
        .where("flow_id is not null")


def _exchanges(d):
    return d._jdf.queryExecution().executedPlan().toString().count("hashpartitioning(")


def test_split_ranks_only_the_buckets_where_it_changes(spark):
    d = materialise(_rows(spark), "rows")
    got = SP.stratified_split(d)
    train = F.floor((F.col("n") * 70 + 50) / 100)
    val = train + F.floor((F.col("n") - train) / 2)
    want = _ranked(d).withColumn("split", F.when(F.col("r") <= train, "train").when(F.col("r") <= val, "val").otherwise("test"))
    count = lambda x: {tuple(r) for r in x.groupBy("Label_Multi", "flow_id", "split").count().collect()}
    assert got.columns == ["Label_Multi", "flow_id", "x", "split"]
    assert count(got) == count(want)
    assert _exchanges(got) == 1  # for the window over those buckets


def test_cap_moves_only_the_buckets_that_it_can_take(spark):
    d = materialise(_rows(spark), "rows")
    total = d.count()
    got = FE.stratified_cap(d, 900)
    want = _ranked(d).where(F.col("r") <= F.floor(F.col("n") * 900 / F.lit(total) + 0.5))
    count = lambda x: {tuple(r) for r in x.groupBy("Label_Multi", "flow_id").count().collect()}
    assert count(got) == count(want)
    assert _exchanges(got) == 1
    assert FE.stratified_cap(d, total).count() == _ranked(d).count()


def test_label_codes_are_read_from_the_written_table(spark, monkeypatch):
    read, code_table = [], L.code_table
    monkeypatch.setattr(L, "code_table", lambda d, *a, **k: read.append(d.inputFiles()) or code_table(d, *a, **k))
    final, _ = S.final_dataset(spark, SF)
    assert read and all("/cleaned-" in f for files in read for f in files)
    key = ["flow_id", "Label", "Label_Binary", "Label_Multi"]
    assert final.select(*key).exceptAll(S.cleaned(spark, SF).select(*key)).isEmpty()
