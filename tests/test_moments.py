"""The moment table against numpy, with holes, constants, wide and empty tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowforge.operators import features as FE
from flowforge.operators import moments as MO


def test_blocks_merge_to_the_whole():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 7)) * 10.0 ** np.arange(-3, 4) + 1e6
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 3] = 0.1  # constant
    x[:250, 5] = np.nan  # no value in the first half
    total = {}
    for at in range(0, 500, 60):
        for key, s in MO.batch_blocks(x[at:at + 60], 3).items():
            total[key].merge(s) if key in total else total.update({key: s})
    for i in range(7):
        for j in range(i, 7):
            s = total[i // 3, j // 3]
            both = np.isfinite(x[:, i]) & np.isfinite(x[:, j])
            a, b = x[both, i], x[both, j]
            at = (i % 3, j % 3)
            assert s.n[at] == both.sum()
            assert s.a[at] == pytest.approx(a.mean(), rel=1e-12) and s.b[at] == pytest.approx(b.mean(), rel=1e-12)
            scale = a.std() * b.std() * len(a)
            assert s.c[at] == pytest.approx(((a - a.mean()) * (b - b.mean())).sum(), abs=1e-8 * scale + 1e-300)
    assert total[1, 1].c[0, 0] == 0.0  # exactly


@pytest.mark.parametrize("block", [2, 32])
def test_table_agrees_with_sql(spark, block):
    df = spark.range(2000).select(
        "id", ((F.col("id") * 7919) % 1009).cast("double").alias("a"),
        F.when(F.col("id") % 5 == 0, None).otherwise((F.col("id") * 31) % 97 + F.col("id") / 50).alias("b"),
        F.lit(0.1).alias("const"), F.lit(None).cast("double").alias("none"), (F.col("id") % 2).cast("int").alias("y")
    ).repartition(7)
    cols = ["a", "b", "const", "none", "y"]
    m = MO.moment_table(df, cols, block).cache()
    got = {(r["feature_i"], r["feature_j"]): r["r"] for r in MO.correlations(m).collect()}
    assert len(got) == 15
    both = df.where("b is not null")
    want = both.agg(F.corr("b", "y")).first()[0] * both.agg(F.stddev_pop("y")).first()[0] / df.agg(F.stddev_pop("y")).first()[0]
    assert got["b", "y"] == pytest.approx(want)
    assert got["a", "y"] == pytest.approx(df.agg(F.corr("a", "y")).first()[0])
    assert got["a", "const"] is None and got["const", "y"] is None and got["a", "none"] is None
    var = {r["feature"]: r for r in MO.variances(m).collect()}
    assert var["b"]["variance"] == pytest.approx(df.agg(F.var_pop("b")).first()[0]) and var["b"]["n"] == 1600
    assert var["const"]["variance"] == 0.0 and var["none"]["variance"] is None and var["none"]["mean"] is None


def test_selection_on_empty_and_wide_tables(spark):
    empty = spark.createDataFrame([], "flow_id long, a double, b double, Label_Binary int")
    m = FE.selection_moments(empty, ["a", "b"])
    assert [r["variance"] for r in FE.variance_table(empty, ["a", "b"], m=m).collect()] == [None, None]
    assert FE.correlation_drops(empty, ["a", "b"], m=m).count() == 0
    wide = spark.range(200).select("id", *[((F.col("id") * (7 + i)) % 101 + (F.col("id") if i in (3, 70) else 0) * 50)
                                           .cast("double").alias(f"f{i}") for i in range(80)],
                                   (F.col("id") % 2).cast("int").alias("Label_Binary"))
    cols = [f"f{i}" for i in range(80)]
    x = np.array(wide.select(cols).collect(), dtype=float)
    r = np.corrcoef(x.T)
    t = [abs(np.corrcoef(x[:, i], np.arange(200) % 2)[0, 1]) for i in range(80)]
    want = {cols[i] if t[j] >= t[i] else cols[j] for i in range(80) for j in range(i + 1, 80) if abs(r[i, j]) > 0.9}
    assert want and {q["feature"] for q in FE.correlation_drops(wide, cols, 0.9).collect()} == want


def test_family_reads_the_source_once(spark):
    """Given the moments, no statistic goes back to the rows."""
    df = spark.range(100).select("id", (F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"),
                                 (F.col("id") % 2).cast("int").alias("Label_Binary"))
    m = FE.selection_moments(df, ["a", "b"])
    for out in (FE.variance_table(df, ["a", "b"], m=m), FE.target_correlation(df, ["a", "b"], m=m),
                FE.correlation_drops(df, ["a", "b"], m=m)):
        assert "Range" not in out._jdf.queryExecution().optimizedPlan().toString()
