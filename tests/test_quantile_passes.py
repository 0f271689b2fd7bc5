"""Exact quantiles by brackets, and queries that read their rows once."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowforge.functions.quantiles import exact_quantiles
from flowforge.plans import q_profile, q_score

SF_SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("accuracy,margin", [(10_000, 3.0), (100, 3.0), (100, 0.0)])
def test_brackets_give_exact_quantiles(spark, accuracy, margin):
    """Ties, infinities, tiny groups and brackets that miss their ranks at first."""
    i = F.col("id")
    d = spark.range(40_000).select((i % 3).alias("g"), F.when(i % 5 == 0, 7.0).otherwise((i * 7919) % 30011 / 7.0).alias("v"))
    inf = float("inf")
    odd = [(9, 1.0), (9, 2.0), (8, -0.0), (7, inf), (7, 1.0), (7, 2.0), (7, -inf), (6, None), (6, float("nan"))]
    d = d.unionByName(spark.createDataFrame(odd, "g long, v double"))
    probs = [0.0, 0.01, 0.5, 0.9, 0.99, 1.0]
    got = {(r["g"], r["prob"]): r["q"] for r in exact_quantiles(d, ["g"], "v", probs, accuracy, margin).collect()}
    rows: dict = {}
    for r in d.where("v is not null and not isnan(v)").collect():
        rows.setdefault(r["g"], []).append(r["v"])
    assert set(got) == {(g, p) for g in rows for p in probs}
    for g, v in rows.items():
        v = np.sort(v)
        for p in probs:
            at = p * (len(v) - 1)
            lo, hi = v[math.floor(at)], v[math.ceil(at)]
            want = lo + (hi - lo) * (at - math.floor(at))
            assert got[g, p] == want or math.isclose(got[g, p], want, rel_tol=1e-12) or math.isnan(want) and math.isnan(got[g, p])


@pytest.mark.parametrize("query", [q_profile.q_percentile_clip, q_profile.q_class_histogram, q_score.q_feature_defaults])
def test_tables_are_read_once(spark, query):
    plan = query(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan
