"""Exact percentiles (linear interpolation, numpy default) without buffering a
whole group in one task.

``percentile(x, p)`` in Spark keeps every distinct value of a group in one
aggregation buffer: fine for a class of 10^5 rows, fatal for a class holding
a third of 100 TB. Here:

1. one pass: row counts, and per wanted rank an approximate value a little
   below it and one a little above it (a bracket);
2. one pass: values inside a bracket are kept, all others collapse to the gap
   between brackets that they fall in; counted by value (a hot repeated value
   collapses map-side), so what is shuffled is a few ten-thousandths of the rows;
3. running counts over those few values give the wanted ranks.

The answer is exact: a rank that no bracket holds is seen in step 3, and the
brackets are then made wider. No row is compared with more than two values a
wanted rank.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowforge.functions.expr import bounded_lookup
from flowforge.session import materialise

#: A bracket reaches this many times the error of the approximate values beyond
#: its rank, and that much more often each time it missed.
MARGIN, WIDER = 3.0, 64.0


def exact_quantiles(df: DataFrame, group_cols: list[str], value_col: str, probs: list[float],
                    accuracy: int = 10000, margin: float = MARGIN) -> DataFrame:
    """(group_cols..., prob, q): exact linear-interpolated quantiles of
    ``value_col`` per group; null/NaN values are ignored. ``group_cols`` must
    be non-empty (long-form inputs carry a ``feature`` column)."""
    if not group_cols:
        raise ValueError("exact_quantiles needs at least one group column")
    g = list(group_cols)
    v = F.col(value_col).cast("double")
    d = df.where(v.isNotNull() & ~F.isnan(v)).select(*g, v.alias("_v"))
    while True:
        found = materialise(_by_brackets(d, g, probs, accuracy, margin), "quantiles")
        if margin >= accuracy or found.where("q is null").isEmpty():
            return found
        margin = max(margin, 1.0) * WIDER


def _by_brackets(d: DataFrame, g: list[str], probs: list[float], accuracy: int, margin: float) -> DataFrame:
    """(g..., prob, q): q is null where a bracket misses its ranks. A group of
    at most ``accuracy`` rows is one bracket."""
    low = [p - margin / accuracy for p in probs]
    high = [p + margin / accuracy for p in probs]
    at = [min(max(p, 0.0), 1.0) for p in low + high]
    end = F.lit(float("inf"))
    stats = d.groupBy(*g).agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx("_v", at, accuracy).alias("_at"))
    whole = F.col("_n") <= accuracy
    ends = [F.when(whole | F.lit(p <= 0), -end).otherwise(F.col("_at")[i]) for i, p in enumerate(low)] + \
        [F.when(whole | F.lit(p >= 1), end).otherwise(F.col("_at")[len(probs) + i]) for i, p in enumerate(high)]
    stats = bounded_lookup(stats.select(*g, "_n", *[x.alias(f"_e{i}") for i, x in enumerate(ends)]))
    brackets = [(F.col(f"_e{i}"), F.col(f"_e{len(probs) + i}")) for i in range(len(probs))]
    x = F.col("_v")
    inside = F.lit(False)
    for lo, hi in brackets:
        inside = inside | x.between(lo, hi)
    below = F.greatest(F.lit(float("-inf")), *[F.when(hi < x, hi) for _, hi in brackets])
    counts = d.join(stats.drop("_n"), g).select(*g, F.when(inside, x).otherwise(below).alias("_v"), (~inside).alias("_gap")) \
        .groupBy(*g, "_v", "_gap").agg(F.count(F.lit(1)).alias("_c"))
    run = Window.partitionBy(*g).orderBy("_v", "_gap").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = counts.withColumn("_cum", F.sum("_c").over(run)).where(~F.col("_gap"))
    want = stats.select(*g, "_n", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob")) \
        .withColumn("_pos", F.col("prob") * (F.col("_n") - 1).cast("double")).drop("_n")
    holds = lambda r: (F.col("_cum") - F.col("_c") <= r) & (r < F.col("_cum"))
    first, last = F.floor("_pos"), F.ceil("_pos")
    res = counts.join(want, g).groupBy(*g, "prob", "_pos").agg(
        F.min(F.when(holds(first), x)).alias("_lo"), F.max(F.when(holds(last), x)).alias("_hi"))
    return res.select(*g, "prob", (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (F.col("_pos") - first)).alias("q"))


def quantile_wide(q: DataFrame, group_cols: list[str], names: dict[float, str]) -> DataFrame:
    """Pivot (group, prob, q) into one column per probability (names given)."""
    aggs = [F.max(F.when(F.col("prob") == F.lit(float(p)), F.col("q"))).alias(n)
            for p, n in names.items()]
    return q.groupBy(*group_cols).agg(*aggs)
