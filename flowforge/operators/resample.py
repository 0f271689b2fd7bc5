"""Minority oversampling (SMOTE) with exact within-class k-nearest neighbours.

Neighbours come from ``operators.neighbours`` (pivots and the triangle
inequality). The search runs on distinct vectors with multiplicities, so a huge
group of identical rows fills its own ranks at distance 0 and forms no pairs.

Synthesis is keyed, not random: synthetic j of class c uses base row
(j mod n_c) in md5 order; md5(class|j|seed) gives its neighbour's rank and its
gap in [0, 1). Re-runs and any partitioning give the same rows, and SQL can
reproduce them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowforge.operators.features import class_quota_rank
from flowforge.operators.neighbours import nearest
from flowforge.session import materialise

GEN_CHUNK = 100000  # synthetic rows generated per task slice of one base row

TASK_ROWS = 200000  # synthetic rows a task generates, about


def knn_within_class(df: DataFrame, cols: list[str], label_col: str = "Label_Multi",
                     key: str = "flow_id", k: int = 5, report: dict | None = None) -> DataFrame:
    """(key, label, nb_rank 1..k, nb_key, dist) — exact k nearest other rows
    of the same class (fewer when the class is smaller than k + 1).

    The search runs on distinct vectors with multiplicities: a row's own
    copies fill its first ranks at distance 0, so a huge group of identical
    rows needs no candidates at all (no pairs among copies are formed).
    ``nb_key`` is the smallest key holding the neighbour's vector."""
    rows = df.select(key, label_col, *[F.col(c).cast("double").alias(c) for c in cols])
    vec = rows.groupBy(label_col, *cols).agg(F.min(key).alias("_v"), F.count(F.lit(1)).alias("_m"))
    vec = materialise(vec, "vectors")
    sizes = vec.groupBy(label_col).agg(F.sum("_m").alias("_n"))  # one row per class
    pts = materialise(vec.join(F.broadcast(sizes), label_col)
                      .withColumn("_self", F.least(F.lit(k), F.col("_m") - 1))
                      .withColumn("_need", F.least(F.lit(k), F.col("_n") - 1) - F.col("_self"))
                      .drop("_n"), "points")
    # ranks filled by the row's own copies (distance 0)
    own = (pts.where(F.col("_self") > 0)
           .select("_v", F.explode(F.sequence(F.lit(1), F.col("_self").cast("int"))).alias("nb_rank"),
                   F.col("_v").alias("nb_v"), F.lit(0.0).alias("dist")))
    other = nearest(pts.drop("_self"), cols, label_col, report).join(pts.select("_v", "_self"), "_v")
    first = (F.col("_self") + F.col("_before") + 1).cast("int")
    other = other.select("_v", F.explode(F.sequence(first, first + F.col("_take").cast("int") - 1)).alias("nb_rank"),
                         "nb_v", "dist")
    nbv = materialise(own.unionByName(other), "neighbours")
    rv = rows.join(vec.select(label_col, *cols, "_v"), [label_col, *cols])  # hot vector: AQE skew join
    return rv.join(nbv, "_v").select(key, label_col, "nb_rank", F.col("nb_v").alias("nb_key"), "dist")


def _hashed(label: F.Column, j: F.Column, seed: int) -> F.Column:
    """52 bits of md5(class|j|seed) as a long."""
    hexed = F.md5(F.concat_ws("|", label.cast("string"), j.cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(hexed, 1, 13), 16, 10).cast("long")


def smote_oversample(df: DataFrame, cols: list[str], label_col: str = "Label_Multi",
                     key: str = "flow_id", k: int = 5, seed: int = 42) -> DataFrame:
    """Every non-majority class grows to the majority count with synthetic
    rows x_base + u * (x_nb - x_base); originals are kept unchanged.
    Output: key, label, features, is_synthetic (synthetic keys are negative)."""
    base = materialise(df.select(key, label_col, *[F.col(c).cast("double").alias(c) for c in cols]), "base")
    counts = base.groupBy(label_col).agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumn("_M", F.max("_n").over(Window.partitionBy()))  # one row per class
    counts = counts.withColumn("_s", F.col("_M") - F.col("_n"))
    minority = counts.where((F.col("_s") > 0) & (F.col("_n") >= 2)).select(label_col)
    mino = base.join(minority, label_col, "left_semi")
    nb = knn_within_class(mino, cols, label_col, key, k)
    # class offsets for the new negative keys (tiny table)
    w_off = Window.orderBy(label_col).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_off", F.coalesce(F.sum("_s").over(w_off), F.lit(0)))
    ranked = class_quota_rank(mino, label_col, key, seed).join(
        counts.select(label_col, "_s", "_off"), label_col)
    per = F.floor(F.col("_s") / F.col("_n")) + F.when((F.col("_rank") - 1) < F.col("_s") % F.col("_n"), 1).otherwise(0)
    # a base row meets its few neighbours before it is multiplied: synthetic
    # rows, which outnumber the base rows, pass through no join
    other = base.select(F.col(key).alias("nb_key"), F.struct(*cols).alias("_x"))
    nbs = nb.join(other, "nb_key").groupBy(key).agg(F.collect_list(F.struct("nb_rank", "_x")).alias("_nbs"),
                                                    F.max("nb_rank").alias("_k"))
    # a base row of a tiny class may need millions of copies: explode chunk
    # ids first, spread the chunks over tasks, then explode inside each chunk
    chunk = F.lit(GEN_CHUNK)
    # few bytes become many rows here: tasks follow the rows to come
    to_come = counts.agg(F.sum("_s")).first()[0] or 0
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), to_come // TASK_ROWS)
    gen = (ranked.withColumn("_cnt", per.cast("long")).where(F.col("_cnt") > 0).join(nbs, key)
           .withColumn("_ch", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_cnt") - 1) / chunk))))
           .repartition(tasks, key, "_ch")
           .withColumn("_t", F.explode(F.sequence(F.col("_ch") * chunk,
                                                  F.least(F.col("_cnt"), (F.col("_ch") + 1) * chunk) - 1)))
           .withColumn("_j", F.col("_rank") - 1 + F.col("_t") * F.col("_n")))
    gen = (gen.withColumn("_at", (F.pmod(_hashed(F.col(label_col), F.col("_j"), seed), F.col("_k")) + 1).cast("int"))
           .withColumn("_u", _hashed(F.col(label_col), F.col("_j"), seed + 1).cast("double") / F.lit(float(1 << 52)))
           .withColumn("_nb", F.explode(F.filter("_nbs", lambda x: x["nb_rank"] == F.col("_at")))))
    synth = gen.select((-(F.col("_off") + F.col("_j") + 1)).cast("long").alias(key), label_col,
                       *[(F.col(c) + F.col("_u") * (F.col("_nb")["_x"][c] - F.col(c))).alias(c) for c in cols],
                       F.lit(True).alias("is_synthetic"))
    return base.withColumn("is_synthetic", F.lit(False)).unionByName(synth)


def resampled_class_counts(df: DataFrame, label_col: str = "Label_Multi") -> DataFrame:
    return df.groupBy(label_col).agg(F.count(F.lit(1)).cast("bigint").alias("count"))
