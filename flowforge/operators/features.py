"""Feature selection: population-variance filter, target
correlation, pairwise correlation filter, stratified cap, forest importance,
projection and the selection funnel. Variances and both kinds of correlation
are read from one moment table (``selection_moments``), one pass over the rows;
each function takes it as ``m`` or makes its own.

The per-feature statistics are small (one row per feature); the driver reads
them only to decide which columns the next plan selects, as any fitted
transformer does.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowforge.functions.expr import bounded_lookup, hash_order
from flowforge.functions.sequence import bucketed_rank, md5_bucket
from flowforge.operators.forest import ForestClassifier
from flowforge.operators.moments import correlations, moment_table, variances
from flowforge.operators.profile import feature_columns
from flowforge.session import materialise

LABELS = ["Label", "Label_Binary", "Label_Multi"]


def numeric_features(df: DataFrame, key: str | None = "flow_id") -> list[str]:
    return feature_columns(df, key=key)


def selection_moments(df: DataFrame, cols: list[str], target: str | None = "Label_Binary") -> DataFrame:
    """Moments of all pairs of ``cols`` and the target, written once."""
    more = [target] if target in df.columns else []
    return materialise(moment_table(df, [*cols, *more]), "moments")


def variance_table(df: DataFrame, cols: list[str], threshold: float = 0.01,
                   m: DataFrame | None = None) -> DataFrame:
    """(pos, feature, variance, kept): population variance > threshold keeps."""
    v = variances(m if m is not None else moment_table(df, cols)).select("feature", "variance")
    names = df.sparkSession.createDataFrame(list(enumerate(cols)), "pos int, feature string")
    return names.join(v, "feature", "left").select("pos", "feature", "variance",
                                                   (F.col("variance") > F.lit(threshold)).alias("kept"))


def variance_filter(df: DataFrame, threshold: float = 0.01, cols: list[str] | None = None,
                    m: DataFrame | None = None):
    """Returns (df without removed columns, removed list)."""
    cols = cols or numeric_features(df)
    rows = variance_table(df, cols, threshold, m).orderBy("pos").collect()
    removed = [r["feature"] for r in rows if not r["kept"]]
    return df.drop(*removed), removed


def target_correlation(df: DataFrame, cols: list[str] | None = None, target: str = "Label_Binary",
                       m: DataFrame | None = None) -> DataFrame:
    """(pos, feature, target_corr = |corr(feature, target)|); null for a
    constant feature (T-11)."""
    cols = cols or numeric_features(df)
    r = correlations(m if m is not None else selection_moments(df, cols, target))
    t = r.where((F.col("feature_j") == target) & (F.col("feature_i") != target)).select(
        F.col("feature_i").alias("feature"), F.abs("r").alias("target_corr"))
    names = df.sparkSession.createDataFrame(list(enumerate(cols)), "pos int, feature string")
    return names.join(t, "feature", "left").select("pos", "feature", "target_corr")


def correlation_drops(df: DataFrame, cols: list[str], threshold: float = 0.95,
                      target: str | None = "Label_Binary", m: DataFrame | None = None) -> DataFrame:
    """Features dropped by the pairwise filter: for each pair i < j (column
    order) with |r| > threshold drop i when |t_j| >= |t_i| else j; no target
    -> drop i. Pairs are judged independently; the result is a set."""
    has_target = target is not None and target in df.columns
    m = m if m is not None else selection_moments(df, cols, target)
    r = correlations(m)
    pairs = r.where((F.col("pos_i") < F.col("pos_j")) & F.col("feature_i").isin(cols)
                    & F.col("feature_j").isin(cols) & (F.abs("r") > F.lit(threshold)))
    if not has_target:
        drop = pairs.select(F.col("feature_i").alias("feature"))
    else:
        tc = bounded_lookup(target_correlation(df, cols, target, m))
        ti = tc.select(F.col("feature").alias("feature_i"), F.col("target_corr").alias("_ti"))
        tj = tc.select(F.col("feature").alias("feature_j"), F.col("target_corr").alias("_tj"))
        p = pairs.join(ti, "feature_i").join(tj, "feature_j")
        drop = p.select(F.when(F.col("_tj") >= F.col("_ti"), F.col("feature_i"))
                        .otherwise(F.col("feature_j")).alias("feature"))
    return drop.distinct()


def correlation_filter(df: DataFrame, threshold: float = 0.95, cols: list[str] | None = None,
                       target: str | None = "Label_Binary", m: DataFrame | None = None):
    cols = cols or numeric_features(df)
    removed = sorted(r["feature"] for r in correlation_drops(df, cols, threshold, target, m).collect())
    return df.drop(*removed), removed


def class_quota_rank(df: DataFrame, label_col: str, key: str, seed: int = 42,
                     max_rank: Column | None = None) -> DataFrame:
    """Rank inside each class by md5(key|seed) without a one-task sort per
    class (bucketed by md5 prefix): adds ``_rank`` (1-based) and ``_n``."""
    d = df.withColumn("_h", hash_order(key, seed))
    return bucketed_rank(d, [label_col], ["_h", key], md5_bucket("_h"), max_rank=max_rank).drop("_h")


def stratified_cap(df: DataFrame, n: int, label_col: str = "Label_Multi", key: str = "flow_id",
                   seed: int = 42) -> DataFrame:
    """Stratified sample of ``n`` rows when the table is larger (else the
    table). Quota per class = round(n * n_c / N); rows taken in md5 order."""
    total = F.lit(df.count())
    quota = F.when(total > F.lit(n), F.floor(F.col("_n") * F.lit(n) / total + F.lit(0.5))).otherwise(F.col("_n")).cast("long")
    r = class_quota_rank(df, label_col, key, seed, quota)
    return r.where(F.col("_rank") <= quota).drop("_rank", "_n")


def importance_topk(df: DataFrame, cols: list[str], label_col: str = "Label_Multi", k: int = 30,
                    num_trees: int = 100, max_depth: int = 20, seed: int = 42,
                    max_bins: int = 32) -> DataFrame:
    """Random-forest impurity importances, descending with name tie-break:
    (rank, feature, importance). The fit is distributed (``operators.forest``)."""
    vec = VectorAssembler(inputCols=cols, outputCol="features").transform(
        df.select(*[F.col(c).cast("double").alias(c) for c in cols], F.col(label_col)))
    rf = ForestClassifier(labelCol=label_col, featuresCol="features", numTrees=num_trees,
                          maxDepth=min(max_depth, 30), seed=seed, maxBins=max_bins)
    model = rf.fit(vec)
    imp = model.featureImportances.toArray()
    rows = sorted(((cols[i], float(imp[i])) for i in range(len(cols))), key=lambda t: (-t[1], t[0]))
    spark = df.sparkSession
    return spark.createDataFrame([(i + 1, f, v) for i, (f, v) in enumerate(rows[:k])],
                                 "rank int, feature string, importance double")


def project_selected(df: DataFrame, selected: list[str], key: str | None = "flow_id") -> DataFrame:
    """Selected features plus the label columns that exist (and the key)."""
    keep = ([key] if key and key in df.columns else []) + list(selected) + [
        c for c in LABELS if c in df.columns]
    return df.select(*keep)


def selection_funnel(initial: int, after_variance: int, after_correlation: int,
                     final: int, spark) -> DataFrame:
    rows = [(0, "initial", initial, 0), (1, "after_variance", after_variance, initial - after_variance),
            (2, "after_correlation", after_correlation, after_variance - after_correlation),
            (3, "final", final, after_correlation - final)]
    return spark.createDataFrame(rows, "step int, stage string, n_features int, removed int")
