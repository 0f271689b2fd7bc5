"""Registered queries for profiling (2.3) and feature selection (2.4)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from flowforge.operators import features as FE
from flowforge.operators import profile as P
from flowforge.plans import fixtures as FX
from flowforge.plans import stages as S
from flowforge.plans.catalog import register
from flowforge.session import materialise

FEAT = FX.FEATURES
POS = {c: i for i, c in enumerate(FEAT)}


def _u(template: str, cols: list[str]) -> str:
    """UNION ALL of ``template`` formatted per feature (c = name, i = pos)."""
    return "\nUNION ALL ".join(template.format(c=c, i=POS.get(c, len(POS) + ("Label_Binary", "Label_Multi").index(c) if c not in POS else 0)) for c in cols)


def _corr_expr(a: str, b: str) -> str:
    return f"CASE WHEN var_pop({a}) = 0 OR var_pop({b}) = 0 THEN NULL ELSE corr({a}, {b}) END"


def sql_corr_long(cols: list[str], src: str = "cleaned", name: str = "cm_long") -> list[str]:
    one = ", ".join(f"{_corr_expr(a, b)} AS c_{i}_{j}" for i, a in enumerate(cols)
                    for j, b in enumerate(cols))
    rows = "\nUNION ALL ".join(
        f"SELECT '{a}' AS feature_i, '{b}' AS feature_j, {i} AS pos_i, {j} AS pos_j, c_{i}_{j} AS r FROM cm_one"
        for i, a in enumerate(cols) for j, b in enumerate(cols))
    return [f"cm_one AS (SELECT {one} FROM {src})", f"{name} AS ({rows})"]


def cleaned(spark, sf):
    return S.cleaned(spark, sf)


# ------------------------------------------------------------------ 2.3
@register("dataset_overview", S.sql_cleaned() +
          "SELECT CAST(count(*) AS BIGINT) AS n_rows, 17 AS n_columns, 5 AS n_integer, "
          "11 AS n_floating, 1 AS n_string, 0 AS n_other FROM cleaned")
def q_dataset_overview(spark, sf):
    return P.dataset_overview(cleaned(spark, sf))


_DESC = [*FEAT, "Label_Binary", "Label_Multi"]


@register("describe_numeric", S.sql_cleaned() + _u(
    "SELECT {i} AS pos, '{c}' AS feature, avg({c}) AS mean, stddev_samp({c}) AS std, "
    "CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM cleaned", _DESC))
def q_describe_numeric(spark, sf):
    return P.describe_numeric(cleaned(spark, sf))


@register("correlation_matrix", S.sql_cleaned(False, *sql_corr_long(FEAT)) +
          "SELECT feature_i, feature_j, r FROM cm_long")
def q_correlation_matrix(spark, sf):
    return P.correlation_matrix(cleaned(spark, sf))


@register("top_k_correlated", S.sql_cleaned(False, *sql_corr_long(FEAT), """sc AS (
  SELECT feature_i, avg(abs(r)) AS mean_abs_r FROM cm_long GROUP BY feature_i),
top AS (SELECT feature_i, CAST(row_number() OVER (ORDER BY mean_abs_r DESC NULLS LAST, feature_i) AS INT) AS rank_i FROM sc)""")
          + """SELECT m.feature_i, m.feature_j, m.r, t.rank_i FROM cm_long m JOIN top t ON m.feature_i = t.feature_i
  WHERE t.rank_i <= 5 AND m.feature_j IN (SELECT feature_i FROM top WHERE rank_i <= 5)""")
def q_top_k_correlated(spark, sf):
    return P.top_k_correlated(cleaned(spark, sf), 5)


SQL_VAR = ("vs AS (" + _u("SELECT {i} AS pos, '{c}' AS feature, var_samp({c}) AS variance FROM cleaned", FEAT) + ")",
           "top8 AS (SELECT feature, variance, CAST(row_number() OVER (ORDER BY variance DESC NULLS LAST, pos) AS INT) AS rank FROM vs)")


@register("top_k_variance", S.sql_cleaned(False, *SQL_VAR) +
          "SELECT feature, variance, rank FROM top8 WHERE rank <= 8")
def q_top_k_variance(spark, sf):
    return P.top_k_variance(cleaned(spark, sf), 8)


SQL_LONG = "lng AS (" + _u("SELECT flow_id, Label_Binary, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM cleaned", FEAT) + ")"
SQL_CLIP = (SQL_LONG, """pq AS (SELECT feature, quantile_cont(value, 0.01) AS lo, quantile_cont(value, 0.99) AS hi FROM lng GROUP BY feature)""",
            """clp AS (SELECT l.flow_id, l.Label_Binary, l.feature, l.value, least(greatest(l.value, pq.lo), pq.hi) AS clipped
   FROM lng l JOIN pq ON l.feature = pq.feature WHERE l.feature IN (SELECT feature FROM top8 WHERE rank <= 8))""")


def _top8_clipped(spark, sf):
    c = materialise(cleaned(spark, sf), "cleaned")  # read by every pass
    top = [r["feature"] for r in P.top_k_variance(c, 8).orderBy("rank").collect()]
    return P.percentile_clip(c, top, ["flow_id", "Label_Binary"])


@register("percentile_clip", S.sql_cleaned(False, *SQL_VAR, *SQL_CLIP) + "SELECT * FROM clp")
def q_percentile_clip(spark, sf):
    return _top8_clipped(spark, sf)


@register("class_histogram", S.sql_cleaned(False, *SQL_VAR, *SQL_CLIP, """rg AS (
  SELECT feature, Label_Binary, CASE WHEN min(clipped) = max(clipped) THEN min(clipped) - 0.5 ELSE min(clipped) END AS lo,
    CASE WHEN min(clipped) = max(clipped) THEN max(clipped) + 0.5 ELSE max(clipped) END AS hi, count(clipped) AS n
  FROM clp GROUP BY feature, Label_Binary),
rgw AS (SELECT feature, Label_Binary, lo, (hi - lo) / CAST(50 AS DOUBLE) AS w, n FROM rg),
cnt AS (SELECT c.feature, c.Label_Binary, CAST(least(floor((c.clipped - r.lo) / r.w), 49) AS INT) AS bin, count(*) AS k
  FROM clp c JOIN rgw r ON c.feature = r.feature AND c.Label_Binary = r.Label_Binary WHERE c.clipped IS NOT NULL GROUP BY 1, 2, 3)""")
          + """SELECT r.feature, r.Label_Binary AS label_binary, CAST(b.bin AS INT) AS bin, r.lo + b.bin * r.w AS bin_lo,
  CAST(coalesce(cnt.k, 0) AS BIGINT) AS count, CAST(coalesce(cnt.k, 0) AS DOUBLE) / (r.n * r.w) AS density
FROM rgw r CROSS JOIN range(0, 50) AS b(bin)
LEFT JOIN cnt ON cnt.feature = r.feature AND cnt.Label_Binary = r.Label_Binary AND cnt.bin = b.bin""")
def q_class_histogram(spark, sf):
    return P.class_histogram(_top8_clipped(spark, sf))


SQL_SAMPLE = "smp AS (SELECT * FROM cleaned ORDER BY md5(CAST(flow_id AS VARCHAR) || '|42'), flow_id LIMIT 2000)"


@register("sample_rows", S.sql_cleaned(False, SQL_SAMPLE) + "SELECT * FROM smp")
def q_sample_rows(spark, sf):
    return P.sample_rows(cleaned(spark, sf), 2000)


_BOX = FEAT[:6]


@register("box_stats_by_class", S.sql_cleaned(False, "bl AS (" + _u(
    "SELECT Label_Binary, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM cleaned", _BOX) + ")", """cap AS (
  SELECT feature, quantile_cont(value, 0.99) AS cap FROM bl GROUP BY feature),
bc AS (SELECT bl.Label_Binary, bl.feature, least(bl.value, cap.cap) AS value FROM bl JOIN cap ON bl.feature = cap.feature),
bq AS (SELECT feature, Label_Binary, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
  quantile_cont(value, 0.75) AS q3 FROM bc GROUP BY feature, Label_Binary)""") + """SELECT bq.feature, bq.Label_Binary AS label_binary, bq.q1, bq.median, bq.q3,
  min(CASE WHEN bc.value >= bq.q1 - 1.5 * (bq.q3 - bq.q1) THEN bc.value END) AS whisker_low,
  max(CASE WHEN bc.value <= bq.q3 + 1.5 * (bq.q3 - bq.q1) THEN bc.value END) AS whisker_high,
  CAST(sum(CASE WHEN bc.value < bq.q1 - 1.5 * (bq.q3 - bq.q1) OR bc.value > bq.q3 + 1.5 * (bq.q3 - bq.q1) THEN 1 ELSE 0 END) AS BIGINT) AS n_outliers,
  CAST(count(*) AS BIGINT) AS n
FROM bc JOIN bq ON bc.feature = bq.feature AND bc.Label_Binary = bq.Label_Binary
GROUP BY bq.feature, bq.Label_Binary, bq.q1, bq.median, bq.q3""")
def q_box_stats_by_class(spark, sf):
    c = cleaned(spark, sf)
    return P.box_stats_by_class(c, P.match_columns(c))


@register("dataset_summary", S.sql_cleaned(False, """ds AS (SELECT Label, count(*) AS c FROM cleaned GROUP BY Label),
att AS (SELECT Label, c FROM ds WHERE Label <> 'BENIGN' ORDER BY c DESC, Label LIMIT 1),
rar AS (SELECT Label, c FROM ds ORDER BY c ASC, Label LIMIT 1)""") + """SELECT CAST((SELECT sum(c) FROM ds) AS BIGINT) AS total_samples,
  13 AS n_features, CAST((SELECT count(*) FROM ds) AS BIGINT) AS n_labels,
  (SELECT Label FROM att) AS most_common_attack, CAST((SELECT c FROM att) AS BIGINT) AS most_common_count,
  (SELECT Label FROM rar) AS rarest_label, CAST((SELECT c FROM rar) AS BIGINT) AS rarest_count,
  CAST((SELECT coalesce(sum(c), 0) FROM ds WHERE Label = 'BENIGN') AS DOUBLE) / CAST((SELECT c FROM rar) AS DOUBLE) AS imbalance_ratio""")
def q_dataset_summary(spark, sf):
    return P.dataset_summary(cleaned(spark, sf))


@register("dataset_head", S.sql_cleaned() + "SELECT * FROM cleaned ORDER BY flow_id LIMIT 20")
def q_dataset_head(spark, sf):
    return P.dataset_head(cleaned(spark, sf), 20)


# ------------------------------------------------------------------ 2.4
SQL_VARPOP = "vp AS (" + _u("SELECT {i} AS pos, '{c}' AS feature, var_pop({c}) AS variance FROM cleaned", FEAT) + ")"


@register("variance_filter", S.sql_cleaned(False, SQL_VARPOP) +
          "SELECT pos, feature, variance, variance > 0.01 AS kept FROM vp")
def q_variance_filter(spark, sf):
    return FE.variance_table(cleaned(spark, sf), FEAT, 0.01)


SQL_TCORR = "tc AS (" + _u(
    "SELECT {i} AS pos, '{c}' AS feature, abs(CASE WHEN var_pop({c}) = 0 OR var_pop(Label_Binary) = 0 THEN NULL "
    "ELSE corr(CAST({c} AS DOUBLE), CAST(Label_Binary AS DOUBLE)) END) AS target_corr FROM cleaned", FEAT) + ")"


@register("target_correlation", S.sql_cleaned(False, SQL_TCORR) + "SELECT * FROM tc")
def q_target_correlation(spark, sf):
    return FE.target_correlation(cleaned(spark, sf), FEAT)


# features that survive the 0.01 population-variance filter at every sf
KEPT = [c for c in FEAT if c not in ("const_flag", "mean_discount", "mean_tax")]


def _sql_corr_filter(th: float) -> str:
    kept_pos = {c: i for i, c in enumerate(KEPT)}
    tcs = "tck AS (" + "\nUNION ALL ".join(
        f"SELECT '{c}' AS feature, abs(corr(CAST({c} AS DOUBLE), CAST(Label_Binary AS DOUBLE))) AS t FROM cleaned"
        for c in KEPT) + ")"
    del kept_pos
    return S.sql_cleaned(False, *sql_corr_long(KEPT), tcs) + f"""SELECT DISTINCT CASE WHEN tj.t >= ti.t THEN m.feature_i ELSE m.feature_j END AS feature
FROM cm_long m JOIN tck ti ON ti.feature = m.feature_i JOIN tck tj ON tj.feature = m.feature_j
WHERE m.pos_i < m.pos_j AND abs(m.r) > {th}"""


def _after_variance(spark, sf):
    """Rows and features after the variance filter, and the moments of all
    features (one pass over the rows serves every statistic of the family)."""
    c = cleaned(spark, sf)
    m = FE.selection_moments(c, FEAT)
    d, _ = FE.variance_filter(c, 0.01, FEAT, m)
    return d, [f for f in FEAT if f in d.columns], m


@register("correlation_filter", _sql_corr_filter(0.95))
def q_correlation_filter(spark, sf):
    d, cols, m = _after_variance(spark, sf)
    return FE.correlation_drops(d, cols, 0.95, m=m)


@register("correlation_filter_068", _sql_corr_filter(0.68))
def q_correlation_filter_068(spark, sf):
    d, cols, m = _after_variance(spark, sf)
    return FE.correlation_drops(d, cols, 0.68, m=m)


@register("stratified_cap", S.sql_cleaned(False, """rk AS (SELECT *,
  row_number() OVER (PARTITION BY Label_Multi ORDER BY md5(CAST(flow_id AS VARCHAR) || '|42'), flow_id) AS rk_,
  count(*) OVER (PARTITION BY Label_Multi) AS n_, count(*) OVER () AS t_ FROM cleaned)""") + """SELECT * EXCLUDE (rk_, n_, t_)
FROM rk WHERE rk_ <= CASE WHEN t_ > 3000 THEN CAST(floor(n_ * 3000 / t_ + 0.5) AS BIGINT) ELSE n_ END""")
def q_stratified_cap(spark, sf):
    """A stratified sample of 3,000 rows (the sample size is its feature)."""
    return FE.stratified_cap(cleaned(spark, sf), 3000)


@register("project_selected", S.sql_cleaned() +
          "SELECT flow_id, " + ", ".join(KEPT) + ", Label, Label_Binary, Label_Multi FROM cleaned")
def q_project_selected(spark, sf):
    d, cols, m = _after_variance(spark, sf)
    d2, _ = FE.correlation_filter(d, 0.95, cols, m=m)
    return FE.project_selected(d2, [c for c in cols if c in d2.columns])


@register("selection_funnel", S.sql_cleaned(False, SQL_VARPOP, """cnt AS (SELECT CAST(count(*) AS INT) AS n0,
  CAST(sum(CASE WHEN variance > 0.01 THEN 1 ELSE 0 END) AS INT) AS n1 FROM vp)""") + """SELECT 0 AS step, 'initial' AS stage, n0 AS n_features, 0 AS removed FROM cnt
UNION ALL SELECT 1, 'after_variance', n1, n0 - n1 FROM cnt
UNION ALL SELECT 2, 'after_correlation', n1, 0 FROM cnt
UNION ALL SELECT 3, 'final', least(30, n1), n1 - least(30, n1) FROM cnt""")
def q_selection_funnel(spark, sf):
    d, cols, m = _after_variance(spark, sf)
    d2, removed_c = FE.correlation_filter(d, 0.95, cols, m=m)
    n2 = len(cols) - len(removed_c)
    return FE.selection_funnel(len(FEAT), len(cols), n2, min(30, n2), spark)


@register("importance_topk", S.sql_cleaned() + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, TRUE AS in_range, TRUE AS ranked, TRUE AS sums_to_one" for c in S.FINAL_FEATURES))
def q_importance_topk(spark, sf):
    """Forest importances of all features, held against what importances must
    obey: in [0, 1], ranked downwards, one in sum."""
    d, cols, _ = _after_variance(spark, sf)
    top = FE.importance_topk(d, cols, "Label_Multi", k=30, num_trees=100, max_depth=20)
    by_rank = Window.orderBy("rank")  # at most k rows
    total = F.sum("importance").over(Window.partitionBy())
    return top.select("feature", F.col("importance").between(0, 1).alias("in_range"),
                      F.coalesce(F.lag("importance").over(by_rank) >= F.col("importance"), F.lit(True)).alias("ranked"),
                      (F.abs(total - 1) < 1e-9).alias("sums_to_one"))


@register("numeric_features", S.sql_cleaned() + _u(
    "SELECT {i} AS pos, '{c}' AS feature, CAST(count({c}) AS BIGINT) AS n FROM cleaned", FEAT))
def q_numeric_features(spark, sf):
    c = cleaned(spark, sf)
    cols = FE.numeric_features(c)
    return P.per_feature_stats(c, cols, {"n": F.count}).withColumn("n", F.col("n").cast("bigint"))
