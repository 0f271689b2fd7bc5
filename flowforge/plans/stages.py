"""Stage compositions over the fixture views: each returns a lazy DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowforge.operators import clean as C
from flowforge.operators import labels as L
from flowforge.plans import fixtures as FX
from flowforge.session import materialise


def cleaned(spark: SparkSession, sf_dir: str, raw: bool = False) -> DataFrame:
    """flows -> normalise -> drop identity -> inf->null -> drop nulls -> dedup
    (before the label trim, T-4) -> Label / Label_Binary / Label_Multi."""
    return L.encode_labels(_clean_rows(spark, sf_dir, raw), "Label")


def _clean_rows(spark: SparkSession, sf_dir: str, raw: bool = False) -> DataFrame:
    src = FX.flows_raw(spark, sf_dir) if raw else FX.flows(spark, sf_dir)
    return C.clean(src, key=FX.KEY, identity=FX.IDENTITY)


# ----------------------------------------------------------------- SQL twins
def _dbl(c: str) -> bool:
    return c not in ("n_items", "n_ret")


SQL_CLEAN_INF = "clean_inf AS (SELECT flow_id, " + ", ".join(
    (f"CASE WHEN abs({c}) = CAST('Infinity' AS DOUBLE) THEN NULL ELSE {c} END AS {c}" if _dbl(c) else c)
    for c in FX.FEATURES) + ", label FROM {src})"

SQL_CLEAN_NN = "clean_nn AS (SELECT * FROM clean_inf WHERE flow_id IS NOT NULL AND label IS NOT NULL AND " + " AND ".join(
    (f"{c} IS NOT NULL AND NOT isnan({c})" if _dbl(c) else f"{c} IS NOT NULL") for c in FX.FEATURES) + ")"

_COLS = ", ".join(FX.FEATURES + ["label"])
SQL_CLEAN_DD = f"clean_dd AS (SELECT min(flow_id) AS flow_id, {_COLS} FROM clean_nn GROUP BY {_COLS})"

SQL_CLEANED = ("cleaned AS (SELECT flow_id, " + ", ".join(FX.FEATURES) +
               ", trim(label) AS Label, CAST(CASE WHEN trim(label) <> 'BENIGN' THEN 1 ELSE 0 END AS INT) AS Label_Binary,"
               " CAST(dense_rank() OVER (ORDER BY trim(label)) - 1 AS INT) AS Label_Multi FROM clean_dd)")


def clean_ctes(raw: bool = False) -> list[str]:
    src = "flows_raw" if raw else "flows"
    return [SQL_CLEAN_INF.replace("{src}", src), SQL_CLEAN_NN, SQL_CLEAN_DD, SQL_CLEANED]


def sql_cleaned(raw: bool = False, *extra: str) -> str:
    return FX.with_views(["flows_raw" if raw else "flows"], *clean_ctes(raw), *extra)


def final_dataset(spark: SparkSession, sf_dir: str, k: int = 30, forest_rows: int = 300_000,
                  data: DataFrame | None = None) -> tuple[DataFrame, list[str]]:
    """cleaned (built and written once, before the label codes are read from it;
    ``data``: an already written one) -> variance
    filter (0.01) -> correlation filter (0.95) -> forest top-k -> projection.
    Of k features or fewer, the top k are all of them in their own order, so no
    forest is fitted; else it is fitted on a stratified sample of at most
    ``forest_rows`` rows, and the features keep their order too."""
    from flowforge.operators import features as FE
    c = data if data is not None else L.encode_labels(materialise(_clean_rows(spark, sf_dir), "cleaned"), "Label")
    cols = FE.numeric_features(c)
    m = FE.selection_moments(c, cols)
    d, _ = FE.variance_filter(c, 0.01, cols, m)
    cols = [x for x in cols if x in d.columns]
    d, _ = FE.correlation_filter(d, 0.95, cols, m=m)
    cols = [x for x in cols if x in d.columns]
    if len(cols) > k:
        top = FE.importance_topk(FE.stratified_cap(d, forest_rows), cols, "Label_Multi", k)
        best = {r["feature"] for r in top.collect()}
        cols = [c for c in cols if c in best]
    return FE.project_selected(d, cols), cols


def split_dataset(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    from flowforge.operators.split import stratified_split
    d, cols = final_dataset(spark, sf_dir)
    return stratified_split(d, "Label_Multi", FX.KEY, 42), cols


# features kept by the 0.01 variance filter at every sf (FIXTURES.md); no pair
# passes the 0.95 correlation filter, so these are the final features
FINAL_FEATURES = [c for c in FX.FEATURES if c not in ("const_flag", "mean_discount", "mean_tax")]
SQL_FINAL = ("final AS (SELECT flow_id, " + ", ".join(FINAL_FEATURES) +
             ", Label, Label_Binary, Label_Multi FROM cleaned)")
SQL_SPLIT = """spl AS (SELECT *, CASE WHEN rk <= floor((n * 70 + 50) / 100) THEN 'train'
    WHEN rk <= floor((n * 70 + 50) / 100) + floor((n - floor((n * 70 + 50) / 100)) / 2) THEN 'val' ELSE 'test' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY Label_Multi ORDER BY md5(CAST(flow_id AS VARCHAR) || '|42'), flow_id) AS rk,
    count(*) OVER (PARTITION BY Label_Multi) AS n FROM final) x)"""


def sql_split(*extra: str) -> str:
    return sql_cleaned(False, SQL_FINAL, SQL_SPLIT, *extra)
