"""Spark query vs DuckDB oracle on the smallest scale factor (the driver runs
every query at sf0.01; tools/oracle_check.py does the same locally)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tools.oracle_check import TABLES, rows_of

SF_SMALL = "/root/testdata/sf0.001"

SUBSET = ["read_flows", "inf_to_null", "drop_duplicate_rows", "cleaning_audit", "label_multi",
          "class_distribution", "describe_numeric", "correlation_matrix", "top_k_variance",
          "percentile_clip", "sample_rows", "dataset_summary", "variance_filter",
          "correlation_filter_068", "stratified_split", "fit_standard_scaler", "confusion_matrix",
          "weighted_prf", "classification_report", "roc_auc_binary", "roc_auc_ovr_weighted",
          "roc_curve", "metrics_row", "metrics_long", "build_alerts", "alert_feed",
          "top_class_probabilities", "linear_attribution", "local_explanations", "tuning_report",
          "read_flows_csv", "read_encoding_fallback", "source_inventory", "write_dataset", "export_csv",
          "stratified_cap", "split_xy", "task_class_weights", "model_store", "skip_bad_file", "score_partial_record"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_sql_query_is_registered():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", SUBSET)
def test_matches_oracle(spark, con, name):
    sp = E.queries()[name](spark, SF_SMALL).toPandas()
    dk = con.execute(E.oracle_sql()[name]).df()
    c1, r1 = rows_of(sp)
    c2, r2 = rows_of(dk)
    assert c1 == c2
    assert len(r1) == len(r2)
    assert r1 == r2


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 6
    assert {r["label"] for r in rows} >= {"BENIGN", "Bot", "DDoS"}
