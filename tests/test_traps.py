"""One test per semantic trap plus the CSV source."""

import math
import os

import pytest
from pyspark.sql import functions as F

from flowforge.operators import clean as C
from flowforge.operators import evaluate as EV
from flowforge.operators import features as FE
from flowforge.operators import labels as L
from flowforge.operators import split as SP
from flowforge.sources import flows_csv as SRC


def _write(path, text, encoding="utf-8"):
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)
    return path


def test_t1_infinity_spellings_are_numeric(spark, tmpdir_path):
    p = _write(os.path.join(tmpdir_path, "a.csv"),
               "x,Label\n1,BENIGN\nInfinity,BENIGN\n-Infinity,DDoS\ninf,DDoS\nNaN,BENIGN\n,BENIGN\n")
    df = SRC.read_flows(spark, [p])
    assert dict(df.dtypes)["x"] == "double"
    vals = [r["x"] for r in df.orderBy(F.monotonically_increasing_id()).collect()]
    assert vals[0] == 1.0 and vals[1] == math.inf and vals[2] == -math.inf and vals[3] == math.inf
    assert math.isnan(vals[4]) and vals[5] is None
    cleaned = C.drop_null_rows(C.inf_to_null(df))
    assert cleaned.count() == 1


def test_t2_padded_and_duplicate_headers(spark, tmpdir_path):
    p = _write(os.path.join(tmpdir_path, "h.csv"), " A,B, B, Label, B\n1,2,3,BENIGN,4\n")
    df = SRC.read_flows(spark, [p])
    assert df.columns == ["A", "B", "B.1", "Label", "B.2"]
    assert C.dedupe_names([" B", "B", "B.1"]) == ["B", "B.1", "B.1.1"]


def test_t3_latin1_fallback(spark, tmpdir_path):
    good = _write(os.path.join(tmpdir_path, "g.csv"), "x,Label\n1,BENIGN\n")
    bad = os.path.join(tmpdir_path, "l.csv")
    with open(bad, "wb") as f:
        f.write(b"x,Label\n2,Web Attack \x96 XSS\n")
    df = SRC.read_flows(spark, [good, bad])
    labels = sorted(r["Label"] for r in df.collect())
    assert labels == ["BENIGN", "Web Attack \x96 XSS"]  # Latin-1 keeps U+0096, as the reference


def test_skip_missing_file_and_error_when_none(spark, tmpdir_path):
    good = _write(os.path.join(tmpdir_path, "g.csv"), "x,Label\n1,BENIGN\n")
    missing = os.path.join(tmpdir_path, "nope.csv")
    assert SRC.read_flows(spark, [good, missing]).count() == 1
    with pytest.raises(FileNotFoundError):
        SRC.read_flows(spark, [missing])
    inv = {r["path"]: r for r in SRC.source_inventory(spark, [good, missing]).collect()}
    assert inv[good]["present"] and inv[good]["rows"] == 1
    assert not inv[missing]["present"]


def test_union_by_name_fills_missing_columns(spark, tmpdir_path):
    a = _write(os.path.join(tmpdir_path, "a.csv"), "x,y,Label\n1,2,BENIGN\n")
    b = _write(os.path.join(tmpdir_path, "b.csv"), "x,Label\n3,DDoS\n")
    df = SRC.read_flows(spark, [a, b])
    rows = {r["x"]: r["y"] for r in df.collect()}
    assert rows == {1: 2, 3: None}


def test_resolve_label_column(spark):
    df = spark.createDataFrame([(1, "BENIGN")], "x int, Attack_Label string")
    assert "Label" in L.resolve_label_column(df).columns
    with pytest.raises(ValueError):
        L.resolve_label_column(spark.createDataFrame([(1,)], "x int"))


def test_t4_dedup_before_label_trim(spark):
    df = spark.createDataFrame([(1, 1.0, "DDoS"), (2, 1.0, " DDoS"), (3, 1.0, "DDoS")],
                               "flow_id long, x double, Label string")
    d = C.drop_duplicate_rows(df)
    assert sorted(r["flow_id"] for r in d.collect()) == [1, 2]  # padded copy survives


def test_t6_binary_names_follow_values(spark):
    df = spark.createDataFrame([(1,)] * 5 + [(0,)] * 2, "Label_Binary int")
    names = {r["label_binary"]: r["name"] for r in L.binary_distribution(df).collect()}
    assert names == {0: "Benign", 1: "Attack"}


def test_t7_benign_code_is_looked_up(spark):
    mapping = spark.createDataFrame([(0, "Alpha", 1), (1, "BENIGN", 5)], "code int, label string, count long")
    df = spark.createDataFrame([(0,), (1,)], "Label_Multi int")
    out = {r["Label_Multi"]: r["Label_Binary"] for r in SP.binary_from_multi(df, mapping).collect()}
    assert out == {0: 1, 1: 0}


def test_t9_zero_auc_stays_zero(spark):
    p = spark.createDataFrame([("binary", 1, 1, 0.1), ("binary", 0, 0, 0.9)],
                              "task string, y_true int, y_pred int, score double")
    auc = EV.roc_auc_binary(p, group=["task"])
    assert auc.first()["roc_auc"] == 0.0
    s = EV.summary_metrics(p, group=["task"])
    row = EV.metrics_row(s, auc, None, ["task"]).first()
    assert row["roc_auc"] == 0.0


def test_t11_constant_column_correlation_is_null(spark):
    df = spark.createDataFrame([(1.0, 1.0, 0), (1.0, 2.0, 1), (1.0, 3.0, 1)], "c double, x double, Label_Binary int")
    tc = {r["feature"]: r["target_corr"] for r in FE.target_correlation(df, ["c", "x"]).collect()}
    assert tc["c"] is None and tc["x"] > 0.8


def test_label_multi_is_alphabetical(spark):
    df = spark.createDataFrame([("PortScan",), ("BENIGN",), ("Bot",), ("DDoS",)], "Label string")
    codes = {r["Label"]: r["Label_Multi"] for r in L.label_multi(df).collect()}
    assert codes == {"BENIGN": 0, "Bot": 1, "DDoS": 2, "PortScan": 3}


def test_validate_features_lists_missing(spark):
    from flowforge.operators import score as SC
    df = spark.createDataFrame([(1.0, 2.0)], "` a` double, b double")
    SC.validate_features(df, ["a", "b"])  # header padding is trimmed
    with pytest.raises(ValueError, match="Missing"):
        SC.validate_features(df, ["a", "b", "c"])


def test_match_columns_and_fallback(spark):
    from flowforge.operators import profile as P
    df = spark.createDataFrame([(1, 1.0, 2.0, 3.0)],
                               "flow_id long, `Flow Duration` double, `Total Fwd Packets` double, z double")
    assert P.match_columns(df) == ["Flow Duration", "Total Fwd Packets"]
    df2 = spark.createDataFrame([(1, 1.0, 2.0)], "flow_id long, p double, q double")
    assert P.match_columns(df2) == ["p", "q"]


def test_partial_records_use_defaults(spark):
    from flowforge.operators import score as SC
    defaults = spark.createDataFrame([(0, "a", 0.5), (1, "b", -1.0), (2, "c", 2.0)],
                                     "pos int, feature string, default double")
    recs = SC.partial_records(spark, [{"a": 3.0}, {"b": 7.0}], ["a", "b", "c"], defaults, n_given=2)
    rows = {r["rec_id"]: (r["a"], r["b"], r["c"]) for r in recs.collect()}
    assert rows == {0: (3.0, -1.0, 2.0), 1: (0.5, 7.0, 2.0)}
