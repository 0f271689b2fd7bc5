"""Registered queries: one per operator of SURVEY §2, each with its DuckDB
oracle SQL where the operator is SQL-expressible.

Every query reads the driver tables (through the fixture views) so its work
grows with them. Doubles are normalised to 11 significant digits in both
engines for the value-hash comparison.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowforge.functions.expr import round_doubles
from flowforge.operators import clean as C
from flowforge.operators import labels as L
from flowforge.plans import fixtures as FX
from flowforge.plans import stages as S

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return round_doubles(fn(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run
    return deco


NO_ID = ["flow_id"] + FX.FEATURES + ["label"]


# ============================================================ 2.1 / 2.2
@register("read_flows", FX.with_views(["flows"]) + "SELECT * FROM flows")
def q_read_flows(spark, sf):
    """Flow records (one per order) — the engine's flow source."""
    return FX.flows(spark, sf)


@register("normalize_columns", FX.with_views(["flows"]) + "SELECT * FROM flows")
def q_normalize_columns(spark, sf):
    return C.normalize_columns(FX.flows(spark, sf))


@register("drop_identity_columns",
          FX.with_views(["flows"]) + f"SELECT {', '.join(NO_ID)} FROM flows")
def q_drop_identity_columns(spark, sf):
    return C.drop_identity_columns(FX.flows(spark, sf), FX.IDENTITY)


@register("inf_to_null",
          FX.with_views(["flows"], S.SQL_CLEAN_INF.replace("{src}", "flows")) + "SELECT * FROM clean_inf")
def q_inf_to_null(spark, sf):
    return C.inf_to_null(C.drop_identity_columns(FX.flows(spark, sf), FX.IDENTITY))


@register("drop_null_rows",
          FX.with_views(["flows"], S.SQL_CLEAN_INF.replace("{src}", "flows"), S.SQL_CLEAN_NN)
          + "SELECT * FROM clean_nn")
def q_drop_null_rows(spark, sf):
    return C.drop_null_rows(C.inf_to_null(C.drop_identity_columns(FX.flows(spark, sf), FX.IDENTITY)))


_COLS = ", ".join(FX.FEATURES + ["label"])


@register("drop_duplicate_rows",
          FX.with_views(["flows_raw"]) +
          f"SELECT min(flow_id) AS flow_id, {_COLS} FROM flows_raw GROUP BY {_COLS}")
def q_drop_duplicate_rows(spark, sf):
    return C.drop_duplicate_rows(C.drop_identity_columns(FX.flows_raw(spark, sf), FX.IDENTITY))


@register("cleaning_audit", S.sql_cleaned(True) + """,
a AS (SELECT 0 AS step, 'original' AS stage, CAST(count(*) AS BIGINT) AS rows FROM clean_inf
      UNION ALL SELECT 1, 'after_null_drop', CAST(count(*) AS BIGINT) FROM clean_nn
      UNION ALL SELECT 2, 'after_dedup', CAST(count(*) AS BIGINT) FROM clean_dd)
SELECT CAST(step AS INT) AS step, stage, rows,
  CAST(coalesce(lag(rows) OVER (ORDER BY step) - rows, 0) AS BIGINT) AS dropped FROM a""")
def q_cleaning_audit(spark, sf):
    return C.cleaning_audit(FX.flows_raw(spark, sf), FX.KEY, FX.IDENTITY)


@register("resolve_label_column",
          FX.with_views(["flows"]) + f"SELECT flow_id, {', '.join(FX.FEATURES)}, label AS Label FROM flows")
def q_resolve_label_column(spark, sf):
    return L.resolve_label_column(C.drop_identity_columns(FX.flows(spark, sf), FX.IDENTITY), "Label")


@register("label_binary", S.sql_cleaned() + "SELECT flow_id, Label, Label_Binary FROM cleaned")
def q_label_binary(spark, sf):
    return S.cleaned(spark, sf).select("flow_id", "Label", "Label_Binary")


@register("label_multi", S.sql_cleaned() + "SELECT flow_id, Label, Label_Multi FROM cleaned")
def q_label_multi(spark, sf):
    return S.cleaned(spark, sf).select("flow_id", "Label", "Label_Multi")


@register("label_mapping", S.sql_cleaned() +
          "SELECT Label_Multi AS code, Label AS label, CAST(count(*) AS BIGINT) AS count FROM cleaned GROUP BY 1, 2")
def q_label_mapping(spark, sf):
    return L.label_mapping(S.cleaned(spark, sf).select("Label"), "Label")


@register("decode_label", FX.with_views(["preds"], """m AS (SELECT DISTINCT trim(label) AS label,
  CAST(dense_rank() OVER (ORDER BY trim(label)) - 1 AS INT) AS code FROM flows)""") +
          "SELECT p.flow_id, p.y_pred, m.label AS pred_label FROM preds p LEFT JOIN m ON p.y_pred = m.code")
def q_decode_label(spark, sf):
    mapping = L.label_mapping(FX.flows(spark, sf).select(F.trim("label").alias("Label")))
    return L.decode_label(FX.preds(spark, sf).select("flow_id", "y_pred"), mapping, "y_pred",
                          "pred_label")


@register("class_distribution", S.sql_cleaned() + """SELECT Label AS label, CAST(count(*) AS BIGINT) AS count,
  CAST(count(*) AS DOUBLE) * 100.0 / CAST(sum(count(*)) OVER () AS DOUBLE) AS pct FROM cleaned GROUP BY Label""")
def q_class_distribution(spark, sf):
    return L.class_distribution(S.cleaned(spark, sf))


@register("binary_distribution", S.sql_cleaned() + """SELECT Label_Binary AS label_binary,
  CASE WHEN Label_Binary = 0 THEN 'Benign' ELSE 'Attack' END AS name, CAST(count(*) AS BIGINT) AS count,
  CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE) AS share FROM cleaned GROUP BY Label_Binary""")
def q_binary_distribution(spark, sf):
    return L.binary_distribution(S.cleaned(spark, sf))


def oracle_rounded() -> dict[str, str]:
    """ORACLE with every double output column at 11 significant digits, matching
    the Spark side's ``round_doubles``. Column types come from
    ``oracle_doubles.json`` (written by tools/oracle_check.py --doubles)."""
    import json
    import os
    path = os.path.join(os.path.dirname(__file__), "oracle_doubles.json")
    doubles = json.load(open(path)) if os.path.exists(path) else {}
    out = {}
    for n, sql in ORACLE.items():
        cols = doubles.get(n, [])
        if cols:
            rep = ", ".join(f'CAST(printf(\'%.10e\', CAST("{c}" AS DOUBLE)) AS DOUBLE) AS "{c}"'
                            for c in cols)
            out[n] = f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) AS q"
        else:
            out[n] = sql
    return out


# registration side effects: each module adds its queries to QUERIES / ORACLE
from flowforge.plans import q_profile  # noqa: E402,F401
from flowforge.plans import q_eval  # noqa: E402,F401
from flowforge.plans import q_score  # noqa: E402,F401
from flowforge.plans import q_models  # noqa: E402,F401
from flowforge.plans import q_explain  # noqa: E402,F401
from flowforge.plans import q_stream  # noqa: E402,F401
from flowforge.plans import q_tune  # noqa: E402,F401
from flowforge.plans import q_resample  # noqa: E402,F401
from flowforge.plans import q_io  # noqa: E402,F401
