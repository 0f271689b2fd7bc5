"""Cleaning: header normalisation, identity drop, inf -> null, null-row drop,
duplicate drop and the cleaning audit (SURVEY 2.2)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowforge.functions.expr import is_numeric

# Identity columns the cleaning step removes when present.
IDENTITY_COLUMNS = ["Flow ID", "Source IP", "Source Port", "Destination IP",
                    "Destination Port", "Timestamp"]


def dedupe_names(names: list[str]) -> list[str]:
    """Trim names, then make duplicates unique positionally: B, B.1, B.2 (T-2)."""
    seen: dict[str, int] = {}
    out = []
    taken = set()
    for raw in names:
        n = raw.strip()
        if n in seen or n in taken:
            k = seen.get(n, 0)
            cand = f"{n}.{k + 1}"
            while cand in taken:
                k += 1
                cand = f"{n}.{k + 1}"
            seen[n] = k + 1
            n = cand
        else:
            seen[n] = 0
        taken.add(n)
        out.append(n)
    return out


def normalize_columns(df: DataFrame) -> DataFrame:
    """Trim header whitespace; colliding names get ``.1``, ``.2`` suffixes."""
    return df.toDF(*dedupe_names(df.columns))


def drop_identity_columns(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Drop the listed non-generalisable columns that exist (absent ones ignored)."""
    cols = IDENTITY_COLUMNS if cols is None else cols
    return df.drop(*[c for c in cols if c in df.columns])


def inf_to_null(df: DataFrame) -> DataFrame:
    """+/-inf -> null in floating columns (integers cannot hold inf)."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.when(F.abs(c) == F.lit(float("inf")), F.lit(None).cast(f.dataType))
                       .otherwise(c).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def _row_is_complete(df: DataFrame, exclude: tuple[str, ...] = ()) -> F.Column:
    conds = []
    for f in df.schema.fields:
        if f.name in exclude:
            continue
        c = F.col(f"`{f.name}`")
        cond = c.isNotNull()
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cond = cond & ~F.isnan(c)
        conds.append(cond)
    return reduce(lambda a, b: a & b, conds) if conds else F.lit(True)


def drop_null_rows(df: DataFrame, exclude: tuple[str, ...] = ()) -> DataFrame:
    """Drop rows with any null or NaN (label included)."""
    return df.where(_row_is_complete(df, exclude))


def drop_duplicate_rows(df: DataFrame, key: str = "flow_id") -> DataFrame:
    """Full-row dedup over every column except our row key; the kept row takes
    the smallest key. A partial (map-side) aggregate collapses duplicates
    before the shuffle, so a hot duplicate group costs one row per task."""
    if key not in df.columns:
        return df.dropDuplicates()
    cols = [c for c in df.columns if c != key]
    agg = df.groupBy(*[F.col(f"`{c}`") for c in cols]).agg(F.min(key).alias(key))
    return agg.select(key, *[F.col(f"`{c}`") for c in cols])


def clean(df: DataFrame, key: str = "flow_id", identity: list[str] | None = None) -> DataFrame:
    d = normalize_columns(df)
    d = drop_identity_columns(d, identity)
    d = inf_to_null(d)
    d = drop_null_rows(d)
    return drop_duplicate_rows(d, key)


def cleaning_audit(df: DataFrame, key: str = "flow_id", identity: list[str] | None = None) -> DataFrame:
    """(step, stage, rows, dropped): original / null-dropped / dedup / final."""
    d = inf_to_null(drop_identity_columns(normalize_columns(df), identity))
    first = d.agg(F.count(F.lit(1)).alias("original"),
                  F.sum(F.when(_row_is_complete(d), 1).otherwise(0)).alias("after_null_drop"))
    final = drop_duplicate_rows(drop_null_rows(d), key).agg(
        F.count(F.lit(1)).alias("after_dedup"))
    long = (first.unpivot([], ["original", "after_null_drop"], "stage", "rows")
            .unionByName(final.unpivot([], ["after_dedup"], "stage", "rows")))
    step = (F.when(F.col("stage") == "original", 0)
            .when(F.col("stage") == "after_null_drop", 1).otherwise(2))
    w = Window.orderBy("step")  # three rows
    return (long.withColumn("step", step.cast("int"))
            .withColumn("rows", F.col("rows").cast("bigint"))
            .withColumn("dropped", F.coalesce(F.lag("rows").over(w) - F.col("rows"),
                                              F.lit(0)).cast("bigint"))
            .select("step", "stage", "rows", "dropped"))


def numeric_fields(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if is_numeric(f.dataType)]
