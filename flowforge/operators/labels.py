"""Label resolution, encoding, decoding and class distributions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowforge.functions.expr import bounded_lookup

BENIGN = "BENIGN"


def resolve_label_column(df: DataFrame, target: str = "Label") -> DataFrame:
    """Keep ``target`` if present; else rename the first column whose
    lower-case name contains "label"; else raise."""
    if target in df.columns:
        return df
    cands = [c for c in df.columns if "label" in c.lower()]
    if not cands:
        raise ValueError(f"No '{target}' column found in dataset")
    return df.withColumnRenamed(cands[0], target)


def code_table(df: DataFrame, label_col: str = "Label", code_col: str = "Label_Multi") -> DataFrame:
    """(label, code, count): codes are the ascending sorted order of the
    distinct labels (0-based). The input is collapsed by a partial aggregate
    first, so the rank runs over one row per label, never over the data."""
    counts = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("count"))
    w = Window.orderBy(F.col(label_col).asc())
    return counts.select(label_col, (F.dense_rank().over(w) - 1).cast("int").alias(code_col),
                         F.col("count").cast("bigint").alias("count"))


def label_binary(df: DataFrame, label_col: str = "Label", out: str = "Label_Binary") -> DataFrame:
    """Trim the text label, then 0 if BENIGN else 1."""
    d = df.withColumn(label_col, F.trim(F.col(label_col).cast("string")))
    return d.withColumn(out, (F.col(label_col) != F.lit(BENIGN)).cast("int"))


def label_multi(df: DataFrame, label_col: str = "Label", out: str = "Label_Multi",
                mapping: DataFrame | None = None) -> DataFrame:
    """Sorted-order integer code. ``mapping`` (label, code) may be given (a
    fitted encoder); otherwise it is derived from ``df`` itself."""
    if mapping is None:
        m = code_table(df, label_col, out).select(label_col, out)
    else:  # persisted encoder: (code, label, count)
        m = mapping.select(F.col("label").alias(label_col), F.col("code").alias(out))
    return df.join(bounded_lookup(m), on=label_col, how="left")


def encode_labels(df: DataFrame, label_col: str = "Label") -> DataFrame:
    d = resolve_label_column(df, label_col)
    d = label_binary(d, label_col)
    return label_multi(d, label_col)


def label_mapping(df: DataFrame, label_col: str = "Label", code_col: str = "Label_Multi") -> DataFrame:
    """code -> class -> count (the persisted label encoder)."""
    return code_table(df, label_col, code_col).select(
        F.col(code_col).alias("code"), F.col(label_col).alias("label"), "count")


def decode_label(df: DataFrame, mapping: DataFrame, code_col: str, out: str = "label_name") -> DataFrame:
    """code -> class name through the (label-count-bounded) mapping table."""
    m = mapping.select(F.col("code").alias(code_col), F.col("label").alias(out))
    return df.join(bounded_lookup(m), on=code_col, how="left")


def class_distribution(df: DataFrame, label_col: str = "Label") -> DataFrame:
    """count and percent of total per label, count descending."""
    counts = df.groupBy(label_col).agg(F.count(F.lit(1)).cast("bigint").alias("count"))
    total = F.sum("count").over(Window.partitionBy())
    return counts.select(F.col(label_col).alias("label"), "count",
                         (F.col("count") * F.lit(100.0) / total).alias("pct"))


def binary_distribution(df: DataFrame, binary_col: str = "Label_Binary") -> DataFrame:
    """Benign vs attack count and share, named by value (never by count order)."""
    counts = df.groupBy(binary_col).agg(F.count(F.lit(1)).cast("bigint").alias("count"))
    total = F.sum("count").over(Window.partitionBy())
    return counts.select(
        F.col(binary_col).cast("int").alias("label_binary"),
        F.when(F.col(binary_col) == 0, "Benign").otherwise("Attack").alias("name"),
        "count", (F.col("count") / total).alias("share"))


def benign_code(mapping: DataFrame) -> int | None:
    """BENIGN's code, looked up (T-7: never assume 0); None without BENIGN."""
    row = mapping.where(F.col("label") == BENIGN).select("code").first()
    return row["code"] if row else None
