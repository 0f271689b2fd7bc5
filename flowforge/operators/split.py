"""Split, class weights and scaling.

One table carries a ``split`` column instead of six positional files; every
later step filters on it (partition pruning once written ``partitionBy``).
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowforge.functions.expr import bounded_lookup, hash_order
from flowforge.functions.sequence import bucketed_marks, md5_bucket
from flowforge.operators.labels import BENIGN


def stratified_split(df: DataFrame, label_col: str = "Label_Multi", key: str = "flow_id",
                     seed: int = 42, train_pct: int = 70) -> DataFrame:
    """Exact 70/15/15 per class: rows ranked by md5(key|seed) inside their
    class; the first round(0.70 n_c) train, then half the rest (rounded
    down) val, the remainder test. Identical under any partitioning."""
    n = F.col("_n")
    n_train = F.floor((n * train_pct + 50) / 100)
    n_val = F.floor((n - n_train) / 2)
    split = (F.when(F.col("_rank") <= n_train, "train")
             .when(F.col("_rank") <= n_train + n_val, "val").otherwise("test"))
    d = df.withColumn("_h", hash_order(key, seed))
    return bucketed_marks(d, [label_col], ["_h", key], md5_bucket("_h"), split, "split").drop("_h")


def split_class_counts(df: DataFrame, binary_col: str = "Label_Binary") -> DataFrame:
    """rows, benign, attack per split."""
    b = F.col(binary_col)
    return df.groupBy("split").agg(
        F.count(F.lit(1)).cast("bigint").alias("rows"),
        F.sum(F.when(b == 0, 1).otherwise(0)).cast("bigint").alias("benign"),
        F.sum(F.when(b == 1, 1).otherwise(0)).cast("bigint").alias("attack"))


def balanced_class_weights(train: DataFrame, label_col: str = "Label_Multi") -> DataFrame:
    """(label, weight = n / (k * n_c)) — the 'balanced' rule."""
    c = train.groupBy(label_col).agg(F.count(F.lit(1)).alias("_nc"))
    w_all = Window.partitionBy()  # one row per class
    return c.select(F.col(label_col),
                    (F.sum("_nc").over(w_all).cast("double")
                     / (F.count(F.lit(1)).over(w_all) * F.col("_nc"))).alias("weight"))


def with_class_weights(df: DataFrame, weights: DataFrame, label_col: str = "Label_Multi",
                       out: str = "weight") -> DataFrame:
    return df.join(bounded_lookup(weights.withColumnRenamed("weight", out)), label_col, "left")


def with_task_weights(df: DataFrame, train: DataFrame) -> DataFrame:
    """``weight`` for the multi-class task and ``weight_binary`` for the binary
    one: each task's weights balance the labels it is fitted on."""
    d = with_class_weights(df, balanced_class_weights(train, "Label_Multi"), "Label_Multi", "weight")
    return with_class_weights(d, balanced_class_weights(train, "Label_Binary"), "Label_Binary", "weight_binary")


def weight_column(task: str) -> str:
    return "weight_binary" if task == "binary" else "weight"


def fit_standard_scaler(train: DataFrame, cols: list[str]) -> DataFrame:
    """(pos, feature, mean, scale): mean and population std in one pass;
    a zero std becomes 1 (sklearn). Spark ML's StandardScaler uses ddof=1,
    hence this parameter table."""
    aggs, structs = [], []
    for i, c in enumerate(cols):
        aggs += [F.avg(F.col(c)).alias(f"m{i}"), F.stddev_pop(F.col(c)).alias(f"s{i}")]
        structs.append(F.struct(F.lit(i).alias("pos"), F.lit(c).alias("feature"),
                                F.col(f"m{i}").cast("double").alias("mean"),
                                F.when(F.col(f"s{i}") == 0, F.lit(1.0))
                                .otherwise(F.col(f"s{i}")).cast("double").alias("scale")))
    one = train.agg(*aggs)
    return one.select(F.explode(F.array(*structs)).alias("_s")).select("_s.*")


def scaler_params(params: DataFrame) -> dict[str, tuple[float, float]]:
    """Bounded (one row per feature) parameters -> literals for the plan."""
    return {r["feature"]: (r["mean"], r["scale"]) for r in params.collect()}


def apply_standard_scaler(df: DataFrame, params: dict[str, tuple[float, float]]) -> DataFrame:
    """(x - mean) / scale as column expressions (codegen, no join)."""
    out = []
    for c in df.columns:
        if c in params:
            m, s = params[c]
            out.append(((F.col(c).cast("double") - F.lit(m)) / F.lit(s)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def binary_from_multi(df: DataFrame, mapping: DataFrame, multi_col: str = "Label_Multi",
                      out: str = "Label_Binary") -> DataFrame:
    """Label_Multi != code of BENIGN (looked up, not assumed 0 — T-7)."""
    codes = mapping.select(F.col("code").alias(multi_col),
                           (F.col("label") != F.lit(BENIGN)).cast("int").alias(out))
    return df.drop(out).join(bounded_lookup(codes), multi_col, "left")


def choose_training_set(original: DataFrame, resampled: DataFrame | None) -> DataFrame:
    """Resampled set if one exists, else the original train rows."""
    return resampled if resampled is not None else original


def split_xy(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    """Feature vector + label columns (binary, multi, text)."""
    keep = [c for c in ("flow_id", "split", "Label", "Label_Binary", "Label_Multi") if c in df.columns]
    return VectorAssembler(inputCols=cols, outputCol=out).transform(
        df.select(*keep, *[F.col(c).cast("double").alias(c) for c in cols])).select(*keep, out)
