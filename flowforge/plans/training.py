"""Training-stage compositions: prepared splits, train-all, scoring."""

from __future__ import annotations

import uuid

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowforge.operators import labels as L
from flowforge.operators import models as M
from flowforge.operators import split as SP
from flowforge.plans import stages as S
from flowforge.session import checkpoint_dir, materialise


class Prepared:
    """Scaled, weighted, vectorised splits (``raw``: the unscaled ones) plus what
    scoring needs later."""

    def __init__(self, data: DataFrame, cols: list[str], scaler: dict, mapping: DataFrame,
                 classes: list[int], n_train: int, raw: DataFrame):
        self.data, self.cols, self.scaler, self.mapping = data, cols, scaler, mapping
        self.classes, self.n_train, self.raw = classes, n_train, raw

    def split(self, name: str) -> DataFrame:
        return self.data.where(F.col("split") == name)


def prepare(spark: SparkSession, sf_dir: str, persist: bool = True) -> Prepared:
    d, cols = S.split_dataset(spark, sf_dir)
    if persist:
        d = materialise(d, "split")
    train = d.where(F.col("split") == "train")
    scaler = SP.scaler_params(SP.fit_standard_scaler(train, cols))
    mapping = L.label_mapping(d.select("Label"))
    x = SP.apply_standard_scaler(d, scaler)
    x = SP.with_task_weights(x, train)
    x = VectorAssembler(inputCols=cols, outputCol="features").transform(
        x.select("flow_id", "split", "Label", "Label_Binary", "Label_Multi", "weight", "weight_binary",
                 *[F.col(c).cast("double").alias(c) for c in cols]))
    classes = sorted(r["code"] for r in mapping.select("code").collect())  # label-count bounded
    n_train = train.count()
    return Prepared(x, cols, scaler, mapping, classes, n_train, d)


def train_one(p: Prepared, name: str, task: str, params: dict | None = None):
    return M.train_and_evaluate(name, task, p.split("train"), p.split("test"), p.classes,
                                p.n_train, SP.weight_column(task), params)


def train_all(p: Prepared, names: list[str] | None = None, tasks=("binary", "multi"),
              params: dict | None = None):
    """Every (model, task): fitted models and the union of metric rows."""
    models, rows = {}, None
    for n in names or M.MODEL_NAMES:
        for t in tasks:
            m, r = train_one(p, n, t, (params or {}).get(n))
            models[(n, t)] = m
            r = materialise(r, "metrics")  # a few rows; keeps timings from being recomputed
            rows = r if rows is None else rows.unionByName(r)
    return models, rows


def model_path(spark: SparkSession, name: str) -> str:
    """Model store location under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/models/{name}-{uuid.uuid4().hex[:8]}"


SQL_TEST_ROWS = S.sql_split() + """SELECT flow_id, Label_Multi,
  (SELECT CAST(count(DISTINCT Label_Multi) AS INT) FROM cleaned) AS n_probabilities,
  TRUE AS sums_to_one, TRUE AS is_most_probable{more} FROM spl WHERE split = 'test'"""


def checked(out: DataFrame):
    """Per row: how many probabilities, do they sum to one, is the prediction
    the most probable class."""
    p = F.col("probability")
    return (F.size(p).alias("n_probabilities"),
            (F.abs(F.aggregate(p, F.lit(0.0), lambda s, x: s + x) - 1) < 1e-9).alias("sums_to_one"),
            (F.element_at(p, F.col("prediction") + 1) == F.array_max(p)).alias("is_most_probable"))
