"""Model bundles: everything scoring needs, in one versioned folder.

A bundle holds the fitted model, the features with their scaling parameters,
the label codes and a manifest (name, task, parameters, scores). The manifest
is written last, so a bundle without one is unfinished and never loaded.
Promotion appends one row to the store's ``promotions`` table: a single small
file that appears at once or not at all, after which readers take the new
bundle; earlier rows remain as the history. One writer promotes at a time.
All files lie in a folder that every node sees and are written by Spark.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowforge.operators import models as M
from flowforge.operators import score as SC

_MANIFEST = "name string, task string, version string, params string, scores string"
_PROMOTION = "number long, name string, path string, score double"


@dataclass
class Bundle:
    """A loaded bundle. ``score`` takes raw (unscaled) rows."""
    name: str
    task: str
    model: object
    features: list[str]
    scaler: dict[str, tuple[float, float]]
    mapping: DataFrame
    params: dict = field(default_factory=dict)
    scores: dict = field(default_factory=dict)

    def score(self, raw: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(scored rows, rows that cannot be scored), as ``score_flows``."""
        return SC.score_flows(raw, self.model, self.features, self.mapping, self.scaler)


def save_bundle(spark: SparkSession, store: str, b: Bundle) -> str:
    """Write ``b`` as a new version below ``store``; returns its path."""
    version = uuid.uuid4().hex
    path = f"{store.rstrip('/')}/{b.name}-{b.task}/{version}"
    M.save_model(b.model, f"{path}/model")
    scaling = [(i, f, *map(float, b.scaler.get(f, (0.0, 1.0)))) for i, f in enumerate(b.features)]
    spark.createDataFrame(scaling, "pos int, feature string, mean double, scale double").coalesce(1) \
        .write.parquet(f"{path}/features")
    b.mapping.select("code", "label").coalesce(1).write.parquet(f"{path}/mapping")
    manifest = (b.name, b.task, version, json.dumps(b.params), json.dumps(b.scores))
    spark.createDataFrame([manifest], _MANIFEST).coalesce(1).write.json(f"{path}/manifest")
    return path


def load_bundle(spark: SparkSession, path: str) -> Bundle:
    """The bundle at ``path``; ValueError if it was never finished."""
    try:
        row = spark.read.schema(_MANIFEST).json(f"{path}/manifest").first()
    except AnalysisException:
        row = None
    if row is None:
        raise ValueError(f"no finished bundle at {path}")
    scaling = spark.read.parquet(f"{path}/features").orderBy("pos").collect()  # a row per feature
    return Bundle(row["name"], row["task"], M.load_model(row["name"], row["task"], f"{path}/model"),
                  [r["feature"] for r in scaling], {r["feature"]: (r["mean"], r["scale"]) for r in scaling},
                  spark.read.parquet(f"{path}/mapping"), json.loads(row["params"]), json.loads(row["scores"]))


def promotions(spark: SparkSession, store: str) -> DataFrame:
    """(number, name, path, score): all promotions, oldest number first."""
    try:
        return spark.read.schema(_PROMOTION).json(f"{store.rstrip('/')}/promotions").orderBy("number")
    except AnalysisException:
        return spark.createDataFrame([], _PROMOTION)


def promote(spark: SparkSession, store: str, path: str, score: float) -> int:
    """Make the finished bundle at ``path`` the current one; returns its number."""
    b = load_bundle(spark, path)
    number = (promotions(spark, store).agg(F.max("number")).first()[0] or 0) + 1
    spark.createDataFrame([(number, b.name, path, float(score))], _PROMOTION).coalesce(1) \
        .write.mode("append").json(f"{store.rstrip('/')}/promotions")
    return number


def current(spark: SparkSession, store: str) -> Bundle | None:
    """The bundle promoted last; None before the first promotion."""
    last = Window.orderBy(F.col("number").desc())  # a row per promotion
    row = promotions(spark, store).withColumn("_r", F.row_number().over(last)).where("_r = 1").first()
    return None if row is None else load_bundle(spark, row["path"])
