"""Logistic regression with an elastic net, by proximal Newton steps.

Each step is one job: tasks sum loss, gradient and Hessian over blocks of rows
(the sums have classes x features entries, squared for the Hessian, whatever the
rows), and the driver solves the penalised quadratic model of that size by active
sets. Some ten to thirty steps settle what first-order methods need up to a thousand passes for, above all under
an L1 penalty with little regularisation. Objective and parameters are Spark
ML's: mean weighted log loss plus ``regParam`` times the elastic net of the
coefficients (intercepts are free, features are taken as they are).
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowforge.session import materialise, ship_package

BLOCK_ROWS = 8192
SOLVES = 1000
HALVINGS = 30


def class_shares(x1: np.ndarray, theta: np.ndarray, pivot: bool) -> tuple[np.ndarray, np.ndarray]:
    """(log sum of exponentials, scores) of rows; with ``pivot`` the first
    class scores 0."""
    z = x1 @ theta.T
    if pivot:
        z = np.concatenate([np.zeros((len(z), 1)), z], 1)
    top = z.max(1, keepdims=True)
    return top[:, 0] + np.log(np.exp(z - top).sum(1)), z


def block_sums(x: np.ndarray, y: np.ndarray, w: np.ndarray, theta: np.ndarray, pivot: bool) -> list[np.ndarray]:
    """Loss, gradient and Hessian of some rows; ``y`` counts the classes that
    have rows."""
    x1 = np.concatenate([x, np.ones((len(x), 1))], 1)
    lse, z = class_shares(x1, theta, pivot)
    p = np.exp(z - lse[:, None])
    loss = (w * (lse - z[np.arange(len(y)), y])).sum()
    rest = p.copy()
    rest[np.arange(len(y)), y] -= 1.0
    p, rest = p[:, int(pivot):], rest[:, int(pivot):]
    n, d = theta.shape
    hessian = np.zeros((n, d, n, d))
    for a in range(n):
        for b in range(a, n):
            c = w * p[:, a] * ((a == b) - p[:, b])
            hessian[a, :, b] = x1.T @ (c[:, None] * x1)
            hessian[b, :, a] = hessian[a, :, b]
    return [np.array(loss), (w[:, None] * rest).T @ x1, hessian.reshape(n * d, n * d)]


def penalised_step(theta: np.ndarray, g: np.ndarray, h: np.ndarray, l1: np.ndarray) -> np.ndarray:
    """The step that minimises g s + s h s / 2 + l1 |theta + s|, by active sets:
    the exact minimum for the signs so far, or the best point on the way to it,
    until no entry that is 0 wants to leave it."""
    h = h + np.eye(len(g)) * 1e-10 * max(np.trace(h) / len(g), 1e-30)  # equal shifts of all intercepts are free
    if not l1.any():
        return -np.linalg.solve(h, g)
    c, u = g - h @ theta, theta.copy()
    sign = np.sign(u)
    value = lambda x: x @ (h @ x / 2 + c) + (l1 * np.abs(x)).sum()
    for _ in range(SOLVES):
        on = (sign != 0) | (l1 == 0)
        to = np.zeros(len(u))
        to[on] = -np.linalg.solve(h[np.ix_(on, on)], (c + l1 * sign)[on])
        turns = on & (l1 > 0) & (to * sign < 0)
        best = to
        if turns.any():
            points = []
            for share in np.unique(u[turns] / (u[turns] - to[turns])):
                x = u + share * (to - u)
                x[turns & (np.abs(x) <= 1e-12 * np.abs(to - u))] = 0.0
                points.append(x)
            best = min([to, *points], key=value)
        u = best
        sign = np.sign(u)
        if best is not to:
            continue
        wish = np.where((u == 0) & (l1 > 0), np.abs(h @ u + c) - l1 * (1 + 1e-6), -1.0)
        if wish.max() <= 0:
            break
        j = int(wish.argmax())
        sign[j] = -np.sign((h[j] @ u + c[j]))
    return u - theta


class LogisticClassifier:
    """Settings by the names of Spark ML's LogisticRegression. ``tol``: steps end
    when the next one promises less than ``tol`` / 1000 of the objective."""

    def __init__(self, labelCol: str, featuresCol: str = "features", maxIter: int = 1000, regParam: float = 0.0,
                 tol: float = 1e-4, elasticNetParam: float = 0.0, family: str = "multinomial",
                 weightCol: str | None = None):
        if family not in ("binomial", "multinomial") or regParam < 0 or not 0 <= elasticNetParam <= 1:
            raise ValueError("family must be binomial or multinomial, regParam >= 0, elasticNetParam 0 to 1")
        self.label, self.features, self.weight, self.family = labelCol, featuresCol, weightCol, family
        self.steps, self.reg, self.tol, self.l1_share = maxIter, regParam, tol, elasticNetParam

    def fit(self, train: DataFrame) -> LogisticModel:
        ship_package(train.sparkSession)
        weight = F.col(self.weight).cast("double") if self.weight else F.lit(1.0)
        sizes = train.groupBy(F.col(self.label).cast("int").alias("y")) \
            .agg(F.sum(weight).alias("w"), F.max(F.size(vector_to_array(self.features))).alias("d")).collect()  # a row per class
        if not sizes:
            raise ValueError("no rows to train on")
        classes, d = max(2, 1 + max(r["y"] for r in sizes)), sizes[0]["d"]
        if self.family == "binomial" and classes > 2:
            raise ValueError("a binomial fit needs labels 0 and 1")
        there = np.array(sorted(r["y"] for r in sizes if r["w"] > 0))
        total = sum(r["w"] for r in sizes)
        pivot = self.family == "binomial"
        theta = np.zeros((len(there) - pivot, d + 1))
        if not theta.size or len(there) == 1:
            return LogisticModel(np.zeros((1, d + 1)), there[:1], False, classes, 0, self.features)
        blocks = _blocks(train, self.label, self.features, weight, there, d).persist(StorageLevel.MEMORY_AND_DISK)
        free = np.zeros(theta.shape, bool)
        free[:, -1] = True
        l1 = np.where(free, 0.0, self.reg * self.l1_share).ravel()
        l2 = np.where(free, 0.0, self.reg * (1 - self.l1_share)).ravel()

        def sums(at: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
            """Objective without L1, its gradient and Hessian."""
            shape = theta.shape

            def add(it: Iterator) -> Iterator[list]:
                out = None
                for x, y, w in it:
                    new = block_sums(x, y, w, at.reshape(shape), pivot)
                    out = new if out is None else [a + b for a, b in zip(out, new)]
                if out is not None:
                    yield out

            loss, g, h = blocks.mapPartitions(add).treeReduce(lambda a, b: [x + y for x, y in zip(a, b)], 2)
            return (float(loss / total + (l2 * at * at).sum() / 2), g.ravel() / total + l2 * at, h / total + np.diag(l2))

        at, steps = theta.ravel(), 0
        now = sums(at)
        for steps in range(1, self.steps + 1):
            value, g, h = now
            step = penalised_step(at, g, h, l1)
            penalty = (l1 * np.abs(at)).sum()
            promised = g @ step + (l1 * np.abs(at + step)).sum() - penalty
            if promised >= -self.tol * 1e-3 * max(value + penalty, 1e-12):
                break
            size = 1.0
            for _ in range(HALVINGS):
                new = at + size * step
                now = sums(new)
                if now[0] + (l1 * np.abs(new)).sum() <= value + penalty + 1e-4 * size * promised:
                    break
                size /= 2
            else:
                break  # no smaller objective along the step: rounding
            at = new
        blocks.unpersist()
        return LogisticModel(at.reshape(theta.shape), there, pivot, classes, steps, self.features)


def _blocks(train: DataFrame, label_col: str, features_col: str, weight: F.Column, there: np.ndarray, d: int) -> RDD:
    """Blocks (features, place of the label in ``there``, weights) of rows with
    a weight, written once."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, d).astype(float)
            y, w = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            y = np.searchsorted(there, y).astype(np.int32)
            for a in range(0, len(x), BLOCK_ROWS):
                parts = [c[a:a + BLOCK_ROWS] for c in (x, y, w.astype(float))]
                yield pa.record_batch([pa.array([np.ascontiguousarray(c).tobytes()], pa.binary()) for c in parts],
                                      names=["x", "y", "w"])

    rows = train.select(vector_to_array(features_col).alias("x"), F.col(label_col).cast("int").alias("y"), weight.alias("w"))
    table = materialise(rows.where("w > 0").mapInArrow(pack, "x binary, y binary, w binary"), "logistic-blocks")
    return table.rdd.map(lambda r: (np.frombuffer(r.x).reshape(-1, d), np.frombuffer(r.y, np.int32), np.frombuffer(r.w)))


class LogisticModel(Model):
    """Coefficients with intercepts (last column), a row per class of ``there``
    (but the first of a binomial fit); ``probability`` has one value per class
    code, ``prediction`` is the most probable class, the lowest among equals."""

    def __init__(self, theta: np.ndarray, there: np.ndarray, pivot: bool, classes: int, steps: int,
                 features_col: str = "features"):
        super().__init__()
        self.theta, self.there, self.pivot, self.classes = theta, there, pivot, classes
        self.steps, self.features_col = steps, features_col

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        lse, z = class_shares(np.concatenate([x, np.ones((len(x), 1))], 1), self.theta, self.pivot)
        out = np.zeros((len(x), self.classes))
        out[:, self.there] = np.exp(z - lse[:, None])
        return out

    def _transform(self, df: DataFrame) -> DataFrame:
        ship_package(df.sparkSession)
        model = (self.theta, self.there, self.pivot, self.classes, self.steps)

        @F.pandas_udf("array<double>")
        def score(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=object)
            return pd.Series(list(LogisticModel(*model).probabilities(np.stack(x.to_numpy()))))

        scored = df.withColumn("probability", score(vector_to_array(self.features_col)))
        best = F.array_position("probability", F.array_max("probability")) - 1
        return scored.withColumn("prediction", best.cast("double")) \
            .withColumn("probability", array_to_vector("probability"))

    def save(self, path: str) -> None:
        from pyspark.sql import SparkSession
        meta = {"theta": self.theta.tolist(), "there": self.there.tolist(), "pivot": bool(self.pivot),
                "classes": self.classes, "steps": self.steps, "features_col": self.features_col}
        SparkSession.getActiveSession().createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1) \
            .write.mode("overwrite").json(path)

    @classmethod
    def load(cls, path: str) -> LogisticModel:
        from pyspark.sql import SparkSession
        meta = json.loads(SparkSession.getActiveSession().read.json(path).first()["meta"])
        return cls(np.array(meta.pop("theta")), np.array(meta.pop("there")), **meta)
