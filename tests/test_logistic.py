"""The elastic net against what its optimum must obey, in few steps."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from flowforge.operators import models as M


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 4))
    x[:, 2] = x[:, 0] + 0.05 * x[:, 2]  # nearly the same feature twice
    y = (x @ rng.normal(size=(4, 3)) * 2 + rng.gumbel(size=(1500, 3))).argmax(1)
    y[y == 2] = 3  # code 2 has no rows
    w = rng.random(1500) + 0.5
    d = spark.createDataFrame([(i, *map(float, x[i]), int(y[i]), int(y[i] > 0), float(w[i])) for i in range(1500)],
                              "flow_id long, a double, b double, c double, d double, Label_Multi int, Label_Binary int, weight double")
    return x, y, w, VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="features").transform(d).cache()


@pytest.mark.parametrize("task, c, l1", [("multi", 100.0, 1.0), ("multi", 0.01, 1.0), ("multi", 1.0, 0.0), ("binary", 0.1, 0.5)])
def test_a_fit_is_the_optimum_and_takes_few_steps(spark, rows, task, c, l1):
    x, y, w, d = rows
    label = "Label_Multi" if task == "multi" else "Label_Binary"
    model = M.fit_model("LogisticRegression", task, d, label, [0, 1, 3], 1500, "weight",
                        {"C": c, "elasticNetParam": l1, "tol": 1e-7})
    assert model.steps <= 40
    p = model.probabilities(x)
    want = y if task == "multi" else (y > 0).astype(int)
    rest = p - np.eye(p.shape[1])[want]
    rest = rest[:, model.there][:, int(model.pivot):]
    g = (w[:, None] * rest).T @ np.concatenate([x, np.ones((1500, 1))], 1) / w.sum()
    b, reg = model.theta[:, :-1], 1 / (c * 1500)
    assert np.abs(g[:, -1]).max() < 1e-4  # intercepts are free
    slope = g[:, :-1] + reg * (1 - l1) * b
    assert np.abs(np.where(b != 0, slope + reg * l1 * np.sign(b), 0)).max() < 1e-4
    assert np.where(b == 0, np.abs(slope) - reg * l1, 0).max() < 1e-4
    if task == "multi":
        assert not p[:, 2].any() and (b == 0).any() == (l1 > 0)


def test_a_saved_model_scores_alike(spark, rows, tmp_path):
    d = rows[3]
    model = M.fit_model("LogisticRegression", "multi", d, "Label_Multi", [0, 1, 3], 1500, "weight", {"elasticNetParam": 1.0})
    M.save_model(model, str(tmp_path / "m"))
    back = M.load_model("LogisticRegression", "multi", str(tmp_path / "m"))
    got = [m.transform(d).select("flow_id", "prediction", vector_to_array("probability").alias("p")).orderBy("flow_id").collect()
           for m in (model, back)]
    assert got[0] == got[1] and all(abs(sum(r["p"]) - 1) < 1e-9 and r["p"][int(r["prediction"])] == max(r["p"]) for r in got[0])


def test_one_class_alone_is_certain(spark, rows):
    d = rows[3].where(F.col("Label_Multi") == 1)
    for task, label in (("multi", "Label_Multi"), ("binary", "Label_Binary")):
        m = M.fit_model("LogisticRegression", task, d, label, [0, 1], 100, None)
        assert {(r["prediction"]) for r in m.transform(d).select("prediction").collect()} == {1.0}
