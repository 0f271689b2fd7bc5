"""Model training, prediction, persistence.

Single trees are Spark ML (distributed tree induction); boosted trees are
``operators.boosting`` (Spark's own are binary only), forests ``operators.forest``
(Spark's own pass over all rows for every few thousand nodes), logistic regression
``operators.logistic`` (Spark's own pass up to a thousand times, more under L1).
The train set is written once and reused by every fit.
"""

from __future__ import annotations

import time

from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowforge.operators import evaluate as EV
from flowforge.operators.boosting import BoostedModel, fit_boosted
from flowforge.operators.forest import ForestClassifier, ForestModel
from flowforge.operators.logistic import LogisticClassifier, LogisticModel
from flowforge.session import materialise

MODEL_NAMES = ["DecisionTree", "RandomForest", "BoostedTrees", "LogisticRegression"]
SPARK_MAX_DEPTH = 30  # Spark's hard cap; "unlimited" depth maps here


def make_estimator(name: str, task: str, n_train: int, label_col: str, weight_col: str | None,
                   seed: int = 42, params: dict | None = None):
    """Reference settings mapped to Spark ML."""
    p = dict(params or {})
    if name == "DecisionTree":
        return DecisionTreeClassifier(labelCol=label_col, featuresCol="features", seed=seed,
                                      maxDepth=min(p.pop("maxDepth", 20), SPARK_MAX_DEPTH),
                                      **({"weightCol": weight_col} if weight_col else {}), **p)
    if name == "RandomForest":
        return ForestClassifier(labelCol=label_col, featuresCol="features", seed=seed,
                                numTrees=p.pop("numTrees", 200),
                                maxDepth=min(p.pop("maxDepth", SPARK_MAX_DEPTH), SPARK_MAX_DEPTH),
                                featureSubsetStrategy=p.pop("featureSubsetStrategy", "sqrt"),
                                **({"weightCol": weight_col} if weight_col else {}), **p)
    if name == "BoostedTrees":
        return dict(maxIter=p.pop("maxIter", 200), stepSize=p.pop("stepSize", 0.1),
                    maxDepth=p.pop("maxDepth", 7), seed=seed, **p)
    if name == "LogisticRegression":
        C = p.pop("C", 1.0)
        return LogisticClassifier(labelCol=label_col, featuresCol="features",
                                  maxIter=p.pop("maxIter", 1000), regParam=1.0 / (C * max(n_train, 1)),
                                  tol=p.pop("tol", 1e-4),  # the reference estimator's default tolerance
                                  elasticNetParam=p.pop("elasticNetParam", 0.0),
                                  family="binomial" if task == "binary" else "multinomial",
                                  **({"weightCol": weight_col} if weight_col else {}), **p)
    raise ValueError(name)


def fit_model(name: str, task: str, train: DataFrame, label_col: str, classes: list[int],
              n_train: int, weight_col: str | None = "weight", params: dict | None = None):
    """Fit one (model, task). Boosted trees take no class weights."""
    est = make_estimator(name, task, n_train, label_col,
                         None if name == "BoostedTrees" else weight_col, params=params)
    if name == "BoostedTrees":
        own = {"maxIter": "rounds", "stepSize": "learning_rate", "maxDepth": "max_depth"}
        return fit_boosted(train, label_col, [0, 1] if task == "binary" else classes,
                           **{own.get(k, k): v for k, v in est.items()})
    return est.fit(train)


def predict_with_proba(model, df: DataFrame, key: str = "flow_id", label_col: str | None = None) -> DataFrame:
    """(key, [label], prediction, probability array)."""
    out = model.transform(df)
    cols = [key] + ([label_col] if label_col else [])
    return out.select(*cols, F.col("prediction").cast("int").alias("prediction"),
                      vector_to_array("probability").alias("probability"))


def evaluate_model(model, test: DataFrame, task: str, label_col: str, key: str = "flow_id") -> DataFrame:
    """Summary metrics + AUC (binary: score of class 1; multi: OvR weighted)."""
    p = materialise(predict_with_proba(model, test, key, label_col).withColumnRenamed(label_col, "y_true")
                    .withColumn("task", F.lit(task)), "predictions")  # scored once for all metrics
    summ = EV.summary_metrics(p, "y_true", "prediction", ["task"])
    if task == "binary":
        auc = EV.roc_auc_binary(p.withColumn("score", F.col("probability")[1]), "y_true", "score", ["task"])
    else:
        long = p.select("task", key, "y_true", F.posexplode("probability").alias("class_id", "p"))
        auc = EV.roc_auc_ovr_weighted(long, group=["task"])
    return summ.join(auc, "task", "left")


def train_and_evaluate(name: str, task: str, train: DataFrame, test: DataFrame, classes: list[int],
                       n_train: int, weight_col: str | None = "weight", params: dict | None = None):
    """Returns (model, metrics row DataFrame) with rounded metrics and
    training seconds."""
    label_col = "Label_Binary" if task == "binary" else "Label_Multi"
    t0 = time.time()
    model = fit_model(name, task, train, label_col, [0, 1] if task == "binary" else classes, n_train,
                      weight_col, params)
    secs = time.time() - t0
    m = evaluate_model(model, test, task, label_col)
    spark = train.sparkSession
    row = m.select(F.lit(name).alias("model_name"), "*")
    times = spark.createDataFrame([(name, task, float(secs))],
                                  "model_name string, task string, training_time_sec double")
    return model, EV.metrics_row(row.drop("roc_auc"), row.select("model_name", "task", "roc_auc"),
                                 times, ["model_name", "task"])


def save_model(model, path: str) -> None:
    if isinstance(model, BoostedModel | ForestModel | LogisticModel):
        model.save(path)
    else:
        model.write().overwrite().save(path)


_LOADERS = {"DecisionTree": DecisionTreeClassificationModel, "RandomForest": ForestModel,
            "BoostedTrees": BoostedModel, "LogisticRegression": LogisticModel}


def load_model(name: str, task: str, path: str):
    return _LOADERS[name].load(path)
