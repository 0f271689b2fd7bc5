"""Explainability.

* ``linear_attribution`` — closed form coef * (x - mean(background)).
* ``shapley_attribution`` — model-agnostic sampled Shapley values (re-aim of
  the reference's per-row tree explainer): every explained row x every order x
  (d + 1) hybrid rows is one Spark row, all scored by one ``model.transform``
  for every class at once; neighbouring hybrids differ in one feature, so the
  differences telescope to f(x) - f(background) exactly per order.
"""

from __future__ import annotations

import hashlib

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowforge.functions.expr import bounded_lookup
from flowforge.operators.profile import sample_rows
from flowforge.session import materialise

MOST_BACKGROUND = 10_000
BASE = -1


def explain_sample(test: DataFrame, n: int = 500, key: str = "flow_id", seed: int = 42) -> DataFrame:
    """min(n, rows) test rows without replacement, hash-ordered (seeded)."""
    return sample_rows(test, n, key, seed)


def background_means(rows: DataFrame, cols: list[str], n: int | None = None, key: str = "flow_id",
                     seed: int = 42) -> DataFrame:
    """(feature, mean) over all background rows, or over ``n`` hash-ordered ones."""
    bg = rows if n is None else sample_rows(rows, n, key, seed)
    one = bg.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in cols])
    return one.unpivot([], cols, "feature", "mean")


def to_long(rows: DataFrame, cols: list[str], key: str = "flow_id") -> DataFrame:
    return rows.unpivot([key], [F.col(c).cast("double").alias(c) for c in cols], "feature", "value")


def linear_attribution(rows: DataFrame, coef: DataFrame, bg_mean: DataFrame, key: str = "flow_id") -> DataFrame:
    """(key, class_id, feature, value, attribution = coef * (value - mean)).
    ``coef`` (class_id, feature, coef) and ``bg_mean`` are bounded by
    classes x features."""
    cols = [r["feature"] for r in coef.select("feature").distinct().collect()]
    long = to_long(rows, sorted(cols), key)
    return (long.join(coef, "feature").join(bg_mean, "feature")
            .select(key, "class_id", "feature", "value",
                    (F.col("coef") * (F.col("value") - F.col("mean"))).alias("attribution")))


def _orders(cols: list[str], first: int, n: int, seed: int) -> list[list[int]]:
    """Places of the features in each of ``n`` deterministic orders from the
    ``first`` on; every order is followed by its reverse (an antithetic pair)."""
    out = []
    for m in range(first, first + n):
        order = sorted(range(len(cols)), key=lambda i: hashlib.md5(f"{seed}|{m}|{cols[i]}".encode()).hexdigest())
        pos = [0] * len(cols)
        for p, i in enumerate(order):
            pos[i] = p
        out += [pos, [len(cols) - 1 - p for p in pos]]
    return out


def _pair_deltas(model, x: DataFrame, bg: DataFrame, n_bg: int, cols: list[str], classes: int, first: int,
                 n_pairs: int, key: str, seed: int) -> DataFrame:
    """(key, _p pair, _f place of the feature, d0 .. per class): what the
    feature adds to each class's score, mean of the two orders of the pair; the
    scores of the background row itself stand at place BASE.

    The hybrid of a row and its background row that takes the first k features
    of an order from the row adds its scores to the feature at place k - 1 and
    takes them from the one at place k; those signed terms are summed map-side
    (all hybrids of a row are made in one task)."""
    d = len(cols)
    orders = F.array(*[F.array(*[F.lit(v) for v in p]) for p in _orders(cols, first, n_pairs, seed)])
    start = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(n_bg))
    e = (x.withColumn("_p", F.explode(F.sequence(F.lit(first), F.lit(first + n_pairs - 1))))
         .withColumn("_b", F.pmod(start + F.col("_p"), F.lit(n_bg)))  # a pair shares a background row
         .join(bounded_lookup(bg, MOST_BACKGROUND), "_b"))
    e = (e.withColumn("_s", F.explode(F.array(F.lit(0), F.lit(1))))
         .withColumn("_at", F.element_at(orders, (F.col("_p") - first) * 2 + F.col("_s") + 1))
         .withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(d)))))
    hybrid = [F.when(F.element_at("_at", i + 1) < F.col("_k"), F.col(c)).otherwise(F.col(f"_bg_{c}")).alias(f"_h_{c}")
              for i, c in enumerate(cols)]
    scored = model.transform(VectorAssembler(inputCols=[f"_h_{c}" for c in cols], outputCol="features")
                             .transform(e.select(key, "_p", "_k", "_at", *hybrid)))
    def place(k) -> F.Column:
        return (F.nullif(F.array_position("_at", k), F.lit(0)) - 1).cast("int")

    signed = F.explode(F.filter(F.array(
        F.struct(place(F.col("_k") - 1).alias("f"), F.lit(0.5).alias("w")),
        F.struct(place(F.col("_k")).alias("f"), F.lit(-0.5).alias("w")),
        F.struct(F.when(F.col("_k") == 0, BASE).alias("f"), F.lit(0.5).alias("w"))),
        lambda t: t["f"].isNotNull()))
    t = scored.select(key, "_p", vector_to_array("probability").alias("_q"), signed.alias("_t"))
    return t.groupBy(key, "_p", F.col("_t.f").alias("_f")).agg(
        *[F.sum(F.col("_t.w") * F.element_at("_q", c + 1)).alias(f"d{c}") for c in range(classes)])


def shapley_attribution(model, rows: DataFrame, background: DataFrame, cols: list[str],
                        n_perm: int = 20, key: str = "flow_id", seed: int = 42,
                        tolerance: float | None = None, max_perm: int | None = None) -> DataFrame:
    """Sampled Shapley values of every class's probability for each explained
    row: (key, class_id, feature, value, attribution, std_error, base, score).
    The attributions of a row and class sum to score - base, where ``score`` is
    the model's on the row and ``base`` its mean on the background rows that
    were used.

    Orders come in antithetic pairs; ``std_error`` is that of the mean over
    pairs (null for one pair). With ``tolerance`` the number of orders doubles
    for the rows that still have a larger error, up to ``max_perm`` orders
    (default: 8 times ``n_perm``). ``background`` is a sample of at most
    MOST_BACKGROUND rows (more: ValueError) and is broadcast; work = rows x
    orders x (features + 1) scored hybrids, partitioned by key. Keys must be
    distinct and not null. No rows or an empty background: no attributions."""
    spark = rows.sparkSession
    d = len(cols)
    x = rows.select(key, *[F.col(c).cast("double").alias(c) for c in cols])
    held = background.select(*[F.col(c).cast("double").alias(f"_bg_{c}") for c in cols]).limit(MOST_BACKGROUND + 1).collect()
    if len(held) > MOST_BACKGROUND:
        raise ValueError(f"more than {MOST_BACKGROUND} background rows: take a sample")
    # in hash order: neighbours of a sorted sample are alike, and pairs take consecutive rows
    held = sorted((tuple(r) for r in held), key=lambda r: hashlib.md5(f"{seed}|{r}".encode()).hexdigest())
    bg = spark.createDataFrame([(i, *r) for i, r in enumerate(held)],
                               "_b long, " + ", ".join(f"`_bg_{c}` double" for c in cols))
    vec = VectorAssembler(inputCols=cols, outputCol="features")
    fx = model.transform(vec.transform(x)).select(key, vector_to_array("probability").alias("_fx"))
    some = fx.head()
    if some is None or not held:
        kinds = {"class_id": "int", "feature": "string", "value": "double", "attribution": "double",
                 "std_error": "double", "base": "double", "score": "double"}
        return rows.limit(0).select(key, *[F.lit(None).cast(t).alias(n) for n, t in kinds.items()])
    classes = len(some["_fx"])
    pairs, most = max(n_perm // 2, 1), max((max_perm or 8 * n_perm) // 2, 1)
    parts, first, todo = None, 0, x
    while True:
        new = materialise(_pair_deltas(model, todo, bg, len(held), cols, classes, first, pairs, key, seed), "shapley")
        parts = new if parts is None else parts.unionByName(new)
        first += pairs
        errors = [F.stddev_samp(f"d{c}") / F.sqrt(F.count(F.lit(1))) for c in range(classes)]
        att = parts.groupBy(key, "_f").agg(F.count(F.lit(1)).alias("_n"), *[
            F.struct(F.avg(f"d{c}").alias("a"), errors[c].alias("e")).alias(f"v{c}") for c in range(classes)])
        if tolerance is None or first >= most:
            break
        worst = F.greatest(F.lit(0.0), *[F.col(f"v{c}.e") for c in range(classes)])
        open_ = att.where((F.col("_f") != BASE) & ((worst > tolerance) | F.col("v0.e").isNull())).select(key).distinct()
        todo = materialise(x.join(open_, key, "left_semi"), "shapley-open")
        if todo.isEmpty():
            break
        pairs = min(first, most - first)
    names = F.array(*[F.lit(c) for c in cols])
    per_class = F.array(*[F.col(f"v{c}") for c in range(classes)])
    base = att.where(F.col("_f") == BASE).select(key, F.transform(per_class, lambda v: v["a"]).alias("_base"))
    own = x.join(fx, key).join(base, key).select(key, "_fx", "_base", F.array(*[F.col(c) for c in cols]).alias("_x"))
    long = att.where(F.col("_f") != BASE).select(key, "_f", F.posexplode(per_class).alias("class_id", "_v"))
    return long.join(own, key).select(
        key, "class_id", F.get(names, "_f").alias("feature"), F.get("_x", F.col("_f")).alias("value"),
        F.col("_v.a").alias("attribution"), F.col("_v.e").alias("std_error"),
        F.get("_base", F.col("class_id")).alias("base"), F.get("_fx", F.col("class_id")).alias("score"))


def global_importance(attr: DataFrame, top: int | None = None) -> DataFrame:
    """mean |attribution| over classes, then over rows: (feature, importance, rank)."""
    per_row = attr.groupBy("flow_id", "feature").agg(F.avg(F.abs("attribution")).alias("_a"))
    imp = per_row.groupBy("feature").agg(F.avg("_a").alias("importance"))
    w = Window.orderBy(F.col("importance").desc(), F.col("feature"))  # one row per feature
    r = imp.withColumn("rank", F.row_number().over(w))
    return r.where(F.col("rank") <= top) if top else r


def attribution_long(attr: DataFrame) -> DataFrame:
    """Beeswarm data (flow_id, feature, value, attribution); with several
    classes the attribution is the class-mean of |attribution|."""
    n_cls = attr.select("class_id").distinct().count()  # bounded by the label count
    if n_cls <= 1:
        return attr.select("flow_id", "feature", "value", "attribution")
    return attr.groupBy("flow_id", "feature", "value").agg(F.avg(F.abs("attribution")).alias("attribution"))


def dependence_pairs(attr: DataFrame, top_features: DataFrame, class_id: int = 0) -> DataFrame:
    """(feature, flow_id, value, attribution) for the top features; one class."""
    return (attr.where(F.col("class_id") == class_id)
            .join(top_features.select("feature"), "feature", "left_semi")
            .select("feature", "flow_id", "value", "attribution"))


def local_explanations(attr: DataFrame, preds: DataFrame, order: DataFrame, benign_code: int,
                       n_classes: int = 3, top: int = 10) -> DataFrame:
    """For up to ``n_classes`` attack classes (ascending code): the first
    correctly predicted row (in ``order``: key, ord) and its ``top``
    features by |attribution| for that class."""
    ok = (preds.where((F.col("y_true") == F.col("y_pred")) & (F.col("y_true") != benign_code))
          .join(order, "flow_id")
          .join(attr.select(F.col("class_id").alias("y_true")).distinct(), "y_true", "left_semi"))
    first = ok.withColumn("_r", F.row_number().over(Window.partitionBy("y_true").orderBy("ord", "flow_id"))) \
              .where(F.col("_r") == 1)
    first = first.withColumn("_c", F.dense_rank().over(Window.orderBy("y_true"))).where(F.col("_c") <= n_classes)
    rows = attr.join(first.select("flow_id", F.col("y_true").alias("class_id")), ["flow_id", "class_id"])
    w = Window.partitionBy("class_id").orderBy(F.abs("attribution").desc(), F.col("feature"))
    return (rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)
            .select("class_id", "flow_id", "rank", "feature", "value", "attribution"))
