"""Exact k-nearest neighbours inside each class, by boxes, pivots and the
triangle inequality; no stage compares all pairs of a class unless its geometry
forces it.

1. A sample of a class (one vector in a few hundred) is cut at the median of its
   widest feature again and again: the tree of these cuts deals all vectors to
   cells of some thousand, so a class of any size is many cells. A cell is cut on
   in the same way into blocks of at most BLOCK_ROWS, each with its bounding box.
2. Inside its block a vector finds k others: the k-th distance bounds its true
   one from above (the k-th nearest pivot does so too; up to PIVOTS vectors a
   class, a hash sample, are pivots).
3. A box farther from a vector than its bound holds none of its neighbours. So a
   block asks the cells, then the blocks in them, whose boxes lie near enough,
   and of those the ones whose rings (distances to the nearest pivot) meet the
   intervals that the triangle inequality leaves. All others are certified to
   hold no neighbour. Each comparison passes on at most k vectors of a row, so
   what is shuffled afterwards does not grow with the candidates.

Boxes shrink in every feature that carries spread as a class grows, and bounds
with them, so the number of compared vectors a row follows the intrinsic
dimension of the data far more than the size of the class (for many independent
features of one variance it is the class itself, where no exact method does better).
"""

from __future__ import annotations

import logging
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowforge.functions.expr import unit_hash
from flowforge.session import materialise, ship_package

log = logging.getLogger(__name__)

PIVOTS = 64
BLOCK_ROWS = 256
CELL_BLOCKS = 16  # blocks a cell holds, about
CELL_SAMPLE = 16  # sampled vectors that stand for a cell
TASK_PAIRS = 1024  # pairs of blocks a task compares, about
GROUP = 64  # neighbouring cells that are first looked at through one box
SLACK = 1e-9  # relative; far above rounding of a distance, far below any gap that matters


@contextmanager
def arrow_rows(spark: SparkSession, n: int):
    """At most ``n`` rows an Arrow batch while the body runs its jobs: rows here hold whole blocks."""
    conf = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(conf)
    spark.conf.set(conf, str(n))
    try:
        yield
    finally:
        spark.conf.set(conf, before)


def square_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` and ``b``, added feature by
    feature in their order (as the same sum in SQL)."""
    out = np.zeros((len(a), len(b)))
    for f in range(a.shape[1]):
        gap = a[:, f][:, None] - b[:, f][None, :]
        out += gap * gap
    return out


def upper_bounds(x: np.ndarray, need: np.ndarray, to_pivots: np.ndarray) -> np.ndarray:
    """Per row a distance within which ``need`` other vectors lie (infinity if
    neither the block nor the pivots hold so many)."""
    d = np.sqrt(square_distances(x, x))
    np.fill_diagonal(d, np.inf)
    far = np.where(to_pivots > 0, to_pivots, np.inf)  # a pivot does not count for itself
    best = np.full(len(x), np.inf)
    for others in (d, far):
        s = np.sort(others, axis=1)
        at = np.clip(need - 1, 0, s.shape[1] - 1)
        kth = np.where(need <= s.shape[1], s[np.arange(len(x)), at], np.inf)
        best = np.minimum(best, kth)
    return best


def intervals(need: np.ndarray, bound: np.ndarray, to_pivots: np.ndarray) -> list[tuple[int, float, float]]:
    """(cell, lowest, highest ring) in which some row of the block that needs
    neighbours may have one."""
    asks = need > 0
    if not asks.any():
        return []
    d, b = to_pivots[asks], bound[asks][:, None]
    b = b + SLACK * (b + d)
    near = (d - d.min(axis=1, keepdims=True)) / 2 <= b
    lo = np.where(near, d - b, np.inf).min(axis=0)
    hi = np.where(near, d + b, -np.inf).max(axis=0)
    return [(int(p), float(lo[p]), float(hi[p])) for p in np.flatnonzero(near.any(axis=0))]


def halves(x: np.ndarray) -> tuple[int, float] | None:
    """(feature, value): the widest feature, and where vectors below the value
    are about half of ``x`` and never all or none; None if all are equal."""
    with np.errstate(invalid="ignore"):
        spread = x.max(axis=0) - x.min(axis=0)
    spread = np.where(np.isfinite(spread), spread, 0.0)
    f = int(spread.argmax())
    if len(x) < 2 or spread[f] <= 0:
        return None
    v = x[:, f]
    value = np.partition(v, len(v) // 2)[len(v) // 2]
    if value == v.min():
        value = v[v > value].min()
    return f, float(value)


def cut_up(x: np.ndarray, most: int) -> list[np.ndarray]:
    """Places of ``x`` in parts of at most ``most`` vectors, in the order of the cuts."""
    todo, parts = [np.arange(len(x))], []
    while todo:
        at = todo.pop()
        cut = halves(x[at]) if len(at) > most else None
        if cut is None:
            parts += [at[i:i + most] for i in range(0, len(at), most)]
        else:
            low = x[at, cut[0]] < cut[1]
            todo += [at[~low], at[low]]
    return parts


def grown(x: np.ndarray, most: int) -> list[tuple[int, float, int, int]]:
    """A tree as a list of nodes (feature, value, place below, place above); a
    leaf has feature -1 and its number, in the order of the cuts."""
    nodes: list = [None]
    todo, leaves = [(0, np.arange(len(x)))], 0
    while todo:
        node, at = todo.pop()
        cut = halves(x[at]) if len(at) > most else None
        if cut is None:
            nodes[node] = (-1, 0.0, leaves, leaves)
            leaves += 1
            continue
        low = x[at, cut[0]] < cut[1]
        nodes[node] = (*cut, len(nodes), len(nodes) + 1)
        nodes += [None, None]
        todo += [(len(nodes) - 1, at[~low]), (len(nodes) - 2, at[low])]
    return nodes


def leaf_of(nodes: list[tuple[int, float, int, int]], x: np.ndarray) -> np.ndarray:
    leaf = np.zeros(len(x), dtype=np.int32)
    todo = [(0, np.arange(len(x)))]
    while todo:
        node, at = todo.pop()
        f, value, below, above = nodes[node]
        if f < 0:
            leaf[at] = below
        elif len(at):
            low = x[at, f] < value
            todo += [(above, at[~low]), (below, at[low])]
    return leaf


def box(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.fmin.reduce(x), np.fmax.reduce(x)


def box_gaps(lo: np.ndarray, hi: np.ndarray, los: np.ndarray, his: np.ndarray) -> np.ndarray:
    """Distances from the box (lo, hi), or the boxes paired with the others, to the boxes (los, his)."""
    gap = np.fmax(np.fmax(los - hi, lo - his), 0.0)
    return np.sqrt((gap * gap).sum(axis=-1))


def cells_near(x: np.ndarray, bound: np.ndarray, los: np.ndarray, his: np.ndarray) -> np.ndarray:
    """Places of the boxes in which some row of ``x`` may have a vector within
    its bound: groups of boxes first, then boxes by the rows' own box, then row
    by row."""
    if not len(x):
        return np.zeros(0, dtype=int)
    bound = bound * (1 + SLACK)
    (lo, hi), most = box(x), np.fmax.reduce(bound)
    first = np.arange(0, len(los), GROUP)
    near = box_gaps(lo, hi, np.minimum.reduceat(los, first), np.maximum.reduceat(his, first)) <= most
    at = np.flatnonzero(np.repeat(near, GROUP)[:len(los)])
    at = at[box_gaps(lo, hi, los[at], his[at]) <= most]
    kept = [at[i:i + GROUP] for i in range(0, len(at), GROUP)]
    kept = [c[(box_gaps(x[:, None], x[:, None], los[c], his[c]) <= bound[:, None]).any(axis=0)] for c in kept]
    return np.concatenate(kept) if kept else at


def _sampled(vec: DataFrame, cols: list[str], label: str) -> tuple[dict, dict]:
    """Per class its pivots and the tree of its cells, from hash samples."""
    sizes = vec.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    share = F.lit(CELL_SAMPLE / (CELL_BLOCKS * BLOCK_ROWS))
    some = vec.join(F.broadcast(sizes), label).withColumn("_h", unit_hash("_v", seed=7)) \
        .where(F.col("_h") < F.greatest(F.lit(4.0 * PIVOTS) / F.col("_nc"), share))
    first = Window.partitionBy(label).orderBy(F.xxhash64("_v"), "_v")
    chosen = some.withColumn("_i", F.row_number().over(first)) \
        .where((F.col("_i") <= PIVOTS) | (F.col("_h") < share))
    pivots: dict = {}
    stand: dict = {}
    # a sampled vector for a few hundred; bounds the trees, too
    for r in chosen.select(label, "_i", F.col("_h") < share, *cols).collect():
        c, i, counts = r[0], r[1], r[2]
        if i <= PIVOTS:
            pivots.setdefault(c, []).append(tuple(r)[3:])
        if counts:
            stand.setdefault(c, []).append(tuple(r)[3:])
    pivots = {c: np.array(sorted(v), dtype=float) for c, v in pivots.items()}
    trees = {c: grown(np.array(sorted(stand.get(c, [])), dtype=float).reshape(-1, len(cols)), CELL_SAMPLE) for c in pivots}
    return pivots, trees


def nearest(vec: DataFrame, cols: list[str], label: str, report: dict | None = None) -> DataFrame:
    """(_v, _before, _take, nb_v, dist): the nearest other vectors of the same
    class. ``vec`` holds distinct vectors with key ``_v``, copies ``_m`` and
    ``_need``, how many rows are asked for; neighbours come in order of (distance,
    key), each with its copies, until the need is met or the class ends.
    ``report`` receives the vectors compared per asking vector."""
    spark = vec.sparkSession
    ship_package(spark)
    pivots, trees = _sampled(vec, cols, label)
    kind = dict(vec.dtypes)
    d = len(cols)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for c, part in pdf.groupby(label, sort=False):
                yield part.assign(_leaf=leaf_of(trees[c], part[cols].to_numpy(dtype=float)))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in vec.schema.fields)
    # classes with no pivot have no vector (or a null label) and find nothing
    placed = vec.where(F.col(label).isin(list(pivots))).mapInPandas(place, f"{fields}, _leaf int")
    block = (f"_blk string, `{label}` {kind[label]}, _leaf int, n int, asks int, v array<{kind['_v']}>, m array<bigint>, "
             "need array<bigint>, x binary, bound array<double>, low array<double>, high array<double>, "
             "most double, wants binary, holds binary")

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        c, leaf = pdf[label].iloc[0], pdf["_leaf"].iloc[0]
        every, out = pdf[cols].to_numpy(dtype=float), []
        for i, at in enumerate(cut_up(every, BLOCK_ROWS)):
            x, need = every[at], pdf["_need"].to_numpy(dtype=int)[at]
            dp = np.sqrt(square_distances(x, pivots[c]))
            bound = upper_bounds(x, need, dp)
            # per pivot: rings in which a neighbour may lie; rings of the rows nearest to it
            wants = np.tile([[np.inf], [-np.inf]], len(pivots[c]))
            for p, lo, hi in intervals(need, bound, dp):
                wants[:, p] = lo, hi
            holds, near, ring = np.tile([[np.inf], [-np.inf]], len(pivots[c])), dp.argmin(axis=1), dp.min(axis=1)
            np.fmin.at(holds[0], near, ring)
            np.fmax.at(holds[1], near, ring)
            low, high = box(x)
            out.append({"_blk": f"{c}:{leaf}:{i}", label: c, "_leaf": leaf, "n": len(at), "asks": int((need > 0).sum()),
                        "v": pdf["_v"].to_numpy()[at].tolist(), "m": pdf["_m"].to_numpy()[at].tolist(), "need": need.tolist(),
                        "x": x.tobytes(), "bound": bound.tolist(), "low": low.tolist(),
                        "high": high.tolist(), "most": float(np.fmax.reduce(bound[need > 0], initial=0.0)),
                        "wants": wants.tobytes(), "holds": holds.tobytes()})
        return pd.DataFrame(out)

    blocks = materialise(placed.groupBy(label, "_leaf").applyInPandas(pack, block), "blocks")
    boxes: dict = {}  # one box a cell
    sides = [F.array(*[f(F.col(c)[i]) for i in range(d)]) for f, c in ((F.min, "low"), (F.max, "high"))]
    for c, leaf, lo, hi in blocks.groupBy(label, "_leaf").agg(*sides).orderBy(label, "_leaf").collect():
        boxes.setdefault(c, []).append((leaf, lo, hi))
    boxes = {c: tuple(np.array(side) for side in zip(*v, strict=True)) for c, v in boxes.items()}
    cells = spark.sparkContext.broadcast(boxes)

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                at = np.flatnonzero(np.asarray(r.need) > 0)
                leaves, los, his = cells.value[r.label]
                found = cells_near(np.frombuffer(r.x).reshape(-1, d)[at], np.asarray(r.bound)[at], los, his)
                yield pd.DataFrame({"_q": r.blk, "label": r.label, "_leaf": leaves[found].astype("int32")})

    light = [F.col(label).alias("label"), "_leaf"]
    with arrow_rows(spark, 256):
        asked = blocks.where("asks > 0").select(F.col("_blk").alias("blk"), F.col(label).alias("label"), "need", "x", "bound") \
            .mapInPandas(ask, f"_q string, label {kind[label]}, _leaf int")
        asked = materialise(asked, "asked")
    p_side = blocks.select(F.col("_blk").alias("_p"), *light, F.col("low").alias("plow"), F.col("high").alias("phigh"), "holds")
    q_side = blocks.select(F.col("_blk").alias("_q"), "low", "high", "most", "wants")

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for _, part in pdf.groupby("label", sort=False):
                lo, hi, plo, phi = (np.stack(part[c].to_numpy()) for c in ("low", "high", "plow", "phigh"))
                ok = box_gaps(lo, hi, plo, phi) <= part["most"].to_numpy() * (1 + SLACK)
                part = part[ok]
                wants, holds = (np.frombuffer(b"".join(part[c])).reshape(len(part), 2, -1) for c in ("wants", "holds"))
                ok = ((holds[:, 0] <= wants[:, 1]) & (holds[:, 1] >= wants[:, 0])).any(axis=1) if len(part) else []
                yield part.loc[ok, ["_q", "_p"]]

    with arrow_rows(spark, 2048):
        pairs = materialise(asked.join(q_side, "_q").join(p_side, ["label", "_leaf"])
                            .mapInPandas(meet, "_q string, _p string"), "pairs")
    q = blocks.select(F.col("_blk").alias("_q"), F.col("v").alias("qv"), F.col("need").alias("qneed"),
                      F.col("x").alias("qx"), F.col("bound").alias("qbound"))
    p = blocks.select(F.col("_blk").alias("_p"), F.col("v").alias("pv"), F.col("m").alias("pm"), F.col("x").alias("px"))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for r in pdf.itertuples():
                need, bound, pv = np.asarray(r.qneed), np.asarray(r.qbound) * (1 + SLACK), np.asarray(r.pv)
                x, p = np.frombuffer(r.qx).reshape(-1, d), np.frombuffer(r.px).reshape(-1, d)
                # rows of either side that the other's box leaves
                at = np.flatnonzero((need > 0) & (box_gaps(x, x, *box(p)) <= bound))
                if not len(at):
                    continue
                near = np.flatnonzero(box_gaps(p, p, *box(x[at])) <= np.fmax.reduce(bound[at]))
                d2 = square_distances(x[at], p[near])
                qv, pv, pm = np.asarray(r.qv)[at], pv[near], np.asarray(r.pm)[near]
                i, j = np.nonzero((np.sqrt(d2) <= bound[at][:, None]) & (qv[:, None] != pv[None, :]))
                order = np.lexsort((pv[j], d2[i, j], i))
                i, j = i[order], j[order]
                # the nearest of this block that can still be needed
                some = np.arange(len(i)) - np.searchsorted(i, i) < need[at][i]
                i, j = i[some], j[some]
                out.append((qv[i], pv[j], pm[j], d2[i, j], need[at][i]))
            if out:
                yield pd.DataFrame(dict(zip(["_v", "nb_v", "nb_m", "d2", "_need"], map(np.concatenate, zip(*out)), strict=True)))

    found_schema = f"_v {kind['_v']}, nb_v {kind['_v']}, nb_m bigint, d2 double, _need bigint"
    # pairs are small rows with much work each: their number, not their bytes, sets the tasks
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), pairs.count() // TASK_PAIRS)
    with arrow_rows(spark, 32):
        found = materialise(pairs.repartition(tasks, "_q", "_p").join(q, "_q").join(p, "_p").mapInPandas(compare, found_schema), "found")
    compared = pairs.join(blocks.select(F.col("_blk").alias("_q"), "asks"), "_q") \
        .join(blocks.select(F.col("_blk").alias("_p"), "n"), "_p") \
        .agg(F.sum(F.col("asks").cast("long") * F.col("n"))).first()[0] or 0
    asking = blocks.agg(F.sum("asks"), F.count(F.lit(1))).first()
    log.info("%d vectors ask, %d blocks, %d comparisons", asking[0] or 0, asking[1], compared)
    if report is not None:
        report.update(asking=asking[0] or 0, blocks=asking[1], candidates_per_row=compared / max(asking[0] or 0, 1))
    order = Window.partitionBy("_v").orderBy("d2", "nb_v")  # at most _need rows of each compared block
    before = F.coalesce(F.sum("nb_m").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    kept = found.withColumn("_before", before).where(F.col("_before") < F.col("_need"))
    return kept.select("_v", "_before", F.least(F.col("nb_m"), F.col("_need") - F.col("_before")).alias("_take"),
                       "nb_v", F.sqrt("d2").alias("dist"))
