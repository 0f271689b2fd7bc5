"""One pass for all second moments of a table's numeric columns.

Each task sums its rows into a (columns x columns) matrix of counts, means and
centred cross products, cut into blocks of columns so that no message grows
with the square of a wide table. Blocks are merged pairwise (Chan's update:
no difference of large sums) in two levels, so the last task of a block reads
a bounded number of partial sums, however many tasks there are. Variances,
correlations with the target, pairwise correlations and scaling parameters are
all read from the result, which has a row per pair of columns.

A value that is null, NaN or infinite leaves its row out of the pairs of that
column only (pairwise complete), as SQL's ``corr`` and ``var_pop`` do.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowforge.functions.expr import bounded_lookup
from flowforge.session import ship_package

BLOCK = 32  # columns of a block
FAN_IN = 1024  # groups of partial sums in the first level of the merge
BATCH = 8192  # rows that are summed at once

_PARTIAL = "bi int, bj int, part int, n array<double>, a array<double>, b array<double>, c array<double>"


class Block:
    """Sums of column block i against column block j: rows with both values
    ``n``, mean of the first ``a`` and of the second ``b`` over those rows,
    centred cross products ``c``."""

    def __init__(self, n, a, b, c):
        self.n, self.a, self.b, self.c = n, a, b, c

    def merge(self, o: Block) -> None:
        n = self.n + o.n
        share = np.divide(o.n, n, out=np.zeros_like(n), where=n > 0)
        da, db = o.a - self.a, o.b - self.b
        # an empty side has mean 0: it must not pull
        da[(self.n == 0) | (o.n == 0)] = 0
        self.c = self.c + o.c + da * db * self.n * share
        self.a = np.where(self.n == 0, o.a, self.a + da * share)
        self.b = np.where(self.n == 0, o.b, self.b + db * share)
        self.n = n


def batch_blocks(x: np.ndarray, block: int = BLOCK) -> dict[tuple[int, int], Block]:
    """Blocks (i <= j) of one batch (rows x columns; NaN where a value is missing)."""
    there = np.isfinite(x)
    d = x.shape[1]
    first = np.array([x[there[:, c].argmax(), c] if there[:, c].any() else 0.0 for c in range(d)])
    # shifted by a value of the column: a constant column is exactly 0
    y = np.where(there, x - first, 0.0)
    count = there.sum(axis=0).astype(float)
    mean = np.divide(y.sum(axis=0), count, out=np.zeros(d), where=count > 0)
    y = np.where(there, y - mean, 0.0)
    whole = bool(there.all())
    w = there.astype(float)
    out = {}
    for i in range(0, d, block):
        for j in range(i, d, block):
            si, sj = slice(i, i + block), slice(j, j + block)
            c = y[:, si].T @ y[:, sj]
            base = np.zeros_like(c)
            if whole:
                n, da, db = base + len(x), base + y[:, si].sum(axis=0)[:, None], base + y[:, sj].sum(axis=0)[None, :]
            else:
                n, da, db = w[:, si].T @ w[:, sj], y[:, si].T @ w[:, sj], w[:, si].T @ y[:, sj]
            safe = np.maximum(n, 1)
            c = c - da * db / safe
            at = (first + mean)
            a = np.where(n > 0, at[si][:, None] + da / safe, 0.0)
            b = np.where(n > 0, at[sj][None, :] + db / safe, 0.0)
            out[i // block, j // block] = Block(n, a, b, c)
    return out


def _row(key: tuple[int, int], part: int, s: Block) -> tuple:
    return (*key, part, *[v.ravel().tolist() for v in (s.n, s.a, s.b, s.c)])


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["bi", "bj", "part", "n", "a", "b", "c"])


def _merged(pdf: pd.DataFrame) -> pd.DataFrame:
    """All partial sums of one block in a group of tasks, as one."""
    total, part = None, int(pdf["part"].iloc[0])
    for r in pdf.itertuples():
        s = Block(*[np.array(v, dtype=float) for v in (r.n, r.a, r.b, r.c)])
        if total is None:
            total = s
        else:
            total.merge(s)
    return _frame([_row((int(pdf["bi"].iloc[0]), int(pdf["bj"].iloc[0])), part, total)])


def moment_table(df: DataFrame, cols: list[str], block: int = BLOCK) -> DataFrame:
    """(pos_i, pos_j, feature_i, feature_j, n, mean_i, mean_j, c) for
    pos_i <= pos_j: rows in which both columns have a finite value, the means
    over them (0 if there are none) and the sum of centred products. One pass
    over ``cols`` of ``df``; no rows or no columns: no rows."""
    spark = df.sparkSession
    d = len(cols)
    if not d:
        return spark.createDataFrame([], "pos_i int, pos_j int, feature_i string, feature_j string, n long, "
                                         "mean_i double, mean_j double, c double")
    ship_package(spark)

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext
        total: dict[tuple[int, int], Block] = {}
        for pdf in batches:
            values = pdf.to_numpy(dtype=float)
            for at in range(0, len(values), BATCH):
                for key, s in batch_blocks(values[at:at + BATCH], block).items():
                    if key in total:
                        total[key].merge(s)
                    else:
                        total[key] = s
        part = TaskContext.get().partitionId() % FAN_IN
        for key, s in total.items():
            yield _frame([_row(key, part, s)])

    x = df.select(*[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    parts = x.mapInPandas(sums, _PARTIAL)
    level = parts.groupBy("bi", "bj", "part").applyInPandas(_merged, _PARTIAL)
    whole = level.groupBy("bi", "bj").applyInPandas(_merged, _PARTIAL)
    width = F.least(F.lit(block), F.lit(d) - F.col("bj") * block)
    cell = whole.select("bi", "bj", width.alias("w"), F.posexplode(F.arrays_zip("n", "a", "b", "c")).alias("at", "v"))
    cell = cell.select((F.col("bi") * block + F.floor(F.col("at") / F.col("w"))).cast("int").alias("pos_i"),
                       (F.col("bj") * block + F.col("at") % F.col("w")).cast("int").alias("pos_j"), "v.*")
    names = F.array(*[F.lit(c) for c in cols])
    return cell.where("pos_i <= pos_j").select(
        "pos_i", "pos_j", F.get(names, "pos_i").alias("feature_i"), F.get(names, "pos_j").alias("feature_j"),
        F.col("n").cast("long").alias("n"), F.col("a").alias("mean_i"), F.col("b").alias("mean_j"), "c")


def variances(m: DataFrame) -> DataFrame:
    """(pos, feature, n, mean, variance = population variance) of each column of
    the moment table; null without a value."""
    return m.where("pos_i = pos_j").select(
        F.col("pos_i").alias("pos"), F.col("feature_i").alias("feature"), "n",
        F.when(F.col("n") > 0, F.col("mean_i")).alias("mean"), F.try_divide("c", "n").alias("variance"))


def correlations(m: DataFrame) -> DataFrame:
    """(pos_i, pos_j, feature_i, feature_j, r) for pos_i <= pos_j: covariance
    over rows with both values by the product of the columns' own deviations;
    null beside a constant column (T-11) or without common rows."""
    own, out = variances(m), m
    for s in ("i", "j"):
        side = own.select(F.col("pos").alias(f"pos_{s}"), F.sqrt("variance").alias(f"_s{s}"))
        out = out.join(bounded_lookup(side), f"pos_{s}")
    r = F.try_divide(F.try_divide("c", "n"), F.col("_si") * F.col("_sj"))
    return out.select("pos_i", "pos_j", "feature_i", "feature_j", r.alias("r"))
