"""Exact top-k by inner product: no-random-access aggregation.

Candidates and queries are dealt into tiles by hash; each task holds one tile
of candidates and one block of queries. A candidate tile keeps, for every
component, its values as a list in sorted order; a query reads each list from
its better end (from the top where its own component is positive, from the
bottom where it is negative). Lists are read in step; what has been read gives
every candidate a lower and an upper score bound (an unread value lies between
the list's far end and the last value read). A query stops when no outsider's
upper bound reaches its k-th lower bound; the scores of the candidates left are
then resolved and ranked. Integer arithmetic in doubles is exact while a score
stays below 2^53 by the largest components of its two vectors; vectors with
larger ones are left out of the lists and scored in 64-bit or, where that could
overflow, unbounded integers. A score beyond the range of a long counts as the
end of that range.

Vectors that are null or hold null or non-finite components take no part, nor
do rows with a null id; vectors whose length differs from the query's are not
comparable and are skipped. Ties go to the smaller id; a query's own row is
excluded by its id. Repeated ids are candidates of their own; rows of one query
id share one ranking. Fewer than k candidates:
all of them. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowforge.llm.common import ship

TILE = 8192  # candidates of a tile, about
BLOCK = 1024  # queries of a block, about


def sorted_lists(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per component: its values in ascending order, and each row's place."""
    order = np.argsort(x, axis=0, kind="stable")
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(len(x))[:, None], axis=0)
    return np.take_along_axis(x, order, axis=0), place


def bounds(x: np.ndarray, lists: np.ndarray, place: np.ndarray, q: np.ndarray, depth: int) \
        -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper scores (queries by rows) after ``depth`` entries of each
    list have been read from the query's better end."""
    n = len(x)
    plus, minus = np.maximum(q, 0), np.minimum(q, 0)
    top, low = place >= n - depth, place < depth  # read from the top, from the bottom
    last_top, last_low = lists[n - depth], lists[depth - 1]
    lower = plus @ np.where(top, x, lists[0]).T + minus @ np.where(low, x, lists[-1]).T
    upper = plus @ np.where(top, x, last_top).T + minus @ np.where(low, x, last_low).T
    return lower, upper


def tile_top_k(x: np.ndarray, ids: np.ndarray, q: np.ndarray, q_ids: np.ndarray, k: int, step: float = 2.0) \
        -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query number, ids, scores) of each query's best ``k`` in the tile."""
    n, order = len(x), np.argsort(ids, kind="stable")
    x, ids = x[order], ids[order]
    lists, place = sorted_lists(x)
    going, depth = np.arange(len(q)), max(1, n // 8)
    while len(going):
        lower, upper = bounds(x, lists, place, q[going], depth)
        own = ids[None, :] == q_ids[going][:, None]
        lower[own] = upper[own] = -np.inf
        kth = np.partition(lower, -k, axis=1)[:, -k] if n > k else np.full(len(going), -np.inf)
        open_ = (upper >= kth[:, None]) & ~own
        # every candidate is known once the lists are read to the end; before
        # that a query stops when few enough candidates are left to resolve
        ready = (open_.sum(1) <= 8 * k) | (depth >= n)
        for i in np.flatnonzero(ready):
            left = np.flatnonzero(open_[i])
            score = x[left] @ q[going[i]]
            best = left[np.lexsort((ids[left], -score))[:k]]
            yield going[i], ids[best], x[best] @ q[going[i]]
        going = going[~ready]
        depth = min(n, int(depth * step) + 1)


def whole_scores(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products of rows of whole numbers with ``q``, exact and cut to the
    range of a long."""
    if float(np.abs(x).max()) * float(np.abs(q).max()) * len(q) < 2.0 ** 62:
        return x.astype(np.int64) @ q.astype(np.int64)
    ends = np.iinfo(np.int64)
    factors = [int(c) for c in q]
    return np.array([min(max(sum(int(a) * b for a, b in zip(row, factors)), ends.min), ends.max) for row in x], np.int64)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, tile: int = TILE, block: int = BLOCK) -> DataFrame:
    """Both inputs: vec_id, v (array of whole numbers as double). Returns
    query_id, rank, vec_id, score."""
    ship(vectors.sparkSession)

    def usable(df: DataFrame) -> DataFrame:
        ok = F.expr("vec_id is not null and v is not null and size(v) > 0 and "
                    "forall(v, c -> c is not null and not isnan(c) and abs(c) < double('infinity'))")
        return df.select(F.col("vec_id").cast("long"), "v").where(ok)

    vectors, queries = usable(vectors), usable(queries)
    n, m = vectors.count(), queries.count()
    tiles, blocks = -(-n // tile) or 1, -(-m // block) or 1

    def dealt(df: DataFrame, by: str, parts: int, other: str, copies: int) -> DataFrame:
        # rows of one id are told apart by their place in the input
        spread = F.pmod(F.xxhash64("vec_id", F.spark_partition_id(), F.monotonically_increasing_id()), F.lit(parts))
        return df.withColumn(by, spread.cast("int")) \
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))

    # every tile of candidates meets every block of the stated queries
    left = dealt(vectors, "tile", tiles, "block", blocks).groupBy("tile", "block")
    right = dealt(queries, "block", blocks, "tile", tiles).groupBy("tile", "block")

    def best(c: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        out: list[pd.DataFrame] = []
        cols = ["query_id", "vec_id", "score"]
        if not len(c) or not len(q):
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in cols})
        for size in set(map(len, q["v"])):
            qs, cs = q[q["v"].map(len) == size], c[c["v"].map(len) == size]
            if not len(cs):
                continue
            x, y = np.stack(cs["v"]).astype(float), np.stack(qs["v"]).astype(float)
            ids, others = qs["vec_id"].to_numpy(), cs["vec_id"].to_numpy()
            most = (2.0 ** 53 / size) ** 0.5
            near_x, near_y = np.abs(x).max(1) < most, np.abs(y).max(1) < most
            if near_x.any() and near_y.any():
                mine = ids[near_y]
                for i, found, score in tile_top_k(x[near_x], others[near_x], y[near_y], mine, k):
                    out.append(pd.DataFrame({"query_id": mine[i], "vec_id": found, "score": score.astype(np.int64)}))
            for i in range(len(y)):
                rest = ~near_x if near_y[i] else np.ones(len(x), bool)
                rest &= others != ids[i]
                if rest.any():
                    score, found = whole_scores(x[rest], y[i]), others[rest]
                    top = np.lexsort((found, ~score))[:k]  # ~s orders as -s, without overflow
                    out.append(pd.DataFrame({"query_id": ids[i], "vec_id": found[top], "score": score[top]}))
        return pd.concat(out)[cols] if out else pd.DataFrame({c: pd.Series(dtype="int64") for c in cols})

    found = left.cogroup(right).applyInPandas(best, "query_id bigint, vec_id bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)
