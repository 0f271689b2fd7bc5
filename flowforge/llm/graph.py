"""Connected components of a link table, without gathering links anywhere."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowforge.llm.common import stored

#: Links that a task contracts at once.
HELD = 1 << 20


def _contracted(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node of some links with its smallest node (label propagation with
    pointer jumping on arrays)."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        while True:
            jumped = new[new]
            if (jumped == new).all():
                break
            new = jumped
        if (new == label).all():
            return nodes, nodes[label]
        label = new


def components(links: DataFrame) -> DataFrame:
    """``links``: a, b (long, not null). Returns node, component (the smallest
    node reachable), one row per node of a link.

    Tasks first contract their own links to stars. Then large-star and
    small-star steps alternate until the links are stars on the smallest nodes:
    each step is a minimum by node (combined before the shuffle) and a join that
    Spark can split where a node has very many links."""
    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        size = 0

        def out() -> pa.RecordBatch:
            nodes, low = _contracted(*(np.concatenate([h[i] for h in held]) for i in (0, 1)))
            keep = nodes != low
            return pa.record_batch([pa.array(nodes[keep]), pa.array(low[keep])], names=["u", "v"])

        for batch in batches:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            size += batch.num_rows
            if size >= HELD:
                yield out()
                held, size = [], 0
        if size:
            yield out()

    def both(e: DataFrame) -> DataFrame:
        return e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))

    edges = stored(links.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b")
                   .mapInArrow(contract, "u bigint, v bigint").distinct(), "stars")
    mark = None
    while True:
        # u > v in every edge: v is the smaller node
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(now) == mark or not now[0]:
            break
        mark = tuple(now)
        sides = both(edges)
        low = sides.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = sides.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low2, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                                             F.col("m").alias("v")).where("u <> v")
        small = small.union(low2.select("u", F.col("m").alias("v")))
        edges = stored(small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "stars")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return roots.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
