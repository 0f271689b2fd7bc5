"""Sharding by a hierarchical weighted hash tree (DataFrame functions only).

The shards are the leaves of a tree of regions and racks; a node weighs what
its shards weigh. A document descends from the root: every child of a node
draws ``ln(u) / weight`` with u in (0, 1) hashed from the child's name and the
document's key, and the largest draw wins, so that a child gets a share in
proportion to its weight. A child's draw depends on its own weight alone: when
weights change, keys move only into subtrees that became heavier or out of
those that became lighter, and below a node whose children kept their weights
nothing moves. A shard that comes as a subtree of its own therefore takes rows
only into itself; one put into a rack that exists also draws rows into the
other shards of that rack and region, whose weights grew with it.

The key alone decides: equal doc_ids meet in one shard, rows without doc_id
share the shard of the null key. A null text has no bytes. Equal rows are
interchangeable; each has its own slot. An empty table gives no rows. Other
columns of the input are not read, whatever their names. The same input gives
the same shards and slots on any partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowforge.llm.common import stored, text_or_empty

#: Rows that one window task numbers, about; equal rows are numbered together
#: in groups of at most CHUNK.
RANKED = 20_000
CHUNK = 10_000


class Shard(NamedTuple):
    """A leaf of the tree; racks and shards are numbered over the whole tree."""

    region: int
    rack: int
    shard: int
    weight: float = 1.0


def even_tree(shards: int, a_rack: int = 5, a_region: int = 4) -> list[Shard]:
    """Shards of equal weight, filled rack by rack and region by region."""
    return [Shard(s // (a_rack * a_region), s // a_rack, s) for s in range(shards)]


def _children(tree: Sequence[Shard], level: int) -> dict[tuple, dict[int, float]]:
    """The children of each node of a level with their weights."""
    out: dict[tuple, dict[int, float]] = {}
    for leaf in tree:
        if leaf.weight > 0:
            below = out.setdefault(tuple(leaf[:level]), {})
            below[leaf[level]] = below.get(leaf[level], 0.0) + float(leaf.weight)
    return out


def _draw(path: tuple, children: dict[int, float], key: Column, seed: str) -> Column:
    """The child with the largest draw (ties: the smallest number)."""
    if len(children) == 1:
        return F.lit(next(iter(children)))
    draws = []
    for child, weight in sorted(children.items()):
        name = F.concat(F.lit(":".join(map(str, (seed, *path, child))) + ":"), key)
        u = (F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("double") + 0.5) / float(1 << 32)
        draws.append(F.struct((F.ln(u) / F.lit(weight)).alias("draw"), F.lit(-child).alias("child")))
    return -F.greatest(*draws)["child"]


def place(docs: DataFrame, tree: Sequence[Shard], seed: str = "tree", name: str = "shard") -> DataFrame:
    """The documents with their shard in column ``name``: regions draw, then the
    racks of the region that won, then the shards of that rack. Each level is a
    projection of its own, so that only nodes on the way down draw, and each
    once. Nothing is shuffled."""
    free = (f"_{'_' * i}{name}" for i in range(len(docs.columns) + 4))
    taken = {c.lower() for c in docs.columns}
    key, region, rack = [c for c in free if c.lower() not in taken][:3]
    tops, racks, shards = (_children(tree, level) for level in range(3))

    def among(options: dict[int, Column], chosen: str) -> Column:
        out = F
        for number, column in sorted(options.items()):
            out = out.when(F.col(chosen) == number, column)
        return out

    step = docs.withColumn(key, F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    step = step.withColumn(region, _draw((), tops[()], F.col(key), seed))
    step = step.withColumn(rack, among({r: _draw((r,), racks[r,], F.col(key), seed) for r, in racks}, region))
    leaf = among({k: _draw((r, k), below, F.col(key), seed) for (r, k), below in shards.items()}, rack)
    return step.withColumn(name, leaf.cast("int")).drop(key, region, rack)


def number_shards(docs: DataFrame, tree: Sequence[Shard], grown: Sequence[Shard] | None = None,
                  seed: str = "tree") -> DataFrame:
    """doc_id, size (UTF-8 bytes and 16), text_crc32, law, shard, slot (from 0
    without gaps in each shard) and grown_shard (the shard under ``grown``).

    A shard is numbered in as many parts as its rows need, by ranges of a hash
    of the row; equal rows are counted before the shuffle and numbered in
    chunks, so neither a hot shard nor a hot row is one task's work."""
    text = text_or_empty()
    rows = docs.select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    equal = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("n"))
    chunks = equal.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / CHUNK)))) \
        .withColumn("n", F.least(F.lit(CHUNK), F.col("n") - F.col("chunk") * CHUNK))
    hashed = F.md5(F.concat_ws(":", F.lit(seed), F.lit("slot"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")),
                               "size", "text_crc32", "chunk"))
    placed = place(chunks.withColumn("h", hashed), tree, seed)
    both = place(placed, grown, seed, "grown_shard") if grown \
        else placed.withColumn("grown_shard", F.lit(None).cast("int"))
    kept = stored(both, "slots")
    parts = kept.groupBy("shard").agg(F.ceil(F.sum("n") / RANKED).alias("parts"))
    at = F.floor(F.conv(F.substring("h", 1, 8), 16, 10).cast("long") * F.col("parts") / F.lit(float(1 << 32)))
    parted = kept.join(parts, "shard").withColumn("part", at)
    sums = parted.groupBy("shard", "part").agg(F.sum("n").alias("inside"))
    before = F.sum("inside").over(Window.partitionBy("shard").orderBy("part")) - F.col("inside")
    offsets = sums.select("shard", "part", before.alias("before"))
    inner = Window.partitionBy("shard", "part").orderBy("h", "doc_id", "size", "text_crc32", "chunk") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = parted.withColumn("upto", F.sum("n").over(inner)).join(offsets, ["shard", "part"])
    first = F.col("before") + F.col("upto") - F.col("n")
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        F.explode(F.sequence(first, F.col("before") + F.col("upto") - 1)).alias("slot"), "grown_shard")


def write_shards(docs: DataFrame, path: str, tree: Sequence[Shard], seed: str = "tree", files: int = 1) -> None:
    """The documents as one folder of Parquet files a shard (``shard=<n>``),
    each shard in ``files`` tasks."""
    spread = F.pmod(F.xxhash64("doc_id", text_or_empty()), F.lit(files))
    placed = place(docs, tree, seed)
    placed.repartition(max(1, len(tree) * files), "shard", spread).write.partitionBy("shard").parquet(path)
