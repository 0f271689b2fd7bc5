"""Mixing sources to target weights by systematic sampling.

Targets: the total budget is shared by weight; a source's target stops at
``max_repeat`` times its size and the excess is shared again among the others
(water-filling in closed form: sources by size per weight, running sums).
Sampling: each document of a source has the same expected number of copies
(target / size); a running sum of them over the source, plus one random offset,
emits a copy for every integer it passes. The order inside a source goes by
size class, then by a hash of doc_id, so that the words taken stay near the
target and documents far apart in the input are mixed.

A null text has size 0. A null source is a source of its own. Rows with equal
doc_id are separate documents; equal rows are interchangeable. A source without
words has target 0 and its documents are not taken. An empty table gives no
rows. The same input always gives the same mix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowforge.llm.common import WORD

#: Rows that one window task ranks, about.
RANKED = 20_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def size_class(size: Column) -> Column:
    """Eight classes per power of two (exact below 16)."""
    bits = F.length(F.bin(size)).cast("long")
    return F.when(size < 16, size).otherwise(
        bits * 8 + F.expr("shiftright(_size, cast(length(bin(_size)) - 4 as int)) & 7")).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, max_repeat: float) -> DataFrame:
    """``sizes``: _source, _source_size (one row per source; as many rows as
    there are sources). Weights repeat over the sources in code point order,
    null last."""
    by_name = Window.orderBy(F.col("_source").asc_nulls_last())
    numbered = sizes.withColumn("_i", F.row_number().over(by_name) - 1)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("_i") % len(weights) + 1).cast("int"))
    caps = numbered.withColumn("_w", w).withColumn("_cap", F.col("_source_size") * F.lit(float(max_repeat))) \
        .withColumn("_full_at", F.col("_cap") / F.col("_w"))
    total = F.sum("_source_size").over(Window.partitionBy()) * F.lit(float(share))
    order = Window.orderBy("_full_at", "_i")
    up_to = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(0, Window.unboundedFollowing)
    level = (total - F.coalesce(F.sum("_cap").over(up_to), F.lit(0.0))) / F.sum("_w").over(rest)
    # sources below the level are full; the first that is not fixes the level
    filled = caps.withColumn("_level", level).withColumn("_open", F.col("_level") <= F.col("_full_at"))
    final = F.min(F.when(F.col("_open"), F.struct("_full_at", "_i", "_level"))).over(Window.partitionBy())
    return filled.select("_source", "_source_size", F.when(
        final.isNull() | (F.struct("_full_at", "_i") < F.struct(final["_full_at"], final["_i"])), F.col("_cap"))
        .otherwise(final["_level"] * F.col("_w")).alias("_target"))


def mix_sources(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, max_repeat: float = 2.0,
                seed: str = "mix") -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken of every
    document. Only doc_id, source and the size pass the shuffles."""
    # the class of a size and the hash order are one bucket each; large
    # buckets are split by the hash, in as many parts as their rows need
    sized = docs.select("doc_id", F.col("source").alias("_source"), word_count(F.col("text")).alias("_size"))
    hashed = sized.withColumn("_class", size_class(F.col("_size"))).withColumn(
        "_h", F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))
    groups = hashed.groupBy("_source", "_class").agg(F.count(F.lit(1)).alias("_n"), F.sum("_size").alias("_words"))
    parts = groups.select("_source", "_class", F.ceil(F.col("_n") / RANKED).cast("long").alias("_parts"))
    part = F.floor(F.conv(F.substring("_h", 1, 8), 16, 10).cast("long") * F.col("_parts") / F.lit(float(1 << 32)))
    placed = hashed.alias("d").join(
        parts.alias("p"), F.expr("d._source <=> p._source and d._class = p._class")) \
        .select("d.*", part.cast("long").alias("_part"))
    counts = placed.groupBy("_source", "_class", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("_source").orderBy("_class", "_part")) - F.col("_n")
    sizes = groups.groupBy("_source").agg(F.sum("_words").alias("_source_size"))
    targets = source_targets(sizes, weights, share, max_repeat)
    # the random offset of a source: 32 bits of a hash of the seed and its name
    u = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.lit("offset"), F.coalesce(
        F.concat(F.lit("="), F.col("_source")), F.lit("null")))), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    steps = counts.withColumn("_before", before).alias("c").join(targets.alias("t"), F.expr("c._source <=> t._source")) \
        .select("c._source", "_class", "_part", "_before", "_source_size", "_target",
                F.when(F.col("_source_size") > 0, F.col("_target") / F.col("_source_size")).otherwise(0.0).alias("_each")).withColumn("_u", u)
    inner = Window.partitionBy("_source", "_class", "_part").orderBy("_h", "doc_id", "_size")
    ranked = placed.withColumn("_rank", F.row_number().over(inner)).alias("d").join(
        steps.alias("s"), F.expr("d._source <=> s._source and d._class = s._class and d._part = s._part")) \
        .select("d.doc_id", "d._source", "d._size", "s._source_size", "s._target", "s._each", "s._u",
                (F.col("_rank") + F.col("_before")).alias("_k"))
    copies = F.least(F.floor(F.col("_u") + F.col("_each") * F.col("_k"))
                     - F.floor(F.col("_u") + F.col("_each") * (F.col("_k") - 1)), F.lit(int(-(-max_repeat // 1))))
    return ranked.select("doc_id", F.col("_source").alias("source"), F.col("_size").alias("size"),
                         F.col("_source_size").cast("long").alias("source_size"), F.col("_target").alias("target"),
                         copies.cast("long").alias("copies"), (copies * F.col("_size")).cast("long").alias("taken"))


def emit_copies(docs: DataFrame, mix: DataFrame) -> DataFrame:
    """The mixed documents themselves: each row of ``docs`` once per copy. Rows
    are matched by doc_id, source and size, and by their place among equals."""
    key = "sha2(concat_ws(':', coalesce(cast(doc_id as string), '-'), {}, coalesce(concat('=', source), '-')), 256)"
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "source",
                      word_count(F.col("text")).alias("size"))
    nth = F.row_number().over(Window.partitionBy("key").orderBy("key"))
    a = own.select("row", F.expr(key.format("cast(size as string)")).alias("key")).withColumn("nth", nth)
    b = mix.select(F.expr(key.format("cast(size as string)")).alias("key"), "copies").withColumn("nth", nth)
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return a.join(b.where("copies > 0"), ["key", "nth"]).select("row", each.alias("_")).select("row.*")
