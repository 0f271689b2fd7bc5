"""Exact ranks and global numbering without a single-partition sort.

A plain ``row_number() over (partition by c order by k)`` sorts a whole group
in one task; with one class holding a third of 100 TB that task never ends.
Instead rows are bucketed by a prefix of the ordering key (the bucket order
agrees with the key order), bucket sizes are counted (a tiny table: groups ×
buckets), a running offset is computed over that tiny table, and each row's
rank is its rank inside its (group, bucket) plus the offset. Same answer as
the single window, spread over groups × buckets tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowforge.functions.expr import bounded_lookup
from flowforge.session import materialise

#: Rows of a table of buckets that are broadcast.
MOST_BUCKETS = 50_000


def bucket_offsets(d: DataFrame, part_cols: list[str], size_col: str = "_n", desc: bool = False) -> DataFrame:
    """Per group and bucket (``_bk``): rows of it (``_nb``), rows of the group
    before it (``_off``) and in all."""
    counts = d.groupBy(*part_cols, "_bk").agg(F.count(F.lit(1)).alias("_nb"))
    border = F.col("_bk").desc() if desc else F.col("_bk").asc()
    w_run = (Window.partitionBy(*part_cols).orderBy(border)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    w_all = Window.partitionBy(*part_cols)
    return counts.select(
        *part_cols, "_bk", "_nb",
        (F.sum("_nb").over(w_run) - F.col("_nb")).alias("_off"),
        F.sum("_nb").over(w_all).alias(size_col))


def bucketed_rank(df: DataFrame, part_cols: list[str], order_cols: list[str],
                  bucket: Column, rank_col: str = "_rank", size_col: str = "_n",
                  desc: bool = False, max_rank: int | Column | None = None) -> DataFrame:
    """Add ``rank_col`` (1-based row_number inside ``part_cols`` by
    ``order_cols``) and ``size_col`` (group size).

    ``bucket`` must be monotone in ``order_cols`` (non-decreasing when
    ``desc`` is False): e.g. the first hex digits of an md5 order key, or
    ``floor(p * 4096)`` for a probability. With ``max_rank`` (a number, or an
    expression over the group and ``size_col``) only rows whose rank can be <=
    max_rank are kept: later buckets are pruned before the window and before any
    shuffle, so a top-n never moves or sorts the rest."""
    d = df.withColumn("_bk", bucket)
    offsets = bucket_offsets(d, part_cols, size_col, desc).drop("_nb")
    if max_rank is not None:
        offsets = bounded_lookup(offsets.where(F.col("_off") < (max_rank if isinstance(max_rank, Column) else F.lit(max_rank))),
                                 MOST_BUCKETS)
    # offsets is groups x buckets rows; AQE broadcasts it when its measured
    # size is under the threshold and keeps a shuffle join otherwise.
    joined = d.join(offsets, on=[*part_cols, "_bk"], how="inner")
    okeys = [F.col(c).desc() if desc else F.col(c).asc() for c in order_cols]
    w_in = Window.partitionBy(*part_cols, "_bk").orderBy(*okeys)
    return (joined.withColumn(rank_col, F.row_number().over(w_in) + F.col("_off"))
            .drop("_bk", "_off"))


def bucketed_marks(df: DataFrame, part_cols: list[str], order_cols: list[str], bucket: Column, mark: Column,
                   out: str, rank_col: str = "_rank", size_col: str = "_n") -> DataFrame:
    """``bucketed_rank`` followed by ``mark``, an expression over ``rank_col`` and
    ``size_col`` whose values follow each other in runs of ranks (a split, not a
    remainder), as column ``out``. A bucket whose first and last rank have the
    same mark gives it to all its rows through a lookup; only the buckets in
    which a mark ends are shuffled and ranked."""
    d = df.withColumn("_bk", bucket)
    o = bucket_offsets(d, part_cols, size_col)
    o = o.withColumn(rank_col, F.col("_off") + 1).withColumn("_low", mark)
    o = o.withColumn(rank_col, F.col("_off") + F.col("_nb")).withColumn("_high", mark)
    o = o.withColumn(out, F.when(F.col("_low") == F.col("_high"), F.col("_low")))
    placed = d.join(bounded_lookup(o.select(*part_cols, "_bk", "_off", size_col, out), MOST_BUCKETS), [*part_cols, "_bk"])
    whole = placed.where(F.col(out).isNotNull()).drop("_bk", "_off", size_col)
    rank = F.row_number().over(Window.partitionBy(*part_cols, "_bk").orderBy(*order_cols)) + F.col("_off")
    cut = placed.where(F.col(out).isNull()).withColumn(rank_col, rank).withColumn(out, mark)
    return whole.unionByName(cut.drop("_bk", "_off", size_col, rank_col))


def md5_bucket(hex_col: str | Column, digits: int = 3) -> Column:
    c = F.col(hex_col) if isinstance(hex_col, str) else hex_col
    return F.substring(c, 1, digits)


def quantile_bucket(df: DataFrame, col: str, n_buckets: int = 256,
                    accuracy: int = 10000) -> Column:
    """Order-preserving bucket for a numeric key from approximate quantiles.

    Only ``n_buckets`` boundaries (a bounded list) reach the driver; the
    boundaries need not be exact, only monotone, so the final numbering stays
    exact."""
    probs = [i / n_buckets for i in range(1, n_buckets)]
    row = df.agg(F.percentile_approx(F.col(col).cast("double"), probs, accuracy)
                 .alias("b")).first()
    bounds = sorted(set(float(x) for x in (row["b"] or []) if x is not None))
    if not bounds:
        return F.lit(0)
    arr = F.array(*[F.lit(b) for b in bounds])
    x = F.col(col).cast("double")
    return F.size(F.filter(arr, lambda b: b < x))


def ranged(df: DataFrame, keys: list[str]) -> DataFrame:
    """The rows, written once, with ``_range``: ordered ranges of the composite key."""
    return materialise(df.repartitionByRange(*keys).withColumn("_range", F.spark_partition_id()), "ranged")


def global_row_number(df: DataFrame, order_cols: str | list[str], rank_col: str = "_rank",
                      size_col: str = "_n") -> DataFrame:
    """Exact 1-based numbering of all rows by ``order_cols`` (nulls first).

    Ranges are cut over the whole composite key, so rows that share the first
    column's value spread over ranges by the next ones; as many ranges as the
    session has shuffle partitions, fewer for few bytes (AQE). The ranged rows are written once, because
    range boundaries come from a sample: counts and numbers must see the same
    ranges. Only rows equal in every order column are bound to share a range."""
    keys = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    return bucketed_rank(ranged(df, keys), [], keys, F.col("_range"), rank_col=rank_col, size_col=size_col).drop("_range")


def bucketed_cumsum(df: DataFrame, part_cols: list[str], order_col: str, bucket: Column,
                    value_cols: list[str], desc: bool = False, prefix: str = "cum_") -> DataFrame:
    """Inclusive running sums of ``value_cols`` inside ``part_cols`` ordered
    by ``order_col``: bucket totals -> offsets (tiny) + in-bucket window.
    ``bucket`` must be monotone in ``order_col``."""
    d = df.withColumn("_bk", bucket)
    tot = d.groupBy(*part_cols, "_bk").agg(*[F.sum(v).alias(f"_t_{v}") for v in value_cols])
    border = F.col("_bk").desc() if desc else F.col("_bk").asc()
    w_run = (Window.partitionBy(*part_cols).orderBy(border)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    offs = tot.select(*part_cols, "_bk",
                      *[(F.sum(f"_t_{v}").over(w_run) - F.col(f"_t_{v}")).alias(f"_o_{v}")
                        for v in value_cols])
    j = d.join(offs, [*part_cols, "_bk"])
    okey = F.col(order_col).desc() if desc else F.col(order_col).asc()
    w_in = (Window.partitionBy(*part_cols, "_bk").orderBy(okey)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    for v in value_cols:
        j = j.withColumn(f"{prefix}{v}", F.sum(v).over(w_in) + F.col(f"_o_{v}"))
    return j.drop("_bk", *[f"_o_{v}" for v in value_cols])


def unit_bucket(score: str | Column, n: int = 4096) -> Column:
    """Monotone bucket for a score in [0, 1] (values outside are clamped)."""
    c = F.col(score) if isinstance(score, str) else score
    return F.least(F.greatest(F.floor(c * n), F.lit(0)), F.lit(n - 1)).cast("int")
