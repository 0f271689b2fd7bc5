"""Reusable column expressions (all JVM-side built-ins, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)


def hash_order(key: str | Column, seed: int = 42) -> Column:
    """Deterministic pseudo-random order key: md5 hex of ``key|seed``.

    Identical in Spark and DuckDB, and independent of partitioning, so any
    "random" selection built on it is reproducible and re-evaluable."""
    c = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(c.cast("string"), F.lit(f"|{seed}")))


def unit_hash(*cols: Column | str, seed: int = 42) -> Column:
    """Uniform double in [0, 1) derived from the given columns and a seed."""
    h = F.xxhash64(F.lit(seed), *[F.col(c) if isinstance(c, str) else c for c in cols])
    return F.pmod(h, F.lit(1 << 53)).cast("double") / F.lit(float(1 << 53))


def safe_div(num: Column, den: Column, default: float | None = 0.0) -> Column:
    """num / den, ``default`` when den is 0 or null (sklearn zero_division=0)."""
    q = F.try_divide(num.cast("double"), den.cast("double"))
    return q if default is None else F.coalesce(q, F.lit(float(default)))


def is_numeric(dt: T.DataType) -> bool:
    return isinstance(dt, NUMERIC_TYPES)


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] | list[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if is_numeric(f.dataType) and f.name not in exclude]


def sig_digits(c: Column, digits: int = 11) -> Column:
    """Round a double to ``digits`` significant digits (via its decimal
    text), so engines that sum in different orders print the same value."""
    txt = F.format_string(f"%.{digits - 1}e", c.cast("double"))
    return F.when(c.isNull(), F.lit(None).cast("double")).otherwise(txt.try_cast("double"))


def round_doubles(df: DataFrame, digits: int = 11) -> DataFrame:
    """Presentation step for oracle comparison: every double column to
    ``digits`` significant digits."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(sig_digits(F.col(f"`{f.name}`"), digits).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def stack_columns(df: DataFrame, keep: list[str], cols: list[str], name_col: str,
                  value_col: str, value_type: str = "double") -> DataFrame:
    """Unpivot ``cols`` into (name_col, value_col) rows — narrow, no shuffle."""
    return df.unpivot(keep, [F.col(f"`{c}`").cast(value_type).alias(c) for c in cols],
                      name_col, value_col) if cols else df.select(*keep)


def bounded_lookup(table: DataFrame, most: int = 10_000) -> DataFrame:
    """A lookup table as a broadcast if it has at most ``most`` rows (checked),
    else the table itself, which Spark then joins by shuffle."""
    rows = table.limit(most + 1).collect()
    if len(rows) > most:
        return table
    return F.broadcast(table.sparkSession.createDataFrame(rows, table.schema))
