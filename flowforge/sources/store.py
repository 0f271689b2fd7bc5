"""Stage outputs: parquet (default) or CSV, split-partitioned where useful."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_dataset(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write a stage table; ``partition_by=["split"]`` gives partition pruning
    for every later ``split = ...`` filter."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def read_dataset(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    if fmt == "csv":
        return spark.read.option("header", True).option("inferSchema", True).csv(path)
    return spark.read.format(fmt).load(path)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV export with a header (one file per partition, as Spark writes)."""
    df.write.mode("overwrite").option("header", True).csv(path)
