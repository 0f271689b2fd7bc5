"""Session construction and lineage cutting.

On a cluster the session already exists and ``spark.checkpoint.dir`` names a
shared folder; we only read it. A private folder is created only when the
setting is unset (local tests).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "flowforge", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder: the session's ``spark.checkpoint.dir`` if set,
    else a fresh private folder (tests / local runs only)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path and not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not path:
        path = tempfile.mkdtemp(prefix="flowforge-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    os.makedirs(path, exist_ok=True) if "://" not in path else None
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a stage table into the shared folder and read it back: what stands
    above is computed once, and scans keep column pruning and pushdown."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss;
    never ``localCheckpoint``)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def ship_package(spark: SparkSession) -> None:
    """Give Python workers this package: Spark's file server hands out a zip of
    the sources, once per application."""
    sc = spark.sparkContext
    if _SHIPPED.get("app") == sc.applicationId:
        return
    root = Path(__file__).resolve().parent
    zipped = Path(tempfile.mkdtemp(prefix="flowforge-")) / "flowforge.zip"
    with zipfile.ZipFile(zipped, "w") as out:
        for f in sorted(root.rglob("*.py")):
            out.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(zipped))
    _SHIPPED["app"] = sc.applicationId


_SHIPPED: dict[str, str] = {}
