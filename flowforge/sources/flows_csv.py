"""Flow-record CSV source.

* folders are listed, not files opened: which of the expected files are there,
  and their sizes, costs one listing per folder;
* ONE scan over all files finds each file's first line and whether its bytes are
  valid UTF-8 (else it is read as Latin-1, T-3), so the number of Spark jobs does
  not grow with the number of files;
* files are grouped by header and encoding; each group is ONE ``spark.read.csv``
  over its files, groups are unioned by name with missing columns null-filled;
* headers are trimmed and duplicate names made unique positionally (T-2);
* every column is read as text first, then typed by one aggregate pass: a
  column whose non-empty values all parse as numbers (``inf``/``Infinity``/
  ``NaN`` spellings included, T-1) becomes bigint or double;
* a missing, empty or damaged file is skipped; no readable file -> error.
  ``read_flows_checked`` also returns what was skipped: files, and rows with
  another number of columns than their header.
"""

from __future__ import annotations

import bz2
import csv
import io
import logging
import re
import zlib
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowforge.operators.clean import dedupe_names
from flowforge.session import materialise, ship_package

log = logging.getLogger(__name__)
SOURCE_COL = "_source_file"


REJECTS = "path string, reason string, record string"


@dataclass
class Found:
    """An expected path: its files by URI with their sizes, and why it cannot
    be read if it cannot."""

    path: str
    files: dict[str, int]
    reason: str | None = None


def _listed(spark: SparkSession, paths: list[str]) -> list[Found]:
    """The files behind each path (a file, a folder or a pattern)."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    folders: dict[str, dict] = {}

    def listing(folder) -> dict:
        key = folder.toString()
        if key not in folders:
            fs = folder.getFileSystem(conf)
            folders[key] = {x.getPath().getName(): x for x in fs.listStatus(folder)} if fs.exists(folder) else {}
        return folders[key]

    out = []
    for path in paths:
        at = hadoop.Path(path)
        if any(c in path for c in "*?[{"):
            hits = list(at.getFileSystem(conf).globStatus(at) or [])
        else:
            hit = listing(at.getParent()).get(at.getName()) if at.getParent() is not None else None
            hits = [] if hit is None else [hit]
        files = {}
        for hit in hits:
            inside = [hit] if hit.isFile() else \
                [x for name, x in listing(hit.getPath()).items() if x.isFile() and name[0] not in "._"]
            files |= {x.getPath().toString(): int(x.getLen()) for x in inside}
        out.append(Found(path, files, None if files else "missing"))
    return out


def intact(data: bytes, path: str) -> bool:
    """Does a compressed file decompress to its end?"""
    while data:
        unpack = zlib.decompressobj(31) if path.endswith(".gz") else bz2.BZ2Decompressor()
        try:
            while not unpack.eof:
                if path.endswith(".gz"):
                    made, data = unpack.decompress(data, 1 << 22), unpack.unconsumed_tail
                    if not data and not made and not unpack.eof:
                        return False
                else:
                    unpack.decompress(data, 1 << 22)
                    data = b""
                    if unpack.needs_input and not unpack.eof:
                        return False
            data = unpack.unused_data
        except (zlib.error, OSError, EOFError, ValueError):
            return False
    return True


def discover(spark: SparkSession, paths: list[str]) -> tuple[list[Found], dict[str, tuple[str, tuple[str, ...]]]]:
    """What is behind each path, and encoding and header of each readable file,
    in a number of jobs that does not depend on the number of files."""
    found = _listed(spark, paths)
    packed = sorted({f for x in found for f in x.files if f.endswith((".gz", ".bz2"))})
    damaged: set[str] = set()
    if packed:  # such a file is one task's work to read, and to check
        ship_package(spark)
        parts = spark.sparkContext.binaryFiles(",".join(packed), min(len(packed), 1000))
        damaged = {_key(p) for p, ok in parts.map(lambda x: (x[0], intact(bytes(x[1]), x[0]))).collect() if not ok}
    for x in found:
        if any(_key(f) in damaged for f in x.files):
            x.reason = "damaged"
    files = sorted({f for x in found if not x.reason for f in x.files})
    heads: dict[str, tuple[str, tuple[str, ...]]] = {}
    if files:
        lines = spark.read.option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True).text(files)
        # lines of a file keep their order inside a part of it
        placed = lines.select("value", F.col("_metadata.file_path").alias("path"), F.struct(
            F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("place"))
        rows = placed.groupBy("path").agg(
            F.min_by(F.col("value").cast("binary"), "place").alias("head"),
            F.bool_and(F.is_valid_utf8("value")).alias("utf8")).collect()  # one row per file
        for r in rows:
            encoding = "UTF-8" if r["utf8"] else "ISO-8859-1"
            line = bytes(r["head"]).decode(encoding, "replace").lstrip("\ufeff")
            heads[_key(r["path"])] = (encoding, tuple(next(csv.reader(io.StringIO(line)), ())))
    for x in found:
        if not x.reason and not any(_key(f) in heads for f in x.files):
            x.reason = "empty"
        if x.reason:
            log.warning("skipping %s: %s", x.path, x.reason)
    return found, heads


def _key(uri: str) -> str:
    """A file's path without scheme marks that differ between APIs."""
    return re.sub("^file:", "", unquote(uri)).replace("//", "/")


def _read_group(spark: SparkSession, files: list[str], names: list[str], encoding: str,
                corrupt: str | None = None) -> DataFrame:
    schema = T.StructType([T.StructField(n, T.StringType(), True) for n in [*names, *([corrupt] if corrupt else [])]])
    reader = spark.read.option("header", True).option("enforceSchema", True) \
        .option("encoding", encoding).option("mode", "PERMISSIVE")
    if corrupt:
        reader = reader.option("columnNameOfCorruptRecord", corrupt)
    return reader.schema(schema).csv(files).withColumn(SOURCE_COL, F.col("_metadata.file_path"))


def _groups(found: list[Found], heads: dict) -> dict[tuple, list[str]]:
    groups: dict[tuple, list[str]] = {}
    for f in sorted({f for x in found if not x.reason for f in x.files}):
        if _key(f) in heads:
            groups.setdefault(heads[_key(f)], []).append(f)
    if not groups:
        raise FileNotFoundError(f"No flow file could be read from {len(found)} paths")
    return groups


def _normalized_number(c) -> F.Column:
    t = F.lower(F.trim(c))
    return (F.when(t.isin("inf", "+inf", "infinity", "+infinity"), F.lit("Infinity"))
            .when(t.isin("-inf", "-infinity"), F.lit("-Infinity"))
            .when(t == "nan", F.lit("NaN")).otherwise(F.trim(c)))


def infer_types(df: DataFrame, exclude: tuple[str, ...] = (SOURCE_COL,)) -> DataFrame:
    """Type text columns in one aggregate pass: bigint if every non-empty value
    is an integer, double if every one is a number, else string."""
    cols = [c for c in df.columns if c not in exclude]
    aggs = []
    for i, c in enumerate(cols):
        v = _normalized_number(F.col(f"`{c}`"))
        nonempty = F.col(f"`{c}`").isNotNull() & (F.trim(F.col(f"`{c}`")) != "")
        aggs += [F.sum(F.when(nonempty, 1).otherwise(0)).alias(f"n{i}"),
                 F.sum(F.when(nonempty & v.try_cast("double").isNotNull(), 1).otherwise(0)).alias(f"d{i}"),
                 F.sum(F.when(nonempty & v.try_cast("bigint").isNotNull(), 1).otherwise(0)).alias(f"l{i}")]
    stats = df.agg(*aggs).first() if aggs else None  # 3 numbers per column
    out = []
    for i, c in enumerate(cols):
        n, d, lg = stats[f"n{i}"] or 0, stats[f"d{i}"] or 0, stats[f"l{i}"] or 0
        v = _normalized_number(F.col(f"`{c}`"))
        if n > 0 and lg == n:
            out.append(v.try_cast("bigint").alias(c))
        elif n > 0 and d == n:
            out.append(v.try_cast("double").alias(c))
        else:
            out.append(F.col(f"`{c}`"))
    return df.select(*out, *[F.col(c) for c in df.columns if c in exclude])


def read_flows(spark: SparkSession, paths: list[str], infer: bool = True,
               keep_source: bool = False) -> DataFrame:
    """Read N flow CSVs into one DataFrame (union by name)."""
    parts = [_read_group(spark, files, dedupe_names(list(header)), encoding)
             for (encoding, header), files in _groups(*discover(spark, paths)).items()]
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if infer:
        df = infer_types(df)
    return df if keep_source else df.drop(SOURCE_COL)


def read_flows_checked(spark: SparkSession, paths: list[str], infer: bool = True,
                       keep_source: bool = False) -> tuple[DataFrame, DataFrame]:
    """The flows, and a table of rejects (path, reason, record): files that are
    ``missing``, ``empty`` or ``damaged`` (record is null), and the text of rows
    with another number of ``columns`` than their header. The input is parsed
    once, into a stage table that both results read."""
    found, heads = discover(spark, paths)
    corrupt = "_corrupt_record"
    parts = [_read_group(spark, files, dedupe_names(list(header)), encoding, corrupt)
             for (encoding, header), files in _groups(found, heads).items()]
    parsed = materialise(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts), "parsed")
    good = parsed.where(F.col(corrupt).isNull()).drop(corrupt)
    if infer:
        good = infer_types(good)
    rows = parsed.where(F.col(corrupt).isNotNull()).select(
        F.col(SOURCE_COL).alias("path"), F.lit("columns").alias("reason"), F.col(corrupt).alias("record"))
    files = spark.createDataFrame([(x.path, x.reason, None) for x in found if x.reason], REJECTS)
    return good if keep_source else good.drop(SOURCE_COL), files.unionByName(rows)


def _plain_path(c) -> F.Column:
    """A path without scheme and with single slashes (file URIs are decoded)."""
    return F.regexp_replace(F.regexp_replace(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))),
                                             r"^file:", ""), r"/+", "/")


def source_inventory(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, present, rows, size_bytes) per expected path. What can be read is
    present, with 0 rows if it holds a header only; others have null rows and
    sizes."""
    found, heads = discover(spark, paths)
    rows = [(x.path, not x.reason, sum(x.files.values()) if not x.reason else None,
             [_key(f) for f in x.files]) for x in found]
    expected = spark.createDataFrame(rows, "path string, present boolean, size_bytes bigint, files array<string>")
    files = sorted({f for x in found if not x.reason for f in x.files})
    if not files:
        return expected.select("path", "present", F.lit(None).cast("bigint").alias("rows"), "size_bytes")
    counts = spark.read.option("header", True).csv(files).groupBy(
        _plain_path(F.col("_metadata.file_path")).alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    per_path = expected.select("path", F.explode("files").alias("_p")).join(counts, "_p") \
        .groupBy("path").agg(F.sum("_n").alias("_n"))
    return expected.join(per_path, "path", "left").select(
        "path", "present", F.when(F.col("present"), F.coalesce("_n", F.lit(0))).cast("bigint").alias("rows"), "size_bytes")
