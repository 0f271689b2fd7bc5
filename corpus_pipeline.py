"""A corpus pipeline over ``documents``: score quality, drop near-duplicates,
redact secrets, mix the sources to target weights, pack into sequences.

Each stage takes (spark, docs, sf_dir), works on all documents that the stage
before it kept, and returns the columns of documents; the last returns pieces
of packed sequences. ``run`` writes every stage as Parquet into the shared
folder and reads it back for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowforge.llm import lshforest, mixing, packing, quality, secret_scan
from flowforge.llm.common import stored, text_or_empty
from flowforge.llm.queries import table, tokenizer


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    scored = quality.score_quality(docs, table(spark, sf_dir, "labels"))
    return scored.where("predicted = 1").select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays (the smallest
    doc_id; of equal rows one)."""
    gone = lshforest.near_duplicates(docs).where("not kept").select("doc_id", "th").distinct()
    rows = docs.withColumn("th", F.xxhash64(text_or_empty()))
    nth = F.row_number().over(Window.partitionBy("doc_id", "th").orderBy("doc_id"))
    return rows.join(gone, ["doc_id", "th"], "left_anti").withColumn("nth", nth) \
        .where("nth = 1 or doc_id is null").select(*docs.columns)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are redacted in place; every document stays."""
    clean = secret_scan.scan_secrets(docs)
    text = F.when(F.col("text").isNotNull(), F.col("redacted_text"))
    changed = clean.withColumn("text", text)
    if "n_chars" in docs.columns:
        found = F.size("secrets") > 0
        changed = changed.withColumn("n_chars", F.when(found, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return changed.select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them (0, 1 or 2 times)."""
    return mixing.emit_copies(docs, mixing.mix_sources(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed sequences of 2048 ids, by piece."""
    return packing.pack(docs, tokenizer("word_bpe_49k.json"), 1)


STAGES = [
    ("quality classifier", quality_stage),
    ("MinHash near-dedup", near_duplicate_stage),
    ("secret scans", secret_stage),
    ("source mixing", mixing_stage),
    ("packing", packing_stage),
]

#: SQL has no form for the fitted network and the tokenizer. Tests of the
#: operators compare with brute force; those of the stages only check columns
#: and counts.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, "stage")
    return docs
