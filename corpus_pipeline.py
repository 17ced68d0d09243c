"""A corpus made ready for training: quality, near copies, benchmarks, secrets, packing.

Each stage takes what its predecessor kept, whole, and what it decides takes effect: the first
three drop documents, the fourth masks secrets in their texts, the last packs the
documents into training sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.llm import decontaminate, packing, quality, secret_scan, simhash
from assayer.session import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the bands of their language."""
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of linked fingerprints."""
    return simhash.drop_near(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret masked; ``n_chars`` counts the masked text."""
    return secret_scan.redact(docs, length_col="n_chars" if "n_chars" in docs.columns else None)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document: where it lies in which sequence."""
    packed = packing.pack_documents(docs)
    return packed.select(
        F.col("id").alias("doc_id"),
        "piece",
        "start",
        F.col("length").cast("long").alias("length"),
        "ids_crc32",
        "sequence_id",
        F.col("offset").cast("long").alias("offset"),
    )


STAGES = [
    ("quality rules", quality_rules),
    ("near dedup", near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scan", secret_masking),
    ("best-fit packing", best_fit_packing),
]

# Tokenisers, fingerprints and the battery of tests have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
