"""One query per operator over its whole table, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat,
    decontaminate,
    divergence,
    flat_graph,
    html_wrappers,
    packing,
    pii,
    quality,
    secret_scan,
    simhash,
    substring,
    suffix_index,
    vector_codes,
)
from .common import spans_text

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _number(kind: str) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def _span_digests(found: DataFrame, base_kinds: Sequence[str], kinds: Sequence[str]) -> DataFrame:
    return found.select(
        F.col("id").alias("doc_id"),
        *map(_number, base_kinds),
        F.sha2(spans_text(F.col("base"), kinds), 256).alias("base_sha256"),
        spans_text(F.concat("base", "extra"), kinds).alias("spans"),
    )


@query
def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents"))
    return _span_digests(found, secret_scan.KINDS[:3], secret_scan.KINDS)


@query
def op2_suffix_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_index.remove_repeats(table(spark, sf_dir, "documents"), keep_bytes=False)
    return found.select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        "n_removed",
        F.size("removed").cast("long").alias("n_spans"),
        "kept_sha256",
    )


@query
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan_benchmark(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


@query
def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    escaped = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)],
        "conv_id long, turn long, role string, text string",
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    events = chat.live_log(chat.message_log(turns.union(escaped)))
    return chat.read_back(chat.format_log(events))


@query
def op6_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(table(spark, sf_dir, "documents"))
    return packed.select(
        F.col("id").alias("doc_id"),
        "piece",
        "start",
        F.col("length").cast("long").alias("length"),
        "ids_crc32",
        "sequence_id",
        F.col("offset").cast("long").alias("offset"),
    )


@query
def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.remove_repeats(table(spark, sf_dir, "documents"), keep_text=False)
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


@query
def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, sf_dir, "documents"))
    return _span_digests(found, pii.KINDS[:4], pii.KINDS)


@query
def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_wrappers.extract(table(spark, sf_dir, "pages"))
    return found.select(
        F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars")
    )


@query
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(table(spark, sf_dir, "documents"))
    return groups.select(
        F.col("id").alias("doc_id"),
        simhash.digits(F.col("fingerprint")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


@query
def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


@query
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, codebooks = vector_codes.encode(table(spark, sf_dir, "embeddings"))
    return coded.select(
        F.col("id").alias("vec_id"),
        vector_codes.hex_code("code").alias("code"),
        "error",
        "label_error",
        F.lit(vector_codes.digest(codebooks)).alias("codebooks_sha256"),
    )


@query
def op11_flat_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = flat_graph.near_vectors(table(spark, sf_dir, "embeddings"))
    return linked.select(
        F.col("id").alias("vec_id"),
        "n_links",
        F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(False)).alias("kept"),
    )
