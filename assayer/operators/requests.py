"""Validation of scoring requests, and batch responses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def validate_texts(df: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Split into requests with a text of at least one character, and the others."""
    ok = F.coalesce(F.length(text) >= 1, F.lit(False))
    return df.where(ok), df.where(~ok)


def validate_batches(df: DataFrame, texts: str = "texts") -> tuple[DataFrame, DataFrame]:
    """Split into batches with at least one text and no missing ones, and the others.

    Empty texts are valid inside a batch.
    """
    ok = F.coalesce(
        (F.size(texts) >= 1) & ~F.exists(F.col(texts), lambda t: t.isNull()), F.lit(False)
    )
    return df.where(ok), df.where(~ok)


def explode_batches(df: DataFrame, batch_id: str, texts: str = "texts") -> DataFrame:
    """One row per text of a batch: ``batch_id, position, text``."""
    return df.select(batch_id, F.posexplode(texts).alias("position", "text"))


def batch_headers(predictions: DataFrame, batch_id: str) -> DataFrame:
    """``(batch_id, count)``: the header of each batch's response. Its body are the
    predictions themselves, ordered by their position."""
    return predictions.groupBy(batch_id).agg(F.count("*").alias("count"))


def batch_envelopes(
    predictions: DataFrame, batch_id: str, page_size: int, position: str = "position"
) -> DataFrame:
    """``(batch_id, page, count, predictions)`` with predictions in request order.

    Pages hold ``page_size`` predictions, and every page carries the count of its whole
    batch. Each is grouped on its own, so that a batch of any size is spread over many
    tasks and no row outgrows memory.
    """
    if page_size < 1:
        raise ValueError("page_size must be at least 1")
    fields = [c for c in predictions.columns if c not in (batch_id, position)]
    page = F.expr(f"`{position}` DIV {page_size}").cast("bigint")
    return (
        predictions.withColumn("page", page)
        .groupBy(batch_id, "page")
        .agg(
            F.sort_array(
                F.collect_list(F.struct(F.col(position), F.struct(*fields).alias("prediction")))
            ).alias("ordered"),
        )
        .join(batch_headers(predictions, batch_id), batch_id)
        .select(
            batch_id,
            "page",
            "count",
            F.transform("ordered", lambda p: p["prediction"]).alias("predictions"),
        )
    )
