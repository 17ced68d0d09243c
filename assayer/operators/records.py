"""Instruction records and preference pairs from labeled texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ..functions.labels import label_from_code, normalize_label, rejected_label, require_label
from ..functions.text import coalesce_text, format_prompt
from ..functions.vocabulary import EXAMPLE_ID_PREFIX, SOURCE_ID_PREFIX
from .positions import with_line_position, with_position, with_source_position


def text_candidates(df: DataFrame, text_field: str = "text") -> list[Column]:
    """The columns a record's text may come from, in order of preference."""
    names = dict.fromkeys([text_field, "sentence", "text"])
    found = [F.col(name) for name in names if name in df.columns]
    if not found:
        raise ValueError(f"no text column among {list(names)}")
    return found


def gold_label(df: DataFrame, label_field: str = "label", codes: bool = False) -> Column:
    """The vocabulary label of a column of codes, if it holds integers, or of spellings."""
    value = F.col(label_field)
    integers = isinstance(df.schema[label_field].dataType, IntegralType)
    return label_from_code(value) if codes or integers else normalize_label(value)


def _record_id(df: DataFrame) -> Column:
    return F.col("id").cast("string") if "id" in df.columns else F.lit(None).cast("string")


def labeled_texts(
    df: DataFrame, text_field: str = "text", label_field: str = "label", codes: bool = False
) -> DataFrame:
    """``(id, text, label)`` with stripped non-blank texts and normalized labels.

    A label column of integers holds codes, as does any other with ``codes``. An unsupported
    label fails the job; on a blank row it does not, because blank rows are dropped before
    their labels are looked at. The blank test guards the label check itself, so the
    order in which the optimizer runs filter and projection does not matter.
    """
    text = coalesce_text(*text_candidates(df, text_field))
    checked = require_label(gold_label(df, label_field, codes), F.col(label_field))
    return (
        df.select(_record_id(df).alias("id"), text.alias("text"), F.col(label_field))
        .select("id", "text", F.when(F.length("text") > 0, checked).alias("label"))
        .where(F.length("text") > 0)
    )


def quarantine_labels(
    df: DataFrame, text_field: str = "text", label_field: str = "label", codes: bool = False
) -> tuple[DataFrame, DataFrame]:
    """``labeled_texts`` that sets unsupported labels aside instead of failing.

    Returns the accepted ``(id, text, label)`` rows and the rejected ones, whose
    ``label`` is the original value.
    """
    text = coalesce_text(*text_candidates(df, text_field))
    rows = df.select(
        _record_id(df).alias("id"),
        text.alias("text"),
        gold_label(df, label_field, codes).alias("label"),
        F.col(label_field).cast("string").alias("original"),
    ).where(F.length("text") > 0)
    accepted = rows.where(F.col("label").isNotNull()).drop("original")
    rejected = rows.where(F.col("label").isNull()).select(
        "id", "text", F.col("original").alias("label")
    )
    return accepted, rejected


def sft_records(
    df: DataFrame, text_field: str = "text", label_field: str = "label", codes: bool = False
) -> DataFrame:
    """``(id, prompt, response, text, label)``; ``text`` is the prompt with its answer."""
    return (
        labeled_texts(df, text_field, label_field, codes)
        .select("id", format_prompt(F.col("text")).alias("prompt"), "label")
        .select(
            "id",
            "prompt",
            F.col("label").alias("response"),
            F.concat_ws(" ", "prompt", "label").alias("text"),
            "label",
        )
    )


def preference_pairs(
    df: DataFrame, text_field: str = "text", label_field: str = "label", codes: bool = False
) -> DataFrame:
    """``(id, prompt, chosen, rejected)`` with the gold label as the chosen answer."""
    return labeled_texts(df, text_field, label_field, codes).select(
        "id",
        format_prompt(F.col("text")).alias("prompt"),
        F.col("label").alias("chosen"),
        rejected_label(F.col("label")).alias("rejected"),
    )


def number_records(
    df: DataFrame, order_by: list[str], prefix: str = SOURCE_ID_PREFIX
) -> DataFrame:
    """Set ``id`` to the prefix and the row's 0-based position in ``order_by`` order."""
    numbered = with_position(df, order_by)
    return numbered.withColumn("id", F.concat(F.lit(prefix), F.col("position"))).drop("position")


def number_source_records(
    df: DataFrame, prefix: str = SOURCE_ID_PREFIX, whole: DataFrame | None = None
) -> DataFrame:
    """``number_records`` by the columns ``file`` and ``row`` of a source, without sorting.

    Rows of a filtered source keep their numbers if ``whole`` is the source.
    """
    numbered = with_source_position(df, whole=whole)
    return numbered.withColumn("id", F.concat(F.lit(prefix), F.col("position"))).drop("position")


def fill_missing_ids(
    df: DataFrame, order_by: list[str], prefix: str = EXAMPLE_ID_PREFIX
) -> DataFrame:
    """Give rows without an ``id`` one made of the prefix and their position."""
    return _with_default_ids(with_position(df, order_by), prefix)


def fill_missing_line_ids(df: DataFrame, prefix: str = EXAMPLE_ID_PREFIX) -> DataFrame:
    """``fill_missing_ids`` by the columns ``file``, ``block`` and ``line`` of JSON lines, whose
    texts stay where they are."""
    return _with_default_ids(with_line_position(df), prefix)


def _with_default_ids(numbered: DataFrame, prefix: str) -> DataFrame:
    default = F.concat(F.lit(prefix), F.col("position"))
    return numbered.withColumn(
        "id", F.coalesce(F.col("id").cast("string"), default)
    ).drop("position")
