"""Label expressions: normalization, integer codes, strict checks, rejected labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip
from .vocabulary import LABEL_ALIASES, LABELS


def label_array() -> Column:
    return F.array(*map(F.lit, LABELS))


def normalize_label(value: Column) -> Column:
    """Vocabulary label for a label string or alias; null when unsupported."""
    low = F.lower(strip(value))
    result = F.when(low.isin(*LABELS), low)
    for alias, label in LABEL_ALIASES.items():
        result = result.when(low == alias, F.lit(label))
    return result


def label_from_code(code: Column) -> Column:
    """Vocabulary label for an integer code; null outside the vocabulary."""
    return F.get(label_array(), code.cast("int"))


def require_label(label: Column, original: Column) -> Column:
    """``label``, or a job failure naming the original value where it is null."""
    message = F.concat(
        F.lit("Unsupported label: "), F.coalesce(original.cast("string"), F.lit("None"))
    )
    return F.coalesce(label, F.raise_error(message).cast("string"))


def rejected_label(chosen: Column) -> Column:
    """First vocabulary label that differs from the chosen one."""
    return F.when(chosen == LABELS[0], F.lit(LABELS[1])).otherwise(F.lit(LABELS[0]))
