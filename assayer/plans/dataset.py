"""Train, test and preference sets from a labeled source."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame

from ..functions.vocabulary import DEFAULT_SEED, DEFAULT_TEST_SIZE, SOURCE_ID_PREFIX
from ..operators.records import (
    labeled_texts,
    number_records,
    number_source_records,
    preference_pairs,
)
from ..operators.selection import train_test_split
from ..session import written
from ..sources.files import write_jsonl


class Dataset(NamedTuple):
    train: DataFrame
    test: DataFrame
    preferences: DataFrame


def build_dataset(
    source: DataFrame,
    order_by: list[str] | None = None,
    text_field: str = "sentence",
    label_field: str = "label",
    test_size: float = DEFAULT_TEST_SIZE,
    seed: int = DEFAULT_SEED,
    max_train: int | None = None,
    prefix: str = SOURCE_ID_PREFIX,
) -> Dataset:
    """Number, clean, label, split and cap a source of texts with integer label codes.

    Ids number the source rows, blank ones included, in ``order_by`` order, or by the
    ``file`` and ``row`` columns of :func:`assayer.sources.read_labeled`. Preference pairs
    are made of the train rows only. The clean records are written once to the shared
    folder, so that the passes of the split read their ids only.
    """
    if order_by is None:
        numbered = number_source_records(
            source.select("file", "row", text_field, label_field), prefix
        )
    else:
        columns = dict.fromkeys([*order_by, text_field, label_field])
        numbered = number_records(source.select(*columns), order_by, prefix)
    records = written(labeled_texts(numbered, text_field, label_field, codes=True), "records")
    train, test = train_test_split(records, "id", test_size, seed, max_train)
    return Dataset(train, test, preference_pairs(train))


def write_dataset(dataset: Dataset, folder: str) -> None:
    """Write the three sets as JSON lines below ``folder``."""
    for name, rows in dataset._asdict().items():
        write_jsonl(rows, f"{folder}/{name}")
