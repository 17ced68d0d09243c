"""File-to-file jobs: prepare data, score records, evaluate predictions, list runs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import coalesce_text
from ..functions.vocabulary import DEFAULT_SEED, DEFAULT_TEST_SIZE
from ..operators.evaluation import label_distribution
from ..operators.experiments import ablation_manifest
from ..operators.records import fill_missing_line_ids, preference_pairs, text_candidates
from ..operators.scoring import ScorerFactory, score_records
from ..operators.selection import first_rows
from ..session import written
from ..sources.files import (
    JSONL_ORDER,
    read_jsonl,
    read_labeled,
    write_csv,
    write_jsonl,
    write_report,
)
from ..sources.schemas import PREDICTION
from ..sources.tracking import log_runs
from .dataset import build_dataset, write_dataset
from .evaluation import report


def prepare_dataset(
    spark: SparkSession,
    primary: str,
    mirror: str,
    out_folder: str,
    test_size: float = DEFAULT_TEST_SIZE,
    seed: int = DEFAULT_SEED,
    max_train: int | None = None,
) -> None:
    """Train, test and preference files from a labeled table or its mirror."""
    source = read_labeled(spark, primary, mirror)
    write_dataset(
        build_dataset(source, test_size=test_size, seed=seed, max_train=max_train), out_folder
    )


def _input_schema(text_field: str, label_field: str, codes: bool) -> str:
    texts = dict.fromkeys([text_field, "text", "sentence"])
    fields = [f"`{name}` STRING" for name in ("id", *texts)]
    return ", ".join([*fields, f"`{label_field}` {'BIGINT' if codes else 'STRING'}"])


def prepare_preferences(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    text_field: str = "text",
    label_field: str = "label",
    codes: bool = False,
) -> int:
    """Preference pairs of labeled JSON lines; returns how many blank rows were dropped.

    A text may stand in ``text_field``, ``sentence`` or ``text``. ``codes`` says that labels
    are integers.
    """
    rows = read_jsonl(spark, input_path, _input_schema(text_field, label_field, codes))
    text = coalesce_text(*text_candidates(rows, text_field))
    write_jsonl(preference_pairs(rows, text_field, label_field), output_path)
    return rows.where(F.length(text) == 0).count()


def score_file(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    factory: ScorerFactory,
    limit: int | None = None,
    codes: bool = False,
) -> None:
    """Prediction records of labeled JSON lines; of the first ``limit`` ones if given.

    Records without an id get one from their place in the file, for which no text is moved.
    ``codes`` says that labels
    are integers.
    """
    schema = _input_schema("text", "label", codes)
    rows = read_jsonl(spark, input_path, schema, source_order=True)
    rows = fill_missing_line_ids(first_rows(rows, JSONL_ORDER, limit))
    write_jsonl(score_records(rows, factory), output_path)


def evaluate_files(
    spark: SparkSession,
    predictions_path: str,
    baseline_path: str | None = None,
    output_path: str | None = None,
    strict: bool = False,
) -> DataFrame:
    """The evaluation report of a prediction file as one row; written out if a path is given.

    Next to it, at the path with ``-labels`` appended, go the counts of all gold labels, in and
    outside the vocabulary, as JSON lines.
    With ``strict`` a gold label outside the vocabulary fails the job.
    """
    baseline = read_jsonl(spark, baseline_path, PREDICTION) if baseline_path else None
    predictions = read_jsonl(spark, predictions_path, PREDICTION)
    rows = written(report(predictions, baseline, strict), "report")
    if output_path:
        write_report(rows, output_path)
        write_jsonl(label_distribution(predictions), f"{output_path.rstrip('/')}-labels")
    return rows


def track_report(
    report_row: DataFrame, params: DataFrame, experiment: str, run_id: str, path: str
) -> None:
    """Append a report's scalar metrics and a run's nested parameters to the tracking table."""

    def named(df: DataFrame) -> DataFrame:
        return df.withColumns({"experiment": F.lit(experiment), "run_id": F.lit(run_id)})

    log_runs(named(params), named(report_row), path)


def write_manifest(
    spark: SparkSession, grid: Mapping[str, Sequence], output_path: str
) -> DataFrame:
    """The ablation manifest of a grid's lists, written as CSV."""
    manifest = ablation_manifest(
        spark,
        grid["models"],
        grid["learning_rates"],
        grid["lora_ranks"],
        grid["data_mixtures"],
    )
    write_csv(manifest, output_path, manifest.columns)
    return manifest
