"""Evaluation of prediction sets, alone, against a baseline, and across runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vocabulary import DEFAULT_BINS
from ..operators.evaluation import (
    confusion_map,
    evaluation_cells,
    metrics,
    rounded,
    with_baseline,
    with_baseline_run,
)
from ..session import written


def evaluate(
    predictions: DataFrame, baseline: DataFrame | None = None, bins: int = DEFAULT_BINS
) -> DataFrame:
    """One row of unrounded metrics, with lift over a baseline set when one is given.

    The sets are evaluated independently: their rows are not matched with each other.
    """
    row = metrics(evaluation_cells(predictions, bins=bins), bins=bins)
    if baseline is None:
        return row
    return with_baseline(row, metrics(evaluation_cells(baseline, bins=0), bins=0))


def evaluate_runs(
    predictions: DataFrame,
    run: str,
    baseline: str,
    within: Sequence[str] = (),
    bins: int = DEFAULT_BINS,
) -> DataFrame:
    """Metrics of every run, each with its lift over the run ``baseline``.

    Reads the predictions once: the cells of all runs are written to the shared folder.
    """
    by = [*within, run]
    cells = written(evaluation_cells(predictions, by, bins), "cells")
    return with_baseline_run(metrics(cells, by, bins), run, baseline, within)


def report(
    predictions: DataFrame, baseline: DataFrame | None = None, strict: bool = False
) -> DataFrame:
    """The full evaluation report as one row with nested confusion matrix and distribution.

    Reads the predictions once: their cells are written to the shared folder and all
    parts of the report are derived from them. ``unknown_gold`` counts the rows that the
    confusion matrix and the distribution leave out because their gold label is outside the
    vocabulary; ``label_distribution`` of the operators has these as rows, however many.
    """
    cells = written(evaluation_cells(predictions, strict=strict), "cells")
    row = metrics(cells)
    if baseline is not None:
        row = with_baseline(row, metrics(evaluation_cells(baseline, bins=0), bins=0)).drop("exact_accuracy_lift")
    distribution = cells.where("label IS NOT NULL").groupBy("label").agg(F.sum("n").alias("n"))
    counts = F.map_from_entries(F.sort_array(F.collect_list(F.struct("label", "n"))))
    scalars = rounded(row)
    lift = [c for c in scalars.columns if c in ("baseline_accuracy", "relative_accuracy_lift")]
    return (
        scalars.withColumn("confusion_matrix", confusion_map(cells).scalar())
        .withColumn("label_distribution", distribution.agg(counts).scalar())
        .select(
            *[c for c in scalars.columns if c not in lift],
            "confusion_matrix",
            "label_distribution",
            *lift,
        )
    )
