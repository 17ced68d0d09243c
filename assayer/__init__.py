"""Preparation and evaluation of text-classification data on Spark."""

from .plans import build_dataset, evaluate, evaluate_runs, report, write_dataset
from .session import build_session

__all__ = [
    "build_dataset",
    "build_session",
    "evaluate",
    "evaluate_runs",
    "report",
    "write_dataset",
]
