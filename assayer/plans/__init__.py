from . import jobs
from .dataset import Dataset, build_dataset, write_dataset
from .evaluation import evaluate, evaluate_runs, report
from .train_score import fit_classifier, score_with_classifier

__all__ = [
    "Dataset",
    "build_dataset",
    "evaluate",
    "evaluate_runs",
    "fit_classifier",
    "jobs",
    "report",
    "score_with_classifier",
    "write_dataset",
]
