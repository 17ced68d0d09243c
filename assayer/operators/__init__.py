from . import evaluation, experiments, positions, records, requests, scoring, selection

__all__ = [
    "evaluation",
    "experiments",
    "positions",
    "records",
    "requests",
    "scoring",
    "selection",
]
