from .commits import CommitConflict, CommittedTable
from .files import (
    broken_files,
    read_jsonl,
    read_labeled,
    read_verified,
    write_csv,
    write_jsonl,
    write_report,
)
from .schemas import LABELED, PREDICTION, PREFERENCE, SFT
from .tracking import compact_runs, log_runs, read_runs

__all__ = [
    "LABELED",
    "PREDICTION",
    "PREFERENCE",
    "SFT",
    "CommitConflict",
    "CommittedTable",
    "broken_files",
    "compact_runs",
    "log_runs",
    "read_jsonl",
    "read_labeled",
    "read_runs",
    "read_verified",
    "write_csv",
    "write_jsonl",
    "write_report",
]
