from .drift import DriftLimits, drift, start_drift_monitor, streamed_drift
from .monitoring import (
    late_cells,
    prediction_shares,
    read_live_cells,
    start_live_monitor,
    start_monitor,
    window_metrics,
    windowed_cells,
)
from .scoring import start_appending, start_scoring, stream_jsonl

__all__ = [
    "DriftLimits",
    "drift",
    "late_cells",
    "prediction_shares",
    "read_live_cells",
    "start_appending",
    "start_drift_monitor",
    "start_live_monitor",
    "start_monitor",
    "start_scoring",
    "stream_jsonl",
    "streamed_drift",
    "window_metrics",
    "windowed_cells",
]
