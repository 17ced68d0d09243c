from .labels import label_from_code, normalize_label, rejected_label, require_label
from .numeric import (
    brier_term,
    chosen_probability,
    clamp_confidence,
    confidence_bin,
    round_exact,
    sequence_confidence,
)
from .text import (
    coalesce_text,
    format_prompt,
    parse_or_raw,
    parse_prediction,
    strip,
    unsupported_flag,
)
from .vocabulary import LABELS

__all__ = [
    "LABELS",
    "brier_term",
    "chosen_probability",
    "clamp_confidence",
    "coalesce_text",
    "confidence_bin",
    "format_prompt",
    "label_from_code",
    "normalize_label",
    "parse_or_raw",
    "parse_prediction",
    "rejected_label",
    "require_label",
    "round_exact",
    "sequence_confidence",
    "strip",
    "unsupported_flag",
]
