"""Plain-Python statements of the row rules, to test the Spark expressions against."""

import math

from assayer.functions.vocabulary import LABEL_ALIASES, LABELS, UNSUPPORTED_TOKENS


def parse(text):
    if text is None:
        return None
    present = set(text.lower().split()) & set(LABELS)
    return present.pop() if len(present) == 1 else None


def normalize(text):
    word = text.strip().lower()
    word = LABEL_ALIASES.get(word, word)
    return word if word in LABELS else None


def clamp(value):
    if value is None or math.isnan(value) or math.isinf(value):
        return 0.0
    return min(max(value, 0.0), 1.0)


def bin_of(value, bins):
    return max(b for b in range(bins) if value >= b / bins)


def evaluate(rows, bins=10):
    """Unrounded metrics of (label, raw prediction, confidence, latency) rows."""
    n = len(rows)
    names = ("accuracy", "macro_f1", "ece", "brier", "invalid", "flagged", "latency")
    if not n:
        return dict.fromkeys(names, 0.0)
    scored = [(g.lower(), parse(p), clamp(c), (p or "").lower(), t) for g, p, c, t in rows]
    f1 = []
    for label in LABELS:
        tp = sum(g == label == p for g, p, *_ in scored)
        said = sum(p == label for _, p, *_ in scored)
        true = sum(g == label for g, *_ in scored)
        f1.append(2 * tp / (said + true) if said + true else 0.0)
    gaps = [0.0] * bins
    brier = 0.0
    for g, p, c, *_ in scored:
        gaps[bin_of(c, bins)] += (g == p) - c
        for label in LABELS:
            probability = c if p == label else (1 - c) / 2
            brier += (probability - (g == label)) ** 2
    return {
        "accuracy": sum(g == p for g, p, *_ in scored) / n,
        "macro_f1": sum(f1) / 3,
        "ece": sum(map(abs, gaps)) / n,
        "brier": brier / n,
        "invalid": sum(p is None for _, p, *_ in scored) / n,
        "flagged": sum(p is None or any(t in raw for t in UNSUPPORTED_TOKENS) for _, p, _, raw, _ in scored) / n,
        "latency": sum(t for *_, t in scored) / n,
    }
