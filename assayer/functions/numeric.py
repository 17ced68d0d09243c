"""Numeric expressions: confidences, calibration bins, Brier terms, exact rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .vocabulary import DEFAULT_BINS, LABELS


def is_finite(x: Column) -> Column:
    return ~(F.isnan(x) | (F.abs(x) == float("inf")))


def clamp_confidence(confidence: Column) -> Column:
    """Clamp to [0, 1]; missing, NaN and infinite values become 0."""
    c = confidence.cast("double")
    return F.when(is_finite(c), F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))).otherwise(0.0)


def confidence_bin(confidence: Column, bins: int = DEFAULT_BINS) -> Column:
    """Index of the equal-width bin ``k/bins <= c < (k+1)/bins``; 1.0 joins the last.

    ``floor(c * bins)`` alone misplaces values next to an edge, so the guess is
    corrected by comparing with the edges themselves.
    """
    if bins < 1:
        raise ValueError("bins must be at least 1")
    width = F.lit(float(bins))
    guess = F.floor(confidence * width).cast("int")
    too_high = (confidence < guess / width).cast("int")
    too_low = (confidence >= (guess + 1) / width).cast("int")
    return F.least(F.lit(bins - 1), guess - too_high + too_low)


def brier_term(label: Column, prediction: Column, confidence: Column) -> Column:
    """Squared error of one row's three-way probability vector.

    The predicted label gets the confidence, each other label half of the rest; a
    row without a prediction gives that half to all three labels.
    """
    rest = (1.0 - confidence) / (len(LABELS) - 1)
    term = F.lit(0.0)
    for candidate in LABELS:
        p = F.when(prediction == candidate, confidence).otherwise(rest)
        error = p - F.when(label == candidate, 1.0).otherwise(0.0)
        term = term + error * error
    return term


def chosen_probability(scores: Column, chosen: Column) -> Column:
    """Softmax probability of the 0-based ``chosen`` entry of a score vector."""
    top = F.array_max(scores).cast("double")
    total = F.aggregate(scores, F.lit(0.0), lambda acc, s: acc + F.exp(s.cast("double") - top))
    return F.exp(F.get(scores, chosen).cast("double") - top) / total


def sequence_confidence(step_scores: Column, chosen_ids: Column) -> Column:
    """Mean chosen-token probability over the steps of a sequence; 0 without steps.

    There are as many steps as both arrays have. A step whose token id is outside its
    scores, or whose chosen score is missing, fails the job.
    """
    steps = F.least(F.size(step_scores), F.size(chosen_ids))
    outside = F.raise_error(F.lit("chosen token outside the scores")).cast("double")
    probabilities = F.zip_with(
        F.slice(step_scores, F.lit(1), F.greatest(steps, F.lit(0))),
        F.slice(chosen_ids, F.lit(1), F.greatest(steps, F.lit(0))),
        lambda scores, chosen: F.coalesce(chosen_probability(scores, chosen), outside),
    )
    mean = F.aggregate(probabilities, F.lit(0.0), lambda acc, p: acc + p) / steps
    return F.when(steps > 0, mean).otherwise(0.0)


def round_exact(column: str, digits: int) -> Column:
    """Round the exact binary value of a double column, ties to the even digit.

    ``F.round`` and ``F.bround`` round the shortest decimal form instead and differ
    on values such as 0.03125 or 0.00015. The whole part is set aside, which is exact,
    and the rest is compared with the midpoint of its two candidates in pieces short
    enough for every product and sum to be exact. From ``2**53`` units of the last digit on,
    doubles are further apart than these, so a value is its own nearest result.
    Takes a column name, because the value occurs many times.
    """
    x, scale, twice = f"`{column}`", f"{10**digits}D", f"{2 * 10**digits}D"
    whole = f"CAST(floor(abs({x})) AS DOUBLE)"
    rest = f"(abs({x}) - {whole})"
    below = f"CAST(floor({rest} * {scale}) AS DOUBLE)"
    # rest = high + middle + low
    high = f"rint({rest} * {2.0**20}D) / {2.0**20}D"
    middle = f"rint(({rest} - {high}) * {2.0**46}D) / {2.0**46}D"
    low = f"({rest} - {high} - {middle})"
    past_midpoint = (
        f"(({high} * {twice} - (2D * {below} + 1D)) + {middle} * {twice}) + {low} * {twice}"
    )
    # The even one of the candidates, whole part included.
    steps = (
        f"CASE signum({past_midpoint}) WHEN 1D THEN {below} + 1D WHEN -1D THEN {below} "
        f"ELSE {below} + ({whole} * {scale} + {below}) % 2D END"
    )
    return F.expr(
        f"CASE WHEN isnan({x}) OR abs({x}) * {scale} >= {2.0**53}D THEN {x} "
        f"ELSE IF({x} < 0D, -1D, 1D) * ({whole} * {scale} + ({steps})) / {scale} END"
    )
