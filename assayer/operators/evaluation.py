"""Evaluation of prediction sets.

Rows are first reduced to *cells*: one row per gold label, prediction and confidence
bin (and per run, day, ...), holding counts and sums. Every metric follows from the
cells, so a prediction set of any size is read once and shuffles only its cells.

Sums are kept as whole numbers of small units and are therefore exact: they do not
depend on partitioning, retries or the order in which rows arrive.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exact import PARTS, exact_bin, exact_parts, exact_total_of, part_sums
from ..functions.numeric import clamp_confidence, confidence_bin, is_finite, round_exact
from ..functions.text import (
    has_unsupported_token,
    label_from_words,
    label_words,
)
from ..functions.vocabulary import DEFAULT_BINS, LABELS, LATENCY_DIGITS, METRIC_DIGITS

# Sums of confidences count units of 1e-12, sums of latencies units of 1e-9 ms.
CONFIDENCE_UNIT = 10**12
LATENCY_UNIT = 10**9

# Whole-number sums are added up in BIGINT parts of 21 bits, which is several times faster
# than a DECIMAL sum. A part is below 2**21, so a cell has room for 2**42 rows, some
# 4 * 10**12. Confidences need two parts, latencies three.
_PART_BITS = 21
# Latencies from here on (about 100 days) do not fit the units: they add up exactly, too, but by
# bins of their exponents, which take more parts.
_LARGE_LATENCY = 9.0e9
_LARGE_SUMS = tuple(f"latency_large_{i}" for i in range(PARTS))

METRICS = (
    "accuracy",
    "macro_f1",
    "expected_calibration_error",
    "brier_score",
    "invalid_label_rate",
    "hallucination_proxy_rate",
    "mean_latency_ms",
)


def evaluation_inputs(df: DataFrame, keep: Sequence[str | Column] = ()) -> DataFrame:
    """Rows as they are scored: ``label, prediction, confidence, latency_ms, flagged``.

    Missing predictions count as empty, missing confidences and latencies as 0. Gold
    labels are only lower-cased, not normalized. Columns the input lacks are missing.
    """

    def column(name: str, kind: str) -> Column:
        return (F.col(name) if name in df.columns else F.lit(None)).cast(kind)

    kept = [F.col(k) if isinstance(k, str) else k for k in keep]
    names = df.select(*kept).columns
    # Each step is a projection of its own, so that what it computes is computed once.
    raw = F.col("__raw")
    staged = (
        df.select(
            *kept,
            _gold().alias("label"),
            F.lower(F.coalesce(column("prediction", "string"), F.lit(""))).alias("__raw"),
            clamp_confidence(column("confidence", "double")).alias("confidence"),
            F.coalesce(column("latency_ms", "double"), F.lit(0.0)).alias("latency_ms"),
        )
        .withColumn("__words", label_words(raw))
        .withColumn("prediction", label_from_words(raw, F.col("__words")))
    )
    flagged = F.col("prediction").isNull() | has_unsupported_token(raw)
    return staged.select(
        *names, "label", "prediction", "confidence", "latency_ms", flagged.alias("flagged")
    )


def _gold() -> Column:
    return F.coalesce(F.lower(F.col("label").cast("string")), F.lit("none"))


def _parts(units: Column, name: str, parts: int) -> list[Column]:
    """Sums of the parts of whole numbers, lowest first; the highest has their sign."""
    mask = F.lit((1 << _PART_BITS) - 1)
    shifted = [F.shiftright(units, _PART_BITS * i) if i else units for i in range(parts)]
    own = [part.bitwiseAND(mask) for part in shifted[:-1]] + shifted[-1:]
    return [F.sum(part).alias(f"{name}_{i}") for i, part in enumerate(own)]


def _whole(name: str, parts: int, kind: str) -> Column:
    total = F.col(f"{name}_0").cast("decimal(20,0)")
    for i in range(1, parts):
        unit = F.lit(1 << _PART_BITS * i).cast("decimal(13,0)")
        total = total + F.col(f"{name}_{i}").cast("decimal(20,0)") * unit
    return total.cast(kind).alias(name)


def _units(x: Column, unit: int) -> Column:
    return F.rint(x * float(unit)).cast("bigint")


def evaluation_cells(
    df: DataFrame,
    by: Sequence[str | Column] = (),
    bins: int = DEFAULT_BINS,
    strict: bool = False,
    latency_sketch: int | None = None,
) -> DataFrame:
    """Reduce predictions to cells per ``by``, label, prediction and confidence bin.

    The label is null for gold labels outside the vocabulary, so that the number of cells
    does not depend on how many spellings the data has. With ``strict`` such a label fails
    the job where its row carries a prediction.

    Columns: ``n``, ``flagged``, ``confidence_sum`` and ``confidence_sq_sum`` (units of
    1e-12), ``latency_sum`` (units of 1e-9 ms), and ``latency_special``, the sum of NaN and
    infinite latencies, if any. Rows whose latency is too large for the units have cells
    of their own, a ``latency_bin`` each, with exact sums ``latency_large_<i>``. Cells are additive:
    cells of parts of a set add up to the cells of the set. With ``bins=0`` they have no
    bins, and what is derived from them does without reading confidences where it can.

    With ``latency_sketch``, the size parameter of a KLL sketch, cells have one of their latencies
    (NaN left out) under that name; sketches add up as the sums do, see ``latency_quantiles``.
    """
    inputs = evaluation_inputs(df, by)
    names = [c for c in inputs.columns if c not in _INPUT_COLUMNS]
    c, latency = F.col("confidence"), F.col("latency_ms")
    ordinary = F.abs(latency) < _LARGE_LATENCY
    gold = F.when(F.col("label").isin(*LABELS), F.col("label"))
    if strict:
        unknown = F.concat(F.lit("Label outside the vocabulary: "), F.col("label"))
        gold = gold.when(F.col("prediction").isNotNull(), F.raise_error(unknown).cast("string"))
    staged = inputs.select(
        *names,
        gold.alias("label"),
        "prediction",
        (confidence_bin(c, bins) if bins else F.lit(0)).alias("bin"),
        F.col("flagged").cast("bigint").alias("flagged"),
        _units(c, CONFIDENCE_UNIT).alias("c_units"),
        _units(c * c, CONFIDENCE_UNIT).alias("c2_units"),
        _units(F.when(ordinary, latency).otherwise(0.0), LATENCY_UNIT).alias("ms_units"),
        F.when(~ordinary & is_finite(latency), latency).alias("ms_large"),
        F.when(~is_finite(latency), latency).alias("ms_special"),
        *([F.when(~F.isnan(latency), latency).alias("ms")] if latency_sketch else []),
    )
    large = F.col("ms_large")
    staged = staged.withColumn("latency_bin", F.when(large.isNotNull(), exact_bin(large))).withColumn(
        # One column that is null for nearly all rows: the digits cost these nothing.
        "ms_parts", F.when(large.isNotNull(), F.array(*exact_parts(large, F.col("latency_bin"))))
    )
    sketches = (
        [F.kll_sketch_agg_double("ms", latency_sketch).alias("latency_sketch")] if latency_sketch else []
    )
    keys = [*names, "label", "prediction", "bin", "latency_bin"]
    sums = staged.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.sum("flagged").alias("flagged"),
        *_parts(F.col("c_units"), "confidence_sum", 2),
        *_parts(F.col("c2_units"), "confidence_sq_sum", 2),
        *_parts(F.col("ms_units"), "latency_sum", 3),
        F.sum("ms_special").alias("latency_special"),
        *part_sums([F.get("ms_parts", F.lit(i)) for i in range(PARTS)], "latency_large"),
        *sketches,
    )
    return sums.select(
        *keys,
        "n",
        "flagged",
        _whole("confidence_sum", 2, "decimal(28,0)"),
        _whole("confidence_sq_sum", 2, "decimal(28,0)"),
        _whole("latency_sum", 3, "decimal(38,0)"),
        "latency_special",
        *_LARGE_SUMS,
        *(["latency_sketch"] if latency_sketch else []),
    )


# What cells hold besides their keys; the sketch only where it was asked for.
CELL_SUMS = (
    "n",
    "flagged",
    "confidence_sum",
    "confidence_sq_sum",
    "latency_sum",
    "latency_special",
    *_LARGE_SUMS,
    "latency_sketch",
)

_INPUT_COLUMNS = ("label", "prediction", "confidence", "latency_ms", "flagged")


_VOCABULARY = ", ".join(f"'{label}'" for label in LABELS)
_KNOWN = f"coalesce(label IN ({_VOCABULARY}), false)"
_CORRECT = "coalesce(prediction = label, false)"

# A cell's summed Brier terms, times 4 and in confidence units. Within a cell every row
# has the same gold label and prediction, which makes the row's term a quadratic in its
# confidence c:
#   right:                      (3 - 6c + 3c^2) / 2
#   wrong:                      (1 + 3c^2) / 2
#   no prediction:              (3 - 2c + 3c^2) / 4
#   unknown gold, a prediction: (1 - 2c + 3c^2) / 2
#   unknown gold, none:         (3 - 6c + 3c^2) / 4
_ONES = f"CAST(n AS DECIMAL(20,0)) * CAST({CONFIDENCE_UNIT} AS DECIMAL(13,0))"
_BRIER_UNITS = f"""CAST(CASE
    WHEN {_CORRECT} THEN 6 * {_ONES} - 12 * confidence_sum + 6 * confidence_sq_sum
    WHEN prediction IS NOT NULL AND {_KNOWN} THEN 2 * {_ONES} + 6 * confidence_sq_sum
    WHEN prediction IS NOT NULL THEN 2 * {_ONES} - 4 * confidence_sum + 6 * confidence_sq_sum
    WHEN {_KNOWN} THEN 3 * {_ONES} - 2 * confidence_sum + 3 * confidence_sq_sum
    ELSE 3 * {_ONES} - 6 * confidence_sum + 3 * confidence_sq_sum
    END AS DECIMAL(38,0))"""

# Summed over a bin, |accuracy - confidence| weighted by the bin's share of rows is
# |correct rows - summed confidence| / all rows.
_GAP = f"(IF({_CORRECT}, 1, 0) * {_ONES} - confidence_sum)"


def _count(condition: str, name: str) -> Column:
    return F.expr(f"coalesce(sum(IF({condition}, n, 0)), 0)").alias(name)


def _label_counts() -> list[Column]:
    return [
        column
        for label in LABELS
        for column in (
            _count(f"label = '{label}' AND {_CORRECT}", f"tp_{label}"),
            _count(f"coalesce(prediction = '{label}', false)", f"predicted_{label}"),
            _count(f"label = '{label}'", f"gold_{label}"),
        )
    ]


def _quotient(numerator: str, denominator: str) -> str:
    """A quotient of doubles that is 0 where the denominator is 0 or missing."""
    return f"coalesce(try_divide(double({numerator}), double({denominator})), 0D)"


def _ratio(numerator: str, denominator: str, name: str) -> Column:
    return F.expr(_quotient(numerator, denominator)).alias(name)


def class_scores(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per vocabulary label: true and false positives, false negatives, precision,
    recall and F1. Unparseable predictions are false negatives of their gold label."""
    per_label = ", ".join(
        f"struct('{label}' AS label, tp_{label} AS true_positive, "
        f"predicted_{label} - tp_{label} AS false_positive, "
        f"gold_{label} - tp_{label} AS false_negative)"
        for label in LABELS
    )
    return (
        cells.groupBy(*by)
        .agg(*_label_counts())
        .select(*by, F.expr(f"inline(array({per_label}))"))
        .withColumns(
            {
                "precision": _ratio("true_positive", "true_positive + false_positive", "p"),
                "recall": _ratio("true_positive", "true_positive + false_negative", "r"),
            }
        )
        .withColumn("f1", _ratio("2 * precision * recall", "precision + recall", "f1"))
    )


def metrics(cells: DataFrame, by: Sequence[str] = (), bins: int = DEFAULT_BINS) -> DataFrame:
    """All scalar metrics, unrounded, one row per ``by`` (exactly one without ``by``).

    ``bins`` must be the number the cells were made with; without bins there is no
    calibration error. ``unknown_gold`` counts rows whose gold label is outside the
    vocabulary; they are scored as wrong.
    """
    large = F.struct(
        F.col("latency_bin").alias("bin"),
        *[F.col(name).alias(f"part_{i}") for i, name in enumerate(_LARGE_SUMS)],
    )
    totals = cells.groupBy(*by).agg(
        _count("true", "examples"),
        _count(_CORRECT, "correct"),
        _count("prediction IS NULL", "invalid"),
        _count(f"NOT {_KNOWN}", "unknown_gold"),
        F.expr("coalesce(sum(flagged), 0)").alias("flagged"),
        F.expr(f"double(sum({_BRIER_UNITS})) / {4.0 * CONFIDENCE_UNIT}D").alias("brier"),
        F.expr(
            f"double(sum(latency_sum)) / {float(LATENCY_UNIT)}D + coalesce(sum(latency_special), 0D)"
        ).alias("small_latency"),
        F.collect_list(F.when(F.col("latency_bin").isNotNull(), large)).alias("large_latency"),
        *[F.expr(f"sum(IF(bin = {b}, {_GAP}, 0))").alias(f"gap_{b}") for b in range(bins)],
        *_label_counts(),
    )
    latency = F.col("small_latency") + exact_total_of("large_latency")
    scored = totals.withColumn("latency", latency).withColumns(
        {
            f"{name}_{label}": _ratio(f"tp_{label}", f"{of}_{label}", name)
            for label in LABELS
            for name, of in (("precision", "predicted"), ("recall", "gold"))
        }
    )
    f1 = " + ".join(
        _quotient(
            f"2 * precision_{label} * recall_{label}", f"precision_{label} + recall_{label}"
        )
        for label in LABELS
    )
    gap = " + ".join(f"abs(gap_{b})" for b in range(bins))
    calibration = _quotient(f"double({gap}) / {float(CONFIDENCE_UNIT)}D", "examples")
    return scored.select(
        *by,
        "examples",
        _ratio("correct", "examples", "accuracy"),
        F.expr(f"({f1}) / {float(len(LABELS))}D").alias("macro_f1"),
        F.expr(calibration if bins else "double(NULL)").alias("expected_calibration_error"),
        _ratio("brier", "examples", "brier_score"),
        _ratio("invalid", "examples", "invalid_label_rate"),
        _ratio("flagged", "examples", "hallucination_proxy_rate"),
        _ratio("latency", "examples", "mean_latency_ms"),
        "unknown_gold",
    )


#: The size of a sketch, and the share of the rows by which a quantile's rank may then be wrong,
#: whatever was merged: some seven standard deviations.
SKETCH_SIZE = 800
RANK_ERROR = 0.01


def latency_quantiles(
    cells: DataFrame, by: Sequence[str | Column] = (), ranks: Sequence[float] = (0.5, 0.95, 0.99)
) -> DataFrame:
    """``p50_latency_ms`` and so on, one row per ``by``, from the sketches of cells: of a window,
    a run, or of several merged into one. Null where no row has a latency."""
    names = [f"p{format(100 * rank, 'g').replace('.', '_')}_latency_ms" for rank in ranks]
    merged = cells.groupBy(*by).agg(F.kll_merge_agg_double("latency_sketch").alias("__sketch"))
    # A sketch without values has no quantiles to ask for.
    sketch = F.when(F.kll_sketch_get_n_double("__sketch") > 0, F.col("__sketch"))
    return merged.withColumn("__sketch", sketch).select(
        *merged.columns[:-1],
        *[
            F.kll_sketch_get_quantile_double("__sketch", F.lit(float(rank))).alias(name)
            for rank, name in zip(ranks, names)
        ],
    )


def rounded(metric_rows: DataFrame) -> DataFrame:
    """Metrics rounded as they are reported: 4 places, latency 2."""
    return metric_rows.withColumns(
        {
            name: round_exact(
                name, LATENCY_DIGITS if name == "mean_latency_ms" else METRIC_DIGITS
            )
            for name in METRICS
        }
    )


def _with_lift(metric_rows: DataFrame, baseline_accuracy: Column) -> DataFrame:
    """Add baseline accuracy and relative lift to unrounded metric rows.

    The reported lift compares the accuracies as reported, that is rounded;
    ``exact_accuracy_lift`` compares the unrounded ones.
    """
    # Each step is a column of its own: nested in one expression they would multiply.
    return (
        metric_rows.withColumn("__base", baseline_accuracy)
        .withColumns(
            {
                "baseline_accuracy": round_exact("__base", METRIC_DIGITS),
                "__reported": round_exact("accuracy", METRIC_DIGITS),
                "exact_accuracy_lift": _ratio("accuracy - __base", "__base", "lift"),
            }
        )
        .withColumn("__lift", _ratio("__reported - baseline_accuracy", "baseline_accuracy", "lift"))
        .withColumn("relative_accuracy_lift", round_exact("__lift", METRIC_DIGITS))
        .drop("__base", "__reported", "__lift")
    )


def with_baseline(metric_rows: DataFrame, baseline_row: DataFrame) -> DataFrame:
    """Compare metric rows with the one metric row of a separately evaluated baseline."""
    return _with_lift(metric_rows, baseline_row.select("accuracy").scalar())


def with_baseline_run(
    metric_rows: DataFrame, run: str, baseline: str, within: Sequence[str] = ()
) -> DataFrame:
    """Compare each run's metric row with that of the run named ``baseline``.

    ``within`` restricts the comparison to runs of, say, one experiment. Without a
    baseline run the lift is 0. Uses the rows twice, so their cells should be a table.
    """
    base = metric_rows.where(F.col(run) == F.lit(baseline))
    if within:
        bases = base.select(*within, F.col("accuracy").alias("__own_base"))
        joined = metric_rows.join(bases, list(within), "left")
        return _with_lift(joined, F.coalesce("__own_base", F.lit(0.0))).drop("__own_base")
    return _with_lift(metric_rows, F.coalesce(base.select("accuracy").scalar(), F.lit(0.0)))


def _confusion_counts(cells: DataFrame, by: Sequence[str]) -> DataFrame:
    """One column ``<gold>_<prediction>`` per entry of the matrix."""
    return cells.groupBy(*by).agg(
        *[
            _count(f"coalesce(label = '{g}' AND prediction = '{p}', false)", f"{g}_{p}")
            for g in LABELS
            for p in LABELS
        ]
    )


def confusion_matrix(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Dense ``(label, prediction, n)`` rows, zeros included, per ``by``.

    Unparseable predictions have no entry. Rows with an unknown gold label have none
    either; they fail the job where the cells are ``strict``.
    """
    entries = ", ".join(
        f"struct('{g}' AS label, '{p}' AS prediction, {g}_{p} AS n)" for g in LABELS for p in LABELS
    )
    counts = _confusion_counts(cells, by)
    return counts.select(*by, F.expr(f"inline(array({entries}))"))


def confusion_map(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The confusion matrix as one ``MAP<gold, MAP<prediction, n>>`` per ``by``."""
    rows = ", ".join(
        f"'{g}', map(" + ", ".join(f"'{p}', {g}_{p}" for p in LABELS) + ")" for g in LABELS
    )
    counts = _confusion_counts(cells, by)
    return counts.select(*by, F.expr(f"map({rows})").alias("confusion_matrix"))


def label_distribution(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Number of input rows per lower-cased gold label, in or outside the vocabulary."""
    return df.groupBy(*by, _gold().alias("label")).agg(F.count("*").alias("n"))


def calibration_bins(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per non-empty confidence bin: rows, accuracy and mean confidence."""
    sums = cells.groupBy(*by, "bin").agg(
        F.sum("n").alias("n"),
        _count(_CORRECT, "correct"),
        F.expr(f"double(sum(confidence_sum)) / {float(CONFIDENCE_UNIT)}D").alias("sum"),
    )
    return sums.select(
        *by,
        "bin",
        "n",
        _ratio("correct", "n", "accuracy"),
        _ratio("sum", "n", "confidence"),
    )


def dominant_confusions(
    cells: DataFrame, by: Sequence[str] = (), k: int | None = None
) -> DataFrame:
    """Off-diagonal confusion entries, ranked by size within ``by``; the top ``k`` of them."""
    wrong = confusion_matrix(cells, by).where(F.col("label") != F.col("prediction"))
    order = Window.partitionBy(*by).orderBy(F.col("n").desc(), "label", "prediction")
    ranked = wrong.withColumn("rank", F.row_number().over(order))
    return ranked if k is None else ranked.where(F.col("rank") <= k)


def failure_examples(df: DataFrame, order_by: str = "id", n: int | None = None) -> DataFrame:
    """Input rows whose prediction is unparseable or flagged; the first ``n`` if given."""
    names = df.columns
    low, label = F.col("__low"), F.col("__label")
    staged = (
        df.withColumn("__low", F.lower(F.col("prediction").cast("string")))
        .withColumn("__words", label_words(low))
        .withColumn("__label", label_from_words(low, F.col("__words")))
    )
    # A filter would be pushed below these projections and parse each text again; a generator of
    # one row or none stays above.
    bad = label.isNull() | has_unsupported_token(low)
    failed = staged.select(*names, F.explode(F.when(bad, F.array(label.isNull()))).alias("invalid"))
    return failed if n is None else failed.orderBy(order_by).limit(n)


def acceptance_gates(
    compared: DataFrame,
    run: str,
    tuned: str,
    preference_tuned: str,
    min_lift: float = 0.20,
    min_runs: int = 50,
) -> DataFrame:
    """One row of pass/fail gates over compared run metrics.

    Lift of every tuned run is at least ``min_lift``, no invalid labels in them, lower
    calibration error after preference tuning than before, and enough runs.
    """
    name = F.col(run)
    final = name.isin(tuned, preference_tuned)
    error = F.col("expected_calibration_error")
    return compared.agg(
        F.coalesce(
            F.min(F.when(final, F.col("relative_accuracy_lift"))) >= min_lift, F.lit(False)
        ).alias("lift_reached"),
        F.coalesce(F.max(F.when(final, F.col("invalid_label_rate"))) == 0.0, F.lit(False)).alias(
            "format_valid"
        ),
        F.coalesce(
            F.max(F.when(name == preference_tuned, error)) < F.max(F.when(name == tuned, error)),
            F.lit(False),
        ).alias("calibration_improved"),
        (F.count("*") >= min_runs).alias("enough_runs"),
    )
