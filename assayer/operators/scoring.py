"""Scoring rows with a model, one prediction record per row."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import require_label
from ..functions.numeric import round_exact, sequence_confidence
from ..functions.text import coalesce_text, format_prompt, parse_or_raw, parse_prediction, strip
from ..functions.vocabulary import METRIC_DIGITS
from .records import gold_label, text_candidates

# A scorer takes texts and returns a (completion, confidence) pair for each. Its
# factory runs on the executors, once per task; a factory that caches what it loads
# (functools.cache) loads it once per Python worker. A factory from a module needs that
# module on the executors (--py-files); one made inside a function is sent by value.
Scorer = Callable[[Sequence[str]], Iterable[tuple[str, float]]]
ScorerFactory = Callable[[], Scorer]

PREDICTION_COLUMNS = ("id", "label", "prediction", "confidence", "latency_ms")


#: Characters that a scorer gets at once, each text counted as long as the longest: what a
#: model pads them to. A longer text comes alone.
BATCH_CHARS = 1 << 22


def length_batcher() -> Callable[[Sequence[int], int], list[list[int]]]:
    """A function that deals places of texts, by their lengths, into batches of about equal
    lengths, each within a budget or of one text.

    Made inside a function, so that Spark ships it by value.
    """

    def deal(lengths: Sequence[int], budget: int) -> list[list[int]]:
        batches: list[list[int]] = []
        for place in sorted(range(len(lengths)), key=lengths.__getitem__):
            # In ascending order the newest text is the longest of its batch.
            if batches and (len(batches[-1]) + 1) * lengths[place] <= budget:
                batches[-1].append(place)
            else:
                batches.append([place])
        return batches

    return deal


def _complete(
    df: DataFrame,
    factory: ScorerFactory,
    input_col: str,
    partitions: int | None,
    batch_chars: int = BATCH_CHARS,
) -> DataFrame:
    """Replace ``input_col`` by the scorer's completion, confidence and latency.

    The rows that Spark hands over at once are scored in batches by length; they come back in
    the order that they had.
    """
    deal = length_batcher()
    if partitions:
        df = df.repartition(partitions)
    kept = [c for c in df.columns if c != input_col]
    schema = ", ".join(
        [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept]
        + ["completion string", "confidence double", "latency_ms double"]
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from time import perf_counter

        scorer = factory()
        for batch in batches:
            texts = batch[input_col].tolist()
            found = [None] * len(texts)
            for places in deal([len(text or "") for text in texts], batch_chars):
                started = perf_counter()
                pairs = list(scorer([texts[place] for place in places]))
                elapsed_ms = (perf_counter() - started) * 1000
                if len(pairs) != len(places):
                    raise ValueError(f"scorer returned {len(pairs)} results for {len(places)} texts")
                for place, (completion, confidence) in zip(places, pairs):
                    found[place] = completion, float(confidence), round(elapsed_ms / len(places), 2)
            out = batch[kept].copy()
            for i, name in enumerate(("completion", "confidence", "latency_ms")):
                out[name] = [row[i] for row in found]
            yield out

    return df.mapInPandas(run, schema)


def score_records(
    df: DataFrame,
    factory: ScorerFactory,
    normalize_gold: bool = True,
    prompts: bool = True,
    partitions: int | None = None,
    batch_chars: int = BATCH_CHARS,
) -> DataFrame:
    """``(id, label, prediction, confidence, latency_ms)`` for labeled rows.

    The scorer sees prompts, or plain stripped texts with ``prompts=False``. Prompting,
    label checks and parsing stay in Spark; only the scorer itself runs in Python.
    Rows with blank text are scored too. Without ``normalize_gold`` the gold label
    passes through unchanged. ``partitions`` spreads the rows evenly over that many
    tasks first, for models that cost more than moving the texts. The scorer gets texts of about
    equal lengths, ``batch_chars`` at a time.
    """
    text = coalesce_text(*text_candidates(df))
    label = F.col("label").cast("string")
    gold = gold_label(df) if normalize_gold else None
    scored = _complete(
        df.select(
            F.col("id").cast("string").alias("id"),
            (require_label(gold, label) if normalize_gold else label).alias(
                "label"
            ),
            (format_prompt(text) if prompts else text).alias("input"),
        ),
        factory,
        "input",
        partitions,
        batch_chars,
    )
    prediction = parse_or_raw(F.col("completion")).alias("prediction")
    return scored.select("id", "label", prediction, "confidence", "latency_ms")


def service_predictions(
    df: DataFrame,
    factory: ScorerFactory,
    backend: str,
    model: str,
    keep: Sequence[str] = (),
    prompts: bool = True,
    partitions: int | None = None,
    batch_chars: int = BATCH_CHARS,
) -> DataFrame:
    """``keep`` plus ``(label, raw, confidence, latency_ms, backend, model)`` per text.

    ``label`` is null when the completion cannot be parsed.
    """
    text = F.col("text")
    scored = _complete(
        df.select(*keep, (format_prompt(text) if prompts else text).alias("input")),
        factory,
        "input",
        partitions,
        batch_chars,
    )
    return scored.select(
        *keep,
        parse_prediction(F.col("completion")).alias("label"),
        strip(F.col("completion")).alias("raw"),
        "confidence",
        "latency_ms",
        F.lit(backend).alias("backend"),
        F.lit(model).alias("model"),
    )


def with_sequence_confidence(
    df: DataFrame, step_scores: str, chosen_ids: str, name: str = "confidence"
) -> DataFrame:
    """Add the confidence of generated sequences, rounded as it is stored.

    ``step_scores`` holds one array of scores per generated step, ``chosen_ids`` the
    0-based index of the token each step chose.
    """
    scored = df.withColumn(name, sequence_confidence(F.col(step_scores), F.col(chosen_ids)))
    return scored.withColumn(name, round_exact(name, METRIC_DIGITS))


def external_baseline(df: DataFrame, completion: str = "completion") -> DataFrame:
    """Prediction records from completions another system has produced.

    Gold labels pass through unchanged and every confidence is 1.
    """
    raw = F.coalesce(F.col(completion), F.lit(""))
    latency = F.col("latency_ms") if "latency_ms" in df.columns else F.lit(0.0)
    return df.select(
        F.col("id").cast("string").alias("id"),
        "label",
        parse_or_raw(raw).alias("prediction"),
        F.lit(1.0).alias("confidence"),
        latency.cast("double").alias("latency_ms"),
    )


def rule_label(text: Column) -> Column:
    """Deterministic rule standing in for a model: profit is positive, all else negative."""
    return F.when(F.contains(F.lower(text), F.lit("profit")), F.lit("positive")).otherwise(
        F.lit("negative")
    )


def rule_predictions(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Service predictions of :func:`rule_label`, with its fixed confidence and latency."""
    return df.select(*keep, rule_label(F.col("text")).alias("label")).select(
        *keep,
        "label",
        F.col("label").alias("raw"),
        F.lit(0.9).alias("confidence"),
        F.lit(1.0).alias("latency_ms"),
        F.lit("fake").alias("backend"),
        F.lit("fake-model").alias("model"),
    )


def lexical_predictions(
    df: DataFrame, negative_cues: Sequence[str], positive_cues: Sequence[str]
) -> DataFrame:
    """Deterministic lexical baseline: the side with more cue words wins, a tie is neutral.

    Confidence is the winning side's share of the cue words; 1 for a text without any.
    """
    words = F.split(F.lower(F.col("text")), r"[^\p{L}\p{N}]+")

    def hits(cues: Sequence[str]) -> Column:
        return F.size(F.filter(F.col("__words"), lambda w: w.isin(*cues)))

    negative, positive = F.col("__negative"), F.col("__positive")
    total = negative + positive
    share = F.greatest(negative, positive) / F.when(total > 0, total)
    return (
        df.select("id", "label", words.alias("__words"))
        .select(
            "id",
            "label",
            hits(negative_cues).alias("__negative"),
            hits(positive_cues).alias("__positive"),
        )
        .select(
            F.col("id").cast("string").alias("id"),
            "label",
            F.when(negative > positive, "negative")
            .when(positive > negative, "positive")
            .otherwise("neutral")
            .alias("prediction"),
            F.coalesce(share, F.lit(1.0)).alias("confidence"),
            F.lit(0.0).alias("latency_ms"),
        )
    )
