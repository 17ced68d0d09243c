"""Multinomial naive Bayes in closed form: one aggregate trains it, joins score with it.

The model is a table with a row per word. Log weights are whole millionths, so a text's scores
are exact sums: they depend neither on the partitioning nor on the order of its words.

Defined results: a null text has no words and is scored by the priors; words that training did
not meet count for no label; training rows whose label is outside the vocabulary are left
out; equal scores go to the first label of the vocabulary; without training rows all labels
have equal priors. Repeated rows are scored each.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import label_array
from ..functions.vocabulary import LABELS
from ..session import written

#: Log weights count units of 1e-6.
WEIGHT_UNIT = 10**6
#: Words with at least one in so many training words are common; there are at most so many.
COMMON_WORDS = 4_096


def text_words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    words = F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.filter(words, lambda w: w != "")


def _units(x: Column) -> Column:
    return F.rint(F.ln(x) * float(WEIGHT_UNIT)).cast("bigint")


@dataclass(frozen=True)
class NaiveBayes:
    """``words`` has ``word, common, weights``: the log weight per label, in vocabulary order."""

    words: DataFrame
    priors: tuple[int, ...]


def fit_naive_bayes(train: DataFrame, smoothing: float = 1.0) -> NaiveBayes:
    """Fit on ``(text, label)`` records with additive smoothing.

    One shuffle, of the number of each word per label; its size is that of the vocabulary, since
    tasks add up their own numbers first.
    """
    known = train.where(F.col("label").isin(*LABELS))
    per_label = [
        F.count(F.when(F.col("label") == label, True)).alias(f"n_{i}")
        for i, label in enumerate(LABELS)
    ]
    sums = [F.sum(f"n_{i}").alias(f"n_{i}") for i in range(len(LABELS))]
    rows = known.agg(*per_label).first()
    counts = written(
        known.select("label", F.explode(text_words(F.col("text"))).alias("word"))
        .groupBy("word")
        .agg(*per_label),
        "word-counts",
    )
    totals = counts.agg(F.count("*").alias("words"), *sums).first()
    n = [totals[f"n_{i}"] or 0 for i in range(len(LABELS))]
    weights = [
        _units((F.col(f"n_{i}") + smoothing) / F.lit(n[i] + smoothing * totals["words"]))
        for i in range(len(LABELS))
    ]
    own = sum(F.col(f"n_{i}") for i in range(len(LABELS)))
    common = own * F.lit(COMMON_WORDS) >= F.lit(sum(n))
    words = counts.select("word", common.alias("common"), F.array(*weights).alias("weights"))
    return NaiveBayes(words, _priors([rows[f"n_{i}"] for i in range(len(LABELS))], smoothing))


def _priors(rows: list[int], smoothing: float) -> tuple[int, ...]:
    total = sum(rows) + smoothing * len(rows)
    return tuple(round(math.log((n + smoothing) / total) * WEIGHT_UNIT) for n in rows)


def score_naive_bayes(model: NaiveBayes, records: DataFrame) -> DataFrame:
    """Prediction records of ``(id, text, label)``: the most probable label and its probability.

    Words go to the model's rows: common ones, a bounded number, are broadcast and so cost no
    shuffle, though they make up most of a text; each of the others has less than one word in
    ``COMMON_WORDS``, so no key of their join is hot.
    """
    numbered = written(
        records.select(
            F.monotonically_increasing_id().alias("row"),
            F.col("id").cast("string").alias("id"),
            "label",
            text_words(F.col("text")).alias("words"),
        ),
        "texts-to-score",
    )
    words = numbered.select("row", F.explode("words").alias("word")).groupBy("row", "word").agg(
        F.count("*").alias("n")
    )
    common = model.words.where("common").select("word", F.col("weights").alias("known"))
    # At most COMMON_WORDS rows.
    split = words.join(F.broadcast(common), "word", "left")
    rare = (
        split.where("known is null")
        .select("row", "word", "n")
        .join(model.words.where("not common").select("word", F.col("weights").alias("known")), "word")
    )
    found = split.where("known is not null").select("row", "n", "known").union(
        rare.select("row", "n", "known")
    )
    names = [f"score_{i}" for i in range(len(LABELS))]
    sums = found.groupBy("row").agg(
        *[F.sum(F.col("n") * F.col("known")[i]).alias(name) for i, name in enumerate(names)]
    )
    scores = F.array(
        *[
            F.coalesce(F.col(name), F.lit(0).cast("bigint")) + F.lit(prior)
            for name, prior in zip(names, model.priors)
        ]
    )
    rows = numbered.select("row", "id", "label").join(sums, "row", "left")
    best = F.array_max("scores")
    odds = F.aggregate(
        "scores",
        F.lit(0.0),
        lambda total, s: total + F.exp((s - best).cast("double") / float(WEIGHT_UNIT)),
    )
    return rows.select("id", "label", scores.alias("scores")).select(
        "id",
        "label",
        F.element_at(label_array(), F.array_position("scores", best).cast("int")).alias("prediction"),
        (1.0 / odds).alias("confidence"),
        F.lit(0.0).alias("latency_ms"),
    )
