"""Naive Bayes against the same sums in plain Python."""

import math
import random
import re
from collections import Counter

import pytest

from assayer.functions.vocabulary import LABELS
from assayer.operators import bayes

SCHEMA = "id string, text string, label string, word string, row int, n int"


def words(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def brute(train, test, smoothing=1.0):
    known = [(t, label) for t, label in train if label in LABELS]
    counts = {label: Counter() for label in LABELS}
    for text, label in known:
        counts[label].update(words(text))
    vocabulary = {w for c in counts.values() for w in c}
    total = {label: sum(counts[label].values()) + smoothing * len(vocabulary) for label in LABELS}
    rows = Counter(label for _, label in known)

    def units(x):
        return round(math.log(x) * 10**6)

    out = []
    for key, text, label in test:
        scores = []
        for own in LABELS:
            score = units((rows[own] + smoothing) / (len(known) + smoothing * len(LABELS)))
            score += sum(
                units((counts[own][w] + smoothing) / total[own]) for w in words(text) if w in vocabulary
            )
            scores.append(score)
        best = max(scores)
        confidence = 1 / sum(math.exp((s - best) / 10**6) for s in scores)
        out.append((key, label, LABELS[scores.index(best)], round(confidence, 9)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def scored(spark):
    def frame(rows):
        return spark.createDataFrame([(*r, "x", None, 1) for r in rows], SCHEMA).repartition(4)

    def run(train, test):
        model = bayes.fit_naive_bayes(frame([("t", *r) for r in train]))
        found = bayes.score_naive_bayes(model, frame(test)).collect()
        return sorted(
            ((r["id"], r["label"], r["prediction"], round(r["confidence"], 9)) for r in found), key=str
        )

    return run


def text_of(rng, label, n):
    shared, own = [f"w{i}" for i in range(200)], [f"{label[:3]}{i}" for i in range(40)]
    return " ".join(rng.choice(own if rng.random() < 0.3 else shared) for _ in range(n))


def test_equals_plain_sums(scored):
    rng = random.Random(1)
    train = [(text_of(rng, label, rng.randint(0, 40)), label) for label in LABELS for _ in range(60)]
    train += [(None, "neutral"), ("", "negative"), ("x y", None), ("x y", "unsure"), train[0], train[0]]
    test = [(str(i), text_of(rng, LABELS[i % 3], i), LABELS[i % 3]) for i in range(50)]
    test += [("n", None, None), ("e", "", "odd"), ("e", "unmet Unmet", "odd"), (None, "W1 w1", "positive")]
    test += [test[3], test[3], ("long", "w1 " * 100_000 + "neu1", "neutral")]
    found = scored(train, test)
    assert found == brute(train, test)
    right = [r for r in found if r[1] in LABELS]
    assert sum(r[1] == r[2] for r in right) > 0.8 * len(right)


def test_one_word_on_a_third_of_all_places(scored):
    rng = random.Random(2)
    train = [(text_of(rng, label, 10) + " the" * 5, label) for label in LABELS for _ in range(20)]
    test = [(str(i), text_of(rng, LABELS[i % 3], 10) + " the" * 5, LABELS[i % 3]) for i in range(30)]
    assert scored(train, test) == brute(train, test)


def test_rare_words_are_joined(spark, scored, monkeypatch):
    monkeypatch.setattr(bayes, "COMMON_WORDS", 20)
    rng = random.Random(3)
    train = [(text_of(rng, label, 30) + " the the", label) for label in LABELS for _ in range(20)]
    test = [(str(i), text_of(rng, LABELS[i % 3], 30) + " the", LABELS[i % 3]) for i in range(20)]
    assert scored(train, test) == brute(train, test)
    frame = spark.createDataFrame([("a", *r) for r in train], "id string, text string, label string")
    common = bayes.fit_naive_bayes(frame).words.where("common").collect()
    assert 1 <= len(common) <= 20 and "the" in {r["word"] for r in common}


def test_ties_and_empty_tables(scored):
    assert scored([], [("1", "a b", "neutral")]) == [("1", "neutral", LABELS[0], 0.333333333)]
    train = [("same", label) for label in LABELS]
    assert scored(train, [("1", "same", "x")]) == brute(train, [("1", "same", "x")])
    assert scored(train, []) == []


def test_scores_do_not_depend_on_partitions(spark):
    rng = random.Random(4)
    rows = [(str(i), text_of(rng, LABELS[i % 3], 30), LABELS[i % 3]) for i in range(90)]
    frame = spark.createDataFrame(rows, "id string, text string, label string")
    found = []
    for parts in (1, 7):
        dealt = frame.repartition(parts)
        scored = bayes.score_naive_bayes(bayes.fit_naive_bayes(dealt), dealt)
        found.append(sorted(map(tuple, scored.collect())))
    assert found[0] == found[1]
