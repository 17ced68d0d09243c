import math
import random

import pytest
from pyspark.sql import functions as F

from assayer import functions as fn
from assayer.operators.scoring import with_sequence_confidence
from assayer.functions.text import has_unsupported_token, label_from_words, label_words
from assayer.functions.vocabulary import WHITESPACE

from . import model


def column(spark, values, kind):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def mapped(df, expression):
    return [r["r"] for r in df.select("i", expression.alias("r")).orderBy("i").collect()]


def adversarial_strings(n, seed=1):
    rng = random.Random(seed)
    pieces = [
        *model.LABELS, "Positive", "NEUTRAL", "bullish", "mixed", "bearish", "buy", "sell", ".",
        ",", "not", "é", "İ", "​", *WHITESPACE,
    ]
    return ["".join(rng.choices(pieces, k=rng.randrange(0, 6))) for _ in range(n)]


PARSE = {
    "The label is positive": "positive",
    "buy": None,
    " POSITIVE\n": "positive",
    "positive.": None,
    "positive positive": "positive",
    "positive negative": None,
    "not positive": "positive",
    "positive buy": "positive",
    "positive, buy": None,
    "label:\x85negative": "negative",
    "": None,
    "   ": None,
    None: None,
}


def test_whitespace_is_the_set_python_strips():
    assert set(WHITESPACE) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


def test_parse_prediction_table(spark):
    df = column(spark, list(PARSE), "string")
    assert mapped(df, fn.parse_prediction(F.col("v"))) == list(PARSE.values())


def test_text_rules_on_adversarial_strings(spark):
    texts = adversarial_strings(3000)
    df = column(spark, texts, "string")
    v = F.col("v")
    assert mapped(df, fn.strip(v)) == [t.strip() for t in texts]
    assert mapped(df, fn.parse_prediction(v)) == [model.parse(t) for t in texts]
    low = df.withColumn("v", F.lower("v")).withColumn("words", label_words(F.col("v")))
    parsed = label_from_words(v, F.col("words"))
    assert mapped(low, parsed) == [model.parse(t) for t in texts]
    flags = [model.parse(t) is None or "buy" in t.lower() or "sell" in t.lower() for t in texts]
    assert mapped(df, fn.unsupported_flag(v)) == flags
    staged = F.col("parsed").isNull() | has_unsupported_token(v)
    assert mapped(low.withColumn("parsed", parsed), staged) == flags
    assert mapped(df, fn.normalize_label(v)) == [model.normalize(t) for t in texts]
    assert mapped(df, fn.parse_or_raw(v)) == [model.parse(t) or t.strip() for t in texts]


def test_unsupported_flag_covers_unparseable(spark):
    df = column(spark, ["positive buy", "positive, buy", "positive", "Price Target up", None],
                "string")
    assert mapped(df, fn.unsupported_flag(F.col("v"))) == [True, True, False, True, True]


def test_coalesce_text(spark):
    rows = [("", "x"), ("  ", "x"), (None, None), (" a ", "b"), (None, "　y\x1c")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, b string")
    assert mapped(df, fn.coalesce_text(F.col("a"), F.col("b"))) == ["x", "", "", "a", "y"]


def test_prompt(spark):
    df = column(spark, [" Costs rose. \n"], "string")
    assert mapped(df, fn.format_prompt(F.col("v"))) == [
        "Classify the financial sentiment as negative, neutral, or positive.\n"
        "Text: Costs rose.\nLabel:"
    ]


def test_label_codes_and_rejected(spark):
    df = column(spark, [0, 1, 2, 3, -1, None], "int")
    assert mapped(df, fn.label_from_code(F.col("v"))) == [*model.LABELS, None, None, None]
    df = column(spark, list(model.LABELS), "string")
    assert mapped(df, fn.rejected_label(F.col("v"))) == ["neutral", "negative", "negative"]


def test_require_label_fails_the_job(spark):
    df = column(spark, ["unsure"], "string")
    with pytest.raises(Exception, match="Unsupported label: unsure"):
        mapped(df, fn.require_label(fn.normalize_label(F.col("v")), F.col("v")))


def test_clamp_confidence(spark):
    values = [-0.1, 0.0, 0.5, 1.0, 1.7, math.nan, math.inf, -math.inf, None]
    assert mapped(column(spark, values, "double"), fn.clamp_confidence(F.col("v"))) == [
        0.0, 0.0, 0.5, 1.0, 1.0, 0.0, 0.0, 0.0, 0.0,
    ]


@pytest.mark.parametrize("bins", [1, 3, 7, 10, 15, 100])
def test_confidence_bin_edges(spark, bins):
    edges = [k / bins for k in range(bins + 1)]
    near = [math.nextafter(e, d) for e in edges for d in (-1, 2)]
    rng = random.Random(bins)
    values = [v for v in edges + near + [rng.random() for _ in range(500)] if 0 <= v <= 1]
    found = mapped(column(spark, values, "double"), fn.confidence_bin(F.col("v"), bins))
    assert found == [model.bin_of(v, bins) for v in values]


def test_confidence_bin_table(spark):
    df = column(spark, [0.0, 0.3, 0.8999999999999999, 0.9, 1.0], "double")
    assert mapped(df, fn.confidence_bin(F.col("v"))) == [0, 3, 8, 9, 9]


def test_brier_term(spark):
    rows = [("positive", "positive"), ("positive", "neutral"), ("positive", None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, g string, p string")
    found = mapped(df, fn.brier_term(F.col("g"), F.col("p"), F.lit(0.6)))
    assert found == pytest.approx([0.24, 1.04, 0.72], abs=1e-12)


def test_round_exact_equals_python_round(spark):
    rng = random.Random(3)
    values = [0.03125, 0.00005, 0.00015, 0.17875, 0.33875, 2.1869085, -0.33875, -1.00005, 0.0, 1.0]
    values += [rng.randrange(2**20) / 2 ** rng.randrange(5, 21) for _ in range(4000)]
    values += [rng.randrange(60000) / 60000 for _ in range(4000)]
    values += [rng.randrange(-30000, 30000) / 20000 for _ in range(4000)]
    values += [rng.uniform(-1e5, 1e5) for _ in range(2000)]
    df = column(spark, values, "double")
    for digits in (2, 4):
        assert mapped(df, fn.round_exact("v", digits)) == [
            round(v, digits) for v in values
        ]


def test_round_exact_passes_special_values(spark):
    df = column(spark, [math.inf, -math.inf, None, 1e9 + 0.125], "double")
    assert mapped(df, fn.round_exact("v", 2)) == [math.inf, -math.inf, None, 1e9 + 0.12]
    assert math.isnan(mapped(column(spark, [math.nan], "double"), fn.round_exact("v", 2))[0])


def softmax(scores, k):
    weights = [math.exp(s - max(scores)) for s in scores]
    return weights[k] / sum(weights)


def test_sequence_confidence(spark):
    steps = [[1.0, 2.0, 0.5], [1000.0, 0.0, 999.0], [-3.0, -3.0, -3.0]]
    rows = [(0, steps, [1, 0, 2]), (1, [], []), (2, steps, [0]), (3, None, None)]
    df = spark.createDataFrame(rows, "i int, s array<array<double>>, c array<int>")
    expected = round(sum(softmax(s, k) for s, k in zip(steps, [1, 0, 2])) / 3, 4)
    found = mapped(with_sequence_confidence(df, "s", "c"), F.col("confidence"))
    assert found == [expected, 0.0, round(softmax(steps[0], 0), 4), 0.0]


def test_rounding_equals_python_at_every_magnitude(spark):
    import random

    from assayer.functions import round_exact

    rng = random.Random(4)
    values = [s * (rng.randrange(10 ** e) + rng.choice([0.005, 0.015, 0.5, 0.125, rng.random()]))
              for e in range(1, 16) for s in (1, -1) for _ in range(60)]
    values += [2.0**17 + 0.005, 2.0**46, 1e15 + 0.5, 1e300, -1e300, 0.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for digits in (2, 4):
        found = [r[0] for r in df.select(round_exact("x", digits)).collect()]
        assert [(v, f) for v, f in zip(values, found) if f != round(v, digits)] == []


def test_a_token_outside_its_scores_is_an_error(spark):
    for scores, chosen in (([[1.0, 2.0]], [7]), ([[1.0, None]], [1]), ([[1.0, 2.0]], [-1])):
        df = spark.createDataFrame([(scores, chosen)], "s array<array<double>>, c array<int>")
        with pytest.raises(Exception, match="outside the scores"):
            with_sequence_confidence(df, "s", "c").collect()
