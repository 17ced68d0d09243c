import json
import math
import random

import pytest
from pyspark.sql import functions as F

from assayer.operators import evaluation as ev
from assayer.plans import evaluate, evaluate_runs, report
from assayer.sources.schemas import PREDICTION

from . import model

PREDICTIONS = [
    ("positive", "positive", 0.91, 42.0), ("negative", "negative", 0.88, 39.0),
    ("neutral", "neutral", 0.74, 41.0), ("positive", "positive", 0.86, 43.0),
    ("negative", "negative", 0.92, 45.0), ("neutral", "positive", 0.56, 40.0),
    ("positive", "positive", 0.89, 44.0), ("negative", "negative", 0.93, 46.0),
]
BASELINE = [
    ("positive", "positive", 0.82, 2200.0), ("negative", "neutral", 0.54, 2100.0),
    ("neutral", "neutral", 0.67, 2050.0), ("positive", "positive", 0.71, 2300.0),
    ("negative", "negative", 0.73, 2250.0), ("neutral", "neutral", 0.63, 2150.0),
    ("positive", "neutral", 0.52, 2190.0), ("negative", "negative", 0.79, 2260.0),
]
TUNED_3 = [
    ("positive", "positive", 0.9, 10.0), ("negative", "negative", 0.8, 20.0),
    ("neutral", "positive", 0.6, 30.0),
]
BASELINE_3 = [
    ("positive", "neutral", 0.4, 100.0), ("negative", "negative", 0.8, 100.0),
    ("neutral", "positive", 0.6, 100.0),
]


def frame(spark, rows):
    return spark.createDataFrame([(f"r{i}", *r) for i, r in enumerate(rows)], PREDICTION)


def check(row, expected):
    names = dict(
        accuracy="accuracy", macro_f1="macro_f1", ece="expected_calibration_error",
        brier="brier_score", invalid="invalid_label_rate", flagged="hallucination_proxy_rate",
        latency="mean_latency_ms",
    )
    for short, value in expected.items():
        assert row[names[short]] == pytest.approx(value, abs=1e-9), short


GOLDEN = [
    (PREDICTIONS, dict(accuracy=0.875, macro_f1=0.8412698412698413, ece=0.17875,
                       brier=0.14625625, invalid=0, flagged=0, latency=42.5)),
    (BASELINE, dict(accuracy=0.75, macro_f1=0.7555555555555555, ece=0.33875,
                    brier=0.32024375, invalid=0, flagged=0, latency=2187.5)),
    (TUNED_3, dict(accuracy=2 / 3, macro_f1=0.5555555555555555, ece=0.3,
                   brier=0.37166666666666665, invalid=0, flagged=0, latency=20)),
    (BASELINE_3, dict(accuracy=1 / 3, macro_f1=1 / 3, ece=0.4,
                      brier=0.6133333333333334, invalid=0, flagged=0, latency=100)),
]


@pytest.mark.parametrize("rows,expected", GOLDEN)
def test_golden_values(spark, rows, expected):
    row = evaluate(frame(spark, rows)).first()
    assert row["examples"] == len(rows) and row["unknown_gold"] == 0
    check(row, expected)
    check(row, model.evaluate(rows))


def test_lift_uses_rounded_accuracies(spark):
    row = evaluate(frame(spark, TUNED_3), frame(spark, BASELINE_3)).first()
    assert row["relative_accuracy_lift"] == 1.0003
    assert row["exact_accuracy_lift"] == pytest.approx(1.0)
    assert row["baseline_accuracy"] == 0.3333
    row = ev.rounded(evaluate(frame(spark, PREDICTIONS), frame(spark, BASELINE))).first()
    assert row["relative_accuracy_lift"] == 0.1667
    assert row["accuracy"] == 0.875 and row["mean_latency_ms"] == 42.5


def test_empty_input(spark):
    empty = frame(spark, [])
    cells = ev.evaluation_cells(empty)
    row = evaluate(empty, empty).first()
    assert row["examples"] == 0
    check(row, model.evaluate([]))
    assert row["relative_accuracy_lift"] == 0.0
    matrix = ev.confusion_matrix(cells).collect()
    assert len(matrix) == 9 and not any(r["n"] for r in matrix)
    assert ev.label_distribution(empty).count() == 0


def random_rows(n, seed):
    rng = random.Random(seed)
    raws = ["positive", "negative", "neutral", "The label is neutral", " POSITIVE ", "neutral.",
            "buy", "positive, buy", "positive buy", "positive negative", "", None, "Price Target"]
    golds = ["positive", "negative", "neutral", "NEUTRAL", "bullish", "Positive "]
    values = [lambda: rng.uniform(-0.2, 1.2), lambda: rng.randrange(11) / 10,
              lambda: math.nan, lambda: math.inf, lambda: None]
    return [
        (rng.choice(golds), rng.choice(raws),
         rng.choices(values, [8, 4, 1, 1, 1])[0](), rng.uniform(0, 5000))
        for _ in range(n)
    ]


@pytest.mark.parametrize("seed,bins", [(1, 10), (2, 10), (3, 15), (4, 1)])
def test_random_sets_equal_the_model(spark, seed, bins):
    rows = random_rows(700, seed)
    row = evaluate(frame(spark, rows), bins=bins).first()
    check(row, model.evaluate(rows, bins))
    assert row["unknown_gold"] == sum(g.lower() not in model.LABELS for g, *_ in rows)


def test_cells_do_not_depend_on_partitioning(spark):
    df = frame(spark, random_rows(2000, 9))
    once = sorted(map(str, ev.evaluation_cells(df.repartition(1)).collect()))
    again = sorted(map(str, ev.evaluation_cells(df.repartition(37)).collect()))
    assert once == again


def test_confusion_and_class_scores(spark):
    rows = random_rows(900, 5)
    cells = ev.evaluation_cells(frame(spark, rows)).cache()
    found = {(r["label"], r["prediction"]): r["n"] for r in ev.confusion_matrix(cells).collect()}
    expected = {(g, p): 0 for g in model.LABELS for p in model.LABELS}
    for g, raw, *_ in rows:
        if (g.lower(), model.parse(raw)) in expected:
            expected[g.lower(), model.parse(raw)] += 1
    assert found == expected
    scores = {r["label"]: r for r in ev.class_scores(cells).collect()}
    assert list(scores) == list(model.LABELS)
    for label, r in scores.items():
        assert r["true_positive"] == expected[label, label]
        assert r["false_negative"] == sum(g.lower() == label for g, *_ in rows) - r["true_positive"]
        assert r["false_positive"] == (
            sum(model.parse(p) == label for _, p, *_ in rows) - r["true_positive"]
        )
    spelled = ev.label_distribution(frame(spark, rows))
    distribution = {r["label"]: r["n"] for r in spelled.collect()}
    assert sum(distribution.values()) == 900 and "positive " in distribution
    # every row is either in the matrix, unparseable, or has an unknown gold label
    row = ev.metrics(cells).first()
    unknown_parsed = cells.where(
        F.col("label").isNull() & F.col("prediction").isNotNull()
    ).agg(F.sum("n")).first()[0]
    assert sum(found.values()) + round(row["invalid_label_rate"] * 900) + unknown_parsed == 900


def test_strict_confusion_fails_on_unknown_gold(spark):
    rows = frame(spark, [("bullish", "positive", 0.5, 1.0)])
    cells = ev.evaluation_cells(rows)
    assert sum(r["n"] for r in ev.confusion_matrix(cells).collect()) == 0
    with pytest.raises(Exception, match="outside the vocabulary: bullish"):
        ev.confusion_matrix(ev.evaluation_cells(rows, strict=True)).collect()
    unparsed = ev.evaluation_cells(frame(spark, [("bullish", "buy", 0.5, 1.0)]), strict=True)
    assert sum(r["n"] for r in ev.confusion_matrix(unparsed).collect()) == 0


PUBLISHED = {
    "negative": ((102, 16, 7), 126), "neutral": ((11, 479, 72), 564),
    "positive": ((4, 73, 203), 280),
}


def test_published_confusion_matrix(spark):
    rows = []
    for gold, (predicted, total) in PUBLISHED.items():
        for p, n in zip(model.LABELS, predicted):
            rows += [(gold, p, 0.5, 1.0)] * n
        rows += [(gold, "?", 0.5, 1.0)] * (total - sum(predicted))
    base = [("neutral", "neutral", 1.0, 1.0)] * 246 + [("neutral", "?", 1.0, 1.0)] * 724
    row = evaluate(frame(spark, rows), frame(spark, base)).first()
    assert row["accuracy"] == pytest.approx(784 / 970, abs=1e-9)
    assert row["macro_f1"] == pytest.approx(0.8027386181051019, abs=1e-9)
    assert row["invalid_label_rate"] == pytest.approx(3 / 970, abs=1e-9)
    assert (row["baseline_accuracy"], row["relative_accuracy_lift"]) == (0.2536, 2.1869)
    top = ev.dominant_confusions(ev.evaluation_cells(frame(spark, rows)), k=2).collect()
    assert [(r["label"], r["prediction"], r["n"]) for r in top] == [
        ("positive", "neutral", 73), ("neutral", "positive", 72)
    ]


def test_runs_and_gates(spark):
    runs = {"base": BASELINE_3, "sft": TUNED_3, "dpo": PREDICTIONS}
    df = spark.createDataFrame(
        [(run, *r) for run, rows in runs.items() for r in rows],
        "run string, label string, prediction string, confidence double, latency_ms double",
    )
    rows = {r["run"]: r for r in evaluate_runs(df, "run", "base").collect()}
    for run, expected in runs.items():
        check(rows[run], model.evaluate(expected))
    assert rows["base"]["relative_accuracy_lift"] == 0.0
    assert rows["sft"]["relative_accuracy_lift"] == 1.0003
    gates = ev.acceptance_gates(evaluate_runs(df, "run", "base"), "run", "sft", "dpo").first()
    assert gates.asDict() == {
        "lift_reached": True, "format_valid": True, "calibration_improved": True,
        "enough_runs": False,
    }
    twice = df.withColumn("exp", F.lit("a")).union(
        df.where("run != 'base'").withColumn("exp", F.lit("b"))
    )
    within = {(r["exp"], r["run"]): r for r in evaluate_runs(twice, "run", "base", ["exp"]).collect()}
    assert len(within) == 5 and within["a", "sft"]["relative_accuracy_lift"] == 1.0003
    assert within["b", "sft"]["relative_accuracy_lift"] == 0.0
    missing = {r["run"]: r for r in evaluate_runs(df, "run", "none").collect()}
    assert all(r["relative_accuracy_lift"] == 0.0 for r in missing.values())


def test_special_latencies_propagate(spark):
    rows = [("positive", "positive", 0.5, math.inf), ("positive", "positive", 0.5, 1.0)]
    assert evaluate(frame(spark, rows)).first()["mean_latency_ms"] == math.inf
    rows[0] = ("positive", "positive", 0.5, 3e15)
    assert evaluate(frame(spark, rows)).first()["mean_latency_ms"] == 1.5e15 + 0.5
    rows[0] = ("positive", "positive", 0.5, math.nan)
    assert math.isnan(evaluate(frame(spark, rows)).first()["mean_latency_ms"])


def test_missing_columns_take_defaults(spark):
    df = spark.createDataFrame([("positive",)], "label string")
    row = evaluate(df).first()
    check(row, model.evaluate([("positive", None, None, 0.0)]))


def test_large_sums_stay_exact(spark):
    df = spark.range(3_000_000).select(
        F.lit("positive").alias("label"), F.lit("positive").alias("prediction"),
        F.lit(0.1).alias("confidence"), F.lit(0.1).alias("latency_ms"),
    )
    cell = ev.evaluation_cells(df).first()
    assert int(cell["confidence_sum"]) == 3_000_000 * 10**11
    assert int(cell["confidence_sq_sum"]) == 3_000_000 * 10**10
    assert int(cell["latency_sum"]) == 3_000_000 * 10**8


def test_report(spark, tmp_path):
    from assayer.sources import write_report

    rows = report(frame(spark, TUNED_3), frame(spark, BASELINE_3))
    write_report(rows, str(tmp_path / "report"))
    (part,) = (tmp_path / "report").glob("part-*")
    found = json.loads(part.read_text())
    assert found["examples"] == 3 and found["accuracy"] == 0.6667
    assert found["relative_accuracy_lift"] == 1.0003
    assert found["confusion_matrix"]["neutral"] == {"negative": 0, "neutral": 0, "positive": 1}
    assert found["label_distribution"] == {"negative": 1, "neutral": 1, "positive": 1}
    assert list(found) == [
        "examples", "accuracy", "macro_f1", "expected_calibration_error", "brier_score",
        "invalid_label_rate", "hallucination_proxy_rate", "mean_latency_ms", "unknown_gold",
        "confusion_matrix", "label_distribution", "baseline_accuracy", "relative_accuracy_lift",
    ]


def test_cells_do_not_grow_with_the_spellings(spark):
    rows = spark.range(20_000).selectExpr("concat('spelling ', id) AS label", "'positive' AS prediction")
    rows = rows.union(spark.sql("SELECT 'Positive', 'positive'"))
    assert ev.evaluation_cells(rows).count() == 2
    found = report(rows).first()
    assert found["examples"] == 20_001 and found["unknown_gold"] == 20_000
    assert found["label_distribution"] == {"positive": 1}
    assert ev.label_distribution(rows).count() == 20_001


def test_failure_examples(spark):
    df = frame(spark, [("positive", p, 0.5, 1.0) for p in ("positive", "buy", "positive buy", None)])
    rows = ev.failure_examples(df, "id").collect()
    assert sorted((r["id"], r["invalid"]) for r in rows) == [
        ("r1", True), ("r2", False), ("r3", True)
    ]
    assert ev.failure_examples(df, "id", 1).first()["id"] == "r1"


def test_cells_without_bins(spark):
    df = frame(spark, PREDICTIONS)
    row = ev.metrics(ev.evaluation_cells(df, bins=0), bins=0).first()
    expected = {k: v for k, v in model.evaluate(PREDICTIONS).items() if k != "ece"}
    check(row, expected)
    assert row["expected_calibration_error"] is None


def test_calibration_bins(spark):
    cells = ev.evaluation_cells(frame(spark, PREDICTIONS))
    found = {r["bin"]: (r["n"], r["accuracy"], round(r["confidence"], 12))
             for r in ev.calibration_bins(cells).collect()}
    assert found == {5: (1, 0.0, 0.56), 7: (1, 1.0, 0.74), 8: (3, 1.0, 0.876666666667),
                     9: (3, 1.0, 0.92)}


def test_latency_sums_have_room_for_many_large_rows(spark):
    rows = spark.range(2_000_000).selectExpr(
        "'positive' AS label", "'positive' AS prediction", "1.0D AS confidence",
        "IF(id % 2 = 0, 8.9e9D, -8.8e9D) AS latency_ms",
    )
    sums = {}
    for partitions in (3, 7):
        cell = ev.evaluation_cells(rows.repartition(partitions), bins=0).first()
        sums[partitions] = (int(cell["latency_sum"]), cell["latency_special"])
    assert set(sums.values()) == {(10**6 * 10**8 * ev.LATENCY_UNIT, None)}
    mean = ev.metrics(ev.evaluation_cells(rows, bins=0), bins=0).first()["mean_latency_ms"]
    assert mean == pytest.approx(5e7, rel=1e-15)


def test_latency_quantiles_of_merged_cells(spark):
    rows = spark.range(60_000).selectExpr(
        "'positive' AS label", "IF(id % 3 = 0, 'neutral', 'positive') AS prediction",
        "id % 10 / 10 AS confidence", "id % 7 AS day",
        "CASE WHEN id % 1000 = 1 THEN double('NaN') ELSE pmod(xxhash64(id), 100000) / 7 END AS latency_ms",
    )
    known = rows.where("not isnan(latency_ms)")
    for partitions in (3, 19):
        cells = ev.evaluation_cells(rows.repartition(partitions), ["day"], latency_sketch=ev.SKETCH_SIZE)
        for by in ((), ("day",)):
            for found in ev.latency_quantiles(cells, by).collect():
                own = known.where(f"day = {found['day']}") if by else known
                for rank, name in ((0.5, "p50"), (0.95, "p95"), (0.99, "p99")):
                    value = found[f"{name}_latency_ms"]
                    share = own.where(F.col("latency_ms") <= value).count() / own.count()
                    assert abs(share - rank) <= ev.RANK_ERROR
    nothing = ev.evaluation_cells(rows.where("isnan(latency_ms)"), latency_sketch=200)
    assert ev.latency_quantiles(nothing, (), (0.5, 0.999)).first().asDict() == {
        "p50_latency_ms": None, "p99_9_latency_ms": None
    }
    assert ev.metrics(cells, ["day"]).count() == 7


def test_latencies_of_any_size_have_exact_sums(spark):
    import math
    import random

    rng = random.Random(11)
    values = [rng.choice((-1, 1)) * rng.random() * 10.0 ** rng.randint(10, 300) for _ in range(400)]
    values += [1e300, -1e300, 1.5, 2.5, 9e9, 8.9e9]
    df = frame(spark, [("positive", rng.choice(("positive", "buy")), 0.5, x) for x in values])
    expected = (1.5 + 2.5 + 8.9e9 + math.fsum(x for x in values if abs(x) >= 9e9)) / len(values)
    for partitions in (1, 7):
        cells = ev.evaluation_cells(df.repartition(partitions))
        assert ev.metrics(cells).first()["mean_latency_ms"] == expected
        halves = cells.where("bin < 5").union(cells.where("bin >= 5"))
        assert ev.metrics(halves).first()["mean_latency_ms"] == expected
    special = frame(spark, [("positive", "positive", 0.5, x) for x in (math.inf, 1e300, 1.0)])
    assert ev.metrics(ev.evaluation_cells(special)).first()["mean_latency_ms"] == math.inf
