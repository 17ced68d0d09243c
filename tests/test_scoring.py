import pytest
from pyspark.sql import functions as F

from assayer.operators import requests as req
from assayer.operators import scoring as sc
from assayer.plans import evaluate, fit_classifier, score_with_classifier


def rule_scorer():
    def score(texts):
        return [("positive" if "profit" in t.lower() else "negative", 0.9) for t in texts]

    return score


def chatty_scorer():
    return lambda prompts: [(f" The label is neutral\n{len(p)} buy", 0.25) for p in prompts]


def texts(spark):
    rows = [("1", "Record profit and raised guidance", "positive"), ("2", "losses mount", "bearish"),
            ("3", "PROFIT warning", "mixed"), ("4", " ", "neutral")]
    return spark.createDataFrame(rows, "id string, text string, label string")


def test_score_records_with_the_rule(spark):
    found = sc.score_records(texts(spark), rule_scorer, prompts=False).orderBy("id").collect()
    assert [(r["id"], r["label"], r["prediction"], r["confidence"]) for r in found] == [
        ("1", "positive", "positive", 0.9), ("2", "negative", "negative", 0.9),
        ("3", "neutral", "positive", 0.9), ("4", "neutral", "negative", 0.9),
    ]
    assert all(r["latency_ms"] >= 0 for r in found)
    by_rule = sc.rule_predictions(texts(spark), ["id"]).orderBy("id").collect()
    assert [r["label"] for r in by_rule] == [r["prediction"] for r in found]
    assert by_rule[0]["confidence"] == 0.9 and by_rule[0]["latency_ms"] == 1.0


def test_scoring_spread_over_tasks(spark):
    many = spark.range(400).selectExpr("string(id) AS id", "'profit' AS text", "'mixed' AS label")
    scored = sc.score_records(many.coalesce(1), rule_scorer, partitions=4)
    assert scored.count() == 400 and scored.rdd.getNumPartitions() == 4
    assert {r["id"] for r in scored.collect()} == {str(i) for i in range(400)}


def test_unparseable_completions_are_kept_raw(spark):
    def scorer():
        return lambda prompts: [(" strong buy \n", 1.0) for _ in prompts]

    found = sc.score_records(texts(spark), scorer).collect()
    assert {r["prediction"] for r in found} == {"strong buy"}
    service = sc.service_predictions(texts(spark), scorer, "fake", "m", ["id"]).collect()
    assert {(r["label"], r["raw"]) for r in service} == {(None, "strong buy")}


def test_scorer_sees_prompts_and_gold_may_pass_through(spark):
    found = sc.score_records(texts(spark), chatty_scorer, normalize_gold=False).collect()
    assert {r["label"] for r in found} == {"positive", "bearish", "mixed", "neutral"}
    assert {r["prediction"] for r in found} == {"neutral"}


def test_scorer_must_answer_every_text(spark):
    with pytest.raises(Exception, match="scorer returned 0 results"):
        sc.score_records(texts(spark), lambda: lambda prompts: []).collect()


def test_unsupported_gold_fails_scoring(spark):
    df = spark.createDataFrame([("1", "x", "unsure")], "id string, text string, label string")
    with pytest.raises(Exception, match="Unsupported label: unsure"):
        sc.score_records(df, rule_scorer).collect()


def test_external_baseline(spark):
    df = spark.createDataFrame(
        [("1", "Bullish", " Positive.\n"), ("2", "x", "it is negative"), ("3", "y", None)],
        "id string, label string, completion string",
    )
    found = sc.external_baseline(df).orderBy("id").collect()
    assert [(r["label"], r["prediction"], r["confidence"]) for r in found] == [
        ("Bullish", "Positive.", 1.0), ("x", "negative", 1.0), ("y", "", 1.0)
    ]


def test_lexical_baseline(spark):
    df = spark.createDataFrame(
        [("1", "Gains, gains; loss"), ("2", "Loss"), ("3", "gains loss"), ("4", "nothing")],
        "id string, text string",
    ).withColumn("label", F.lit("neutral"))
    found = sc.lexical_predictions(df, ["loss"], ["gains"]).orderBy("id").collect()
    assert [(r["prediction"], round(r["confidence"], 6)) for r in found] == [
        ("positive", 0.666667), ("negative", 1.0), ("neutral", 0.5), ("neutral", 1.0)
    ]


def test_validation(spark):
    df = spark.createDataFrame([(" ",), ("",), (None,), ("x",)], "text string")
    valid, invalid = req.validate_texts(df)
    assert sorted(r["text"] for r in valid.collect()) == [" ", "x"] and invalid.count() == 2
    df = spark.createDataFrame([(["a", ""],), ([],), (None,), (["a", None],)], "texts array<string>")
    valid, invalid = req.validate_batches(df)
    assert [r["texts"] for r in valid.collect()] == [["a", ""]] and invalid.count() == 3


def test_batch_envelopes(spark):
    batches = spark.createDataFrame(
        [(1, ["profit up", "losses mount"]), (2, ["flat", "profit", "x", "profit", "y"])],
        "batch int, texts array<string>",
    )
    scored = sc.rule_predictions(req.explode_batches(batches, "batch"), ["batch", "position"])
    found = {r["batch"]: r for r in req.batch_envelopes(scored.repartition(5), "batch", 10).collect()}
    assert found[1]["count"] == 2 and found[1]["page"] == 0
    assert [p["label"] for p in found[1]["predictions"]] == ["positive", "negative"]
    assert list(found[1]["predictions"][0].asDict()) == [
        "label", "raw", "confidence", "latency_ms", "backend", "model"
    ]
    headers = {r["batch"]: r["count"] for r in req.batch_headers(scored, "batch").collect()}
    assert headers == {1: 2, 2: 5}
    pages = req.batch_envelopes(scored, "batch", page_size=2).where("batch = 2").orderBy("page")
    assert [r["count"] for r in pages.collect()] == [5, 5, 5]
    assert [p["label"] for r in pages.collect() for p in r["predictions"]] == [
        "negative", "positive", "negative", "positive", "negative"
    ]


def test_classifier_chain(spark):
    words = {"negative": "losses fell weak", "neutral": "plan steady outlook",
             "positive": "profit rose strong"}
    train = spark.createDataFrame(
        [(f"{label}{i}", f"{text} w{i}", label) for label, text in words.items() for i in range(20)],
        "id string, text string, label string",
    )
    test = spark.createDataFrame(
        [(label, text, label) for label, text in words.items()], "id string, text string, label string"
    )
    model = fit_classifier(train, features=1 << 10)
    scored = score_with_classifier(model, test)
    base = test.select("id", "label", F.lit("neutral").alias("prediction"),
                       F.lit(1.0).alias("confidence"), F.lit(0.0).alias("latency_ms"))
    row = evaluate(scored, base).first()
    assert row["accuracy"] == 1.0 and row["relative_accuracy_lift"] == 2.0003
    assert 0.34 < scored.agg(F.min("confidence")).first()[0] <= 1.0


def sized_scorer():
    def score(texts):
        cost = len(texts) * max(map(len, texts))
        return [(f"positive {len(t)}", float(cost if len(texts) > 1 else 0)) for t in texts]

    return score


def test_batches_by_length_stay_in_the_budget(spark):
    rows = spark.range(3_000).selectExpr(
        "string(id) AS id",
        "IF(id = 7, repeat('x', 50000000), repeat('x', int(pow(id % 50, 2)))) AS text", "'neutral' AS label",
    )
    scored = sc.score_records(rows.repartition(3), sized_scorer, prompts=False, batch_chars=10_000)
    assert scored.agg(F.max("confidence")).first()[0] <= 10_000  # of batches, by the padded size
    found = {r["id"]: r["prediction"] for r in scored.collect()}
    want = {str(i): 50_000_000 if i == 7 else (i % 50) ** 2 for i in range(3_000)}
    assert found == {i: "positive" for i in want}
    parts = sc.service_predictions(rows.where("id != 7"), sized_scorer, "b", "m", ["id"], False, None, 500)
    assert {r["id"]: int(r["raw"].split()[1]) for r in parts.collect()} == {
        i: n for i, n in want.items() if i != "7"
    }


def test_length_batches():
    deal = sc.length_batcher()
    assert deal([5, 1, 1, 9, 2], 6) == [[1, 2, 4], [0], [3]]
    assert deal([], 5) == [] and deal([0, 0, 7], 5) == [[0, 1], [2]]
