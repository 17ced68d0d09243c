import pytest
from pyspark.sql import functions as F

from assayer.operators import records as rec

ROWS = [
    ("1", "Orders grew in every region.", "positive"),
    ("2", " Costs rose again. ", " Bearish "),
    (None, "The plan stands.", "mixed"),
    ("4", "   ", "no such label"),
    ("5", "", "no such label"),
    ("6", None, None),
]
PROMPT = "Classify the financial sentiment as negative, neutral, or positive.\nText: {}\nLabel:"


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, "id string, text string, label string")


def test_sft_records(spark):
    found = [r.asDict() for r in rec.sft_records(frame(spark)).collect()]
    texts = ["Orders grew in every region.", "Costs rose again.", "The plan stands."]
    labels = ["positive", "negative", "neutral"]
    assert found == [
        {"id": i, "prompt": PROMPT.format(t), "response": y,
         "text": f"{PROMPT.format(t)} {y}", "label": y}
        for i, t, y in zip(["1", "2", None], texts, labels)
    ]


def test_preference_pairs(spark):
    found = rec.preference_pairs(frame(spark)).collect()
    assert [(r["chosen"], r["rejected"]) for r in found] == [
        ("positive", "negative"), ("negative", "neutral"), ("neutral", "negative")
    ]
    assert found[1]["prompt"] == PROMPT.format("Costs rose again.")


def test_text_falls_through_to_sentence(spark):
    df = spark.createDataFrame(
        [("1", "", "x", "positive"), ("2", "  ", "x", "bad label"), ("3", None, None, "bad")],
        "id string, headline string, sentence string, label string",
    )
    found = rec.labeled_texts(df, "headline").collect()
    assert [tuple(r) for r in found] == [("1", "x", "positive")]


def test_unsupported_label_fails_or_is_set_aside(spark):
    df = frame(spark, [*ROWS, ("7", "Shares rose.", "Strong Buy"), ("8", "Shares fell.", None)])
    with pytest.raises(Exception, match="Unsupported label: (Strong Buy|None)"):
        rec.labeled_texts(df).collect()
    accepted, rejected = rec.quarantine_labels(df)
    assert accepted.count() == 3
    assert sorted(tuple(r) for r in rejected.collect()) == [
        ("7", "Shares rose.", "Strong Buy"), ("8", "Shares fell.", None)
    ]


def test_codes(spark):
    df = spark.createDataFrame([("a", "x", 0), ("b", "y", 2), ("c", " ", 9)],
                               "id string, text string, label int")
    assert [r["label"] for r in rec.labeled_texts(df, codes=True).collect()] == [
        "negative", "positive"
    ]
    bad = spark.createDataFrame([("a", "x", 3)], "id string, text string, label int")
    with pytest.raises(Exception, match="Unsupported label: 3"):
        rec.labeled_texts(bad, codes=True).collect()
    # the string "1" is not a code
    with pytest.raises(Exception, match="Unsupported label: 1"):
        rec.labeled_texts(frame(spark, [("a", "x", "1")])).collect()


def test_labels_are_checked_in_time_under_further_filters(spark):
    # a later filter must not make the label check see rows that were blank
    found = rec.labeled_texts(frame(spark)).where(F.col("label") != "neutral").collect()
    assert len(found) == 2


def test_numbering_is_dense_and_counts_blank_rows(spark):
    df = spark.range(0, 5000, 1, 7).select(
        (F.lit(3) * F.col("id") - 4000).alias("key"),
        F.when(F.col("id") % 10 == 0, " ").otherwise(F.col("id").cast("string")).alias("text"),
        F.lit("positive").alias("label"),
    )
    numbered = rec.number_records(df.orderBy(F.rand(1)), ["key"])
    kept = rec.labeled_texts(numbered).collect()
    assert len(kept) == 4500
    assert all(r["id"] == f"fpb-{r['text']}" for r in kept)


def test_missing_ids_take_their_position(spark):
    df = spark.range(50).select(
        F.col("id").alias("key"), F.when(F.col("id") % 3 == 0, F.concat(F.lit("n"), "id")).alias("id")
    )
    found = {r["key"]: r["id"] for r in rec.fill_missing_ids(df, ["key"]).collect()}
    assert found == {i: f"n{i}" if i % 3 == 0 else f"ex-{i}" for i in range(50)}


def test_source_numbering_follows_files(spark, tmp_path):
    from assayer.sources import read_labeled

    path = str(tmp_path / "t")
    spark.range(500).selectExpr("string(id) AS sentence", "int(id % 3) AS label").repartitionByRange(
        4, "sentence"
    ).write.parquet(path)
    df = read_labeled(spark, path, path)
    order = [tuple(r) for r in df.select("file", "row", "sentence").collect()]
    expected = {s: f"fpb-{i}" for i, (_, _, s) in enumerate(sorted(order))}
    found = {r["sentence"]: r["id"] for r in rec.number_source_records(df).collect()}
    assert found == expected
    some = df.where("length(sentence) = 2 OR sentence > '3'")
    ids = [r["id"] for r in rec.number_source_records(some).collect()]
    assert len(set(ids)) == len(ids) == some.count()
    kept = rec.number_source_records(some, whole=df).collect()
    assert len(kept) == some.count()
    assert all(r["id"] == expected[r["sentence"]] for r in kept)


def test_lines_of_many_blocks_are_numbered_without_moving_texts(spark, tmp_path):
    from assayer.operators.positions import with_line_position
    from assayer.sources import read_jsonl

    n = 0
    for part in ("b", "a", "c"):  # the second is the first by its path
        lines = [f'{{"id": "{part}{i}", "text": "{"x" * (i % 97)}"}}' for i in range(400)]
        lines.insert(100, "")  # a blank line is no record
        (tmp_path / f"{part}.json").write_text("\n".join(lines) + "\n")
        n += 400
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        rows = read_jsonl(spark, str(tmp_path), "id STRING, text STRING", source_order=True)
        assert rows.select("file", "block").distinct().count() > 10
        numbered = with_line_position(rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "rangepartitioning" not in plan
    found = {r["position"]: r["id"] for r in numbered.collect()}
    assert found == dict(enumerate(f"{part}{i}" for part in "abc" for i in range(400))) and len(found) == n
    empty = read_jsonl(spark, str(tmp_path / "c.json"), "id STRING", source_order=True).where("id is null")
    assert with_line_position(empty).count() == 0
