import csv
import json

from assayer.plans import jobs
from assayer.sources import PREDICTION, PREFERENCE, read_jsonl, read_runs

from .test_evaluation import BASELINE, PREDICTIONS
from .test_scoring import rule_scorer


def lines(path):
    return [json.loads(x) for f in path.glob("part-*") for x in f.read_text().splitlines()]


def put(path, rows):
    path.write_text("".join(json.dumps(r) + "\n" for r in rows))
    return str(path)


def predictions(rows):
    names = ("label", "prediction", "confidence", "latency_ms")
    return [{"id": f"fin-{i:03d}", **dict(zip(names, r))} for i, r in enumerate(rows, 1)]


def test_evaluate_and_track(spark, tmp_path):
    p = put(tmp_path / "p.jsonl", predictions(PREDICTIONS))
    b = put(tmp_path / "b.jsonl", predictions(BASELINE))
    rows = jobs.evaluate_files(spark, p, b, str(tmp_path / "out"))
    found = json.loads(next((tmp_path / "out").glob("part-*")).read_text())
    assert found["examples"] == 8 and found["accuracy"] == 0.875 and found["macro_f1"] == 0.8413
    assert found["baseline_accuracy"] == 0.75 and found["relative_accuracy_lift"] == 0.1667
    assert found["confusion_matrix"]["neutral"] == {"negative": 0, "neutral": 1, "positive": 1}
    assert found["label_distribution"] == {"negative": 3, "neutral": 2, "positive": 3}
    params = spark.createDataFrame(
        [(("eval", [1]),)], "evaluation struct<name:string,labels:array<int>>"
    )
    jobs.track_report(rows, params, "exp", "run-1", str(tmp_path / "runs"))
    logged = {(r["kind"], r["key"]): r["value"] or r["number"]
              for r in read_runs(spark, str(tmp_path / "runs")).collect()}
    assert logged["param", "evaluation.name"] == "eval"
    assert logged["metric", "accuracy"] == 0.875 and logged["metric", "examples"] == 8.0
    assert ("metric", "confusion_matrix") not in logged and len(logged) == 12


def test_without_baseline(spark, tmp_path):
    p = put(tmp_path / "p.jsonl", predictions(PREDICTIONS))
    assert "baseline_accuracy" not in jobs.evaluate_files(spark, p).columns


def test_score_file(spark, tmp_path):
    rows = [{"text": f"text {i} profit" if i % 4 else "loss", "label": "bullish"} for i in range(40)]
    rows[3]["id"] = "own"
    rows[5] = {"sentence": "no text field", "label": "mixed"}
    source = put(tmp_path / "in.jsonl", rows)
    jobs.score_file(spark, source, str(tmp_path / "all"), rule_scorer)
    found = {r["id"]: r for r in lines(tmp_path / "all")}
    assert set(found) == {f"ex-{i}" if i != 3 else "own" for i in range(40)}
    assert found["ex-0"]["prediction"] == "negative" and found["ex-1"]["prediction"] == "positive"
    assert found["ex-5"]["label"] == "neutral" and found["ex-5"]["prediction"] == "negative"
    assert list(found["own"]) == ["id", "label", "prediction", "confidence", "latency_ms"]
    jobs.score_file(spark, source, str(tmp_path / "some"), rule_scorer, limit=7)
    assert {r["id"] for r in lines(tmp_path / "some")} == {
        f"ex-{i}" if i != 3 else "own" for i in range(7)
    }
    assert jobs.evaluate_files(spark, str(tmp_path / "all")).first()["examples"] == 40
    assert read_jsonl(spark, str(tmp_path / "some"), PREDICTION).count() == 7


def test_prepare(spark, tmp_path):
    spark.range(40).selectExpr("concat('s', id) AS sentence", "int(id % 3) AS label").repartition(
        3
    ).write.parquet(str(tmp_path / "mirror"))
    jobs.prepare_dataset(
        spark, str(tmp_path / "none"), str(tmp_path / "mirror"), str(tmp_path / "d"), max_train=30
    )
    sizes = [len(lines(tmp_path / "d" / n)) for n in ("train", "test", "preferences")]
    assert sizes == [30, 8, 30]
    ids = {r["id"] for n in ("train", "test") for r in lines(tmp_path / "d" / n)}
    assert len(ids) == 38 and ids <= {f"fpb-{i}" for i in range(40)}
    jobs.prepare_preferences(spark, str(tmp_path / "d" / "test"), str(tmp_path / "p"))
    pairs = read_jsonl(spark, str(tmp_path / "p"), PREFERENCE).collect()
    assert len(pairs) == 8 and all(r["chosen"] != r["rejected"] for r in pairs)


def test_manifest(spark, tmp_path):
    grid = {"models": ["m"], "learning_rates": [0.1, 0.2], "lora_ranks": [8], "data_mixtures": ["a"]}
    jobs.write_manifest(spark, grid, str(tmp_path / "m"))
    rows = [r for f in sorted((tmp_path / "m").glob("*.csv")) for r in csv.DictReader(f.open())]
    assert [r["run_id"] for r in rows] == ["ablation-001", "ablation-002"]


def test_preferences_read_either_text_and_integer_labels(spark, tmp_path):
    rows = [{"id": "a", "sentence": "up", "label": 2}, {"id": "b", "text": " ", "label": 9},
            {"id": "c", "text": "down", "sentence": "x", "label": 0}]
    path = put(tmp_path / "in.jsonl", rows)
    assert jobs.prepare_preferences(spark, path, str(tmp_path / "out"), codes=True) == 1
    found = {r["id"]: r["chosen"] for r in spark.read.json(str(tmp_path / "out")).collect()}
    assert found == {"a": "positive", "c": "negative"}
