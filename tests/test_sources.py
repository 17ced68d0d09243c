import json
import re
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException

from assayer.plans import build_dataset, write_dataset
from assayer.sources import (
    LABELED, PREDICTION, PREFERENCE, read_jsonl, read_labeled, write_jsonl,
)


def test_jsonl_round_trip(spark, tmp_path):
    rows = [("1", "Gewinn über Plan\n“ok”", "positive"), (None, "", None)]
    df = spark.createDataFrame(rows, LABELED)
    write_jsonl(df, str(tmp_path / "deep" / "out"))
    raw = "".join(f.read_text() for f in (tmp_path / "deep" / "out").glob("part-*"))
    assert raw.isascii() and '"id":null' in raw
    assert sorted(map(str, read_jsonl(spark, str(tmp_path / "deep" / "out"), LABELED).collect())) == (
        sorted(map(str, df.collect()))
    )
    write_jsonl(df.limit(0), str(tmp_path / "deep" / "out"))
    assert read_jsonl(spark, str(tmp_path / "deep" / "out"), LABELED).count() == 0


def test_blank_lines_are_skipped_and_missing_keys_null(spark, tmp_path):
    (tmp_path / "p.jsonl").write_text(
        '{"id":"a","label":"positive","prediction":"x","confidence":0.5,"latency_ms":42}\n'
        '\n   \n{"label":"neutral"}\n'
    )
    found = read_jsonl(spark, str(tmp_path / "p.jsonl"), PREDICTION).collect()
    assert [tuple(r) for r in found] == [
        ("a", "positive", "x", 0.5, 42.0), (None, "neutral", None, None, None)
    ]


def test_broken_line_fails_the_job(spark, tmp_path):
    (tmp_path / "p.jsonl").write_text('{"id":"a"}\n{"id":\n')
    with pytest.raises(Exception, match="FAILED_READ_FILE|MALFORMED"):
        read_jsonl(spark, str(tmp_path / "p.jsonl"), LABELED).collect()


def source(spark, path, n=50):
    df = spark.range(n).selectExpr(
        "if(id % 10 = 3, '  ', concat(' sentence ', id)) AS sentence", "int(id % 3) AS label"
    )
    df.coalesce(1).write.parquet(path)


def test_mirror_is_read_when_the_primary_is_missing(spark, tmp_path):
    source(spark, str(tmp_path / "mirror"))
    df = read_labeled(spark, str(tmp_path / "primary"), str(tmp_path / "mirror"))
    assert df.count() == 50 and df.columns == ["sentence", "label", "file", "row"]


def test_mirror_is_read_when_the_primary_is_broken(spark, tmp_path):
    source(spark, str(tmp_path / "mirror"))
    (tmp_path / "primary").mkdir()
    (tmp_path / "primary" / "part-0.parquet").write_bytes(b"no parquet in here")
    df = read_labeled(spark, str(tmp_path / "primary"), str(tmp_path / "mirror"))
    assert df.count() == 50


def test_dataset_files(spark, tmp_path):
    source(spark, str(tmp_path / "table"))
    df = read_labeled(spark, str(tmp_path / "table"), str(tmp_path / "none"))
    dataset = build_dataset(df, max_train=20)
    write_dataset(dataset, str(tmp_path / "data"))
    read = {name: read_jsonl(spark, str(tmp_path / "data" / name), schema).collect()
            for name, schema in [("train", LABELED), ("test", LABELED), ("preferences", PREFERENCE)]}
    # 45 of 50 rows are not blank; 36 of them are train rows, capped at 20
    assert [len(read[n]) for n in ("train", "test", "preferences")] == [20, 9, 20]
    for r in read["train"] + read["test"]:
        i = int(r["id"].removeprefix("fpb-"))
        assert r["text"] == f"sentence {i}" and r["label"] == ("negative", "neutral", "positive")[i % 3]
    assert not {r["id"] for r in read["train"]} & {r["id"] for r in read["test"]}
    assert {r["id"] for r in read["preferences"]} == {r["id"] for r in read["train"]}
    assert all(r["chosen"] != r["rejected"] for r in read["preferences"])
    line = next((tmp_path / "data" / "train").glob("part-*")).read_text().splitlines()[0]
    assert list(json.loads(line)) == ["id", "text", "label"]


def table_of_files(spark, path):
    """Five files in three folders, of the rows 0 to 4,999 in order."""
    for i, name in enumerate(("k=a b/a", "k=a b/b", "k=c/c", "k=c/d+", "k=e/z")):
        rows = spark.range(1000 * i, 1000 * i + 1000).selectExpr(
            "concat('sentence ', id, repeat(md5(string(id)), 20)) AS sentence", "int(id % 3) AS label"
        )
        rows.coalesce(1).write.mode("overwrite").option("parquet.block.size", 50_000).parquet(f"{path}-one")
        (one,) = Path(f"{path}-one").glob("part-*.parquet")
        to = Path(path) / f"{name}.parquet"
        to.parent.mkdir(parents=True, exist_ok=True)
        to.write_bytes(one.read_bytes())


def test_broken_files_come_from_the_mirror(spark, tmp_path, caplog):
    from assayer.sources import broken_files, read_verified

    primary, mirror = tmp_path / "primary", tmp_path / "mirror"
    table_of_files(spark, str(primary))
    table_of_files(spark, str(mirror))

    def numbers(df):
        rows = df.orderBy("file", "row").collect()
        return [int(re.match(r"sentence (\d+?)[0-9a-f]{640}$", r["sentence"])[1]) for r in rows], rows

    found, whole = numbers(read_verified(spark, str(primary), str(mirror)))
    assert found == list(range(5000)) and not caplog.records
    cut = primary / "k=a b" / "b.parquet"  # its end, with the footer, is missing
    cut.write_bytes(cut.read_bytes()[: cut.stat().st_size // 2])
    spoiled = primary / "k=c" / "d+.parquet"  # a page in the middle is not what it was
    data = bytearray(spoiled.read_bytes())
    middle = len(data) // 2
    data[middle - 20_000 : middle + 20_000] = b"\xff" * 40_000
    spoiled.write_bytes(data)
    (primary / "_SUCCESS").write_bytes(b"")
    names = ["k=a b/b.parquet", "k=c/d+.parquet"]
    assert broken_files(spark, str(primary), ["sentence", "label"]) == names
    found, rows = numbers(read_verified(spark, str(primary), str(mirror)))
    assert found == list(range(5000)) and rows == whole
    assert [name in r.getMessage() for name, r in zip(names, caplog.records)] == [True, True]
    (mirror / "k=a b" / "b.parquet").unlink()
    with pytest.raises(AnalysisException):
        read_verified(spark, str(primary), str(mirror))


def test_a_table_without_any_readable_file(spark, tmp_path):
    from assayer.sources import read_verified

    table_of_files(spark, str(tmp_path / "mirror"))
    for name in ("k=a b/a", "k=e/z"):
        (tmp_path / "primary" / name).parent.mkdir(parents=True)
        (tmp_path / "primary" / f"{name}.parquet").write_bytes(b"PAR1 no table")
    assert read_verified(spark, str(tmp_path / "primary"), str(tmp_path / "mirror")).count() == 2000


def test_files_of_a_verified_source_grow_with_the_table(spark, tmp_path):
    from workloads.queries import QUERIES

    rows = spark.range(900).selectExpr("899 - id AS doc_id", "repeat('x', 90) AS text", "'en' AS lang")
    rows.repartition(9).write.parquet(str(tmp_path / "documents.parquet"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        found = QUERIES["verified_source"](spark, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(r["position"] for r in found.collect()) == list(range(900))
    assert len([f for f in found.inputFiles() if "/primary-" in f]) >= 9
