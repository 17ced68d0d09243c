import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from assayer.streaming import (
    late_cells, prediction_shares, read_live_cells, start_live_monitor, start_monitor,
    window_metrics, windowed_cells,
)
from workloads.queries import QUERIES

LABEL = {"purchase": "positive", "error": "negative"}


def predictions(events):
    kind = F.col("event_type")
    return events.select(
        "ts",
        F.when(kind == "purchase", "positive").when(kind == "error", "negative")
        .otherwise("neutral").alias("label"),
        F.when(F.col("value") < 5, "positive").when(F.col("value") < 20, "neutral")
        .otherwise(kind).alias("prediction"),
        (F.col("value") / 50).alias("confidence"),
        F.col("value").alias("latency_ms"),
    )


def test_stream_equals_batch_on_closed_windows(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    folder = str(tmp_path / "in")
    # files arrive in time order, a week each
    for week in range(5):
        part = events.where(F.floor((F.dayofmonth("ts") - 1) / 7) == week)
        part.coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    query = start_monitor(
        windowed_cells(predictions(stream), "ts"), str(tmp_path / "cells"), str(tmp_path / "state"),
        availableNow=True,
    )
    assert query.awaitTermination(300)
    found = window_metrics(spark.read.parquet(str(tmp_path / "cells"))).collect()
    latest = events.agg(F.max(F.col("ts").cast("timestamp"))).first()[0]
    batch = windowed_cells(predictions(events), "ts")
    closed = batch.where(F.col("window.end") <= F.lit(latest) - F.expr("INTERVAL 1 HOUR"))
    expected = window_metrics(closed).collect()
    assert len(expected) > 5
    assert sorted(map(str, found)) == sorted(map(str, expected))


def test_live_monitor_has_open_windows(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    folder, path = str(tmp_path / "in"), str(tmp_path / "cells")
    # files arrive in time order and share their days, so that cells change across batches
    for part in range(4):
        some = events.where((F.hour("ts") % 2 == part % 2) & ((F.dayofmonth("ts") > 15) == (part > 1)))
        some.coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    query = start_live_monitor(
        windowed_cells(predictions(stream), "ts", watermark="60 days"), path,
        str(tmp_path / "state"), availableNow=True,
    )
    assert query.awaitTermination(300) and late_cells(query) == 0
    found = window_metrics(read_live_cells(spark, path)).collect()
    expected = window_metrics(windowed_cells(predictions(events), "ts")).collect()
    assert sorted(map(str, found)) == sorted(map(str, expected))


def test_prediction_shares(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    shares = prediction_shares(windowed_cells(predictions(events), "ts"))
    sums = shares.groupBy("window").agg(F.sum("share").alias("s")).collect()
    assert all(abs(r["s"] - 1) < 1e-12 for r in sums)
    assert shares.agg(F.sum("n")).first()[0] == events.count()


def test_scoring_a_stream_of_files(spark, tmp_path):
    from assayer.sources import LABELED, PREDICTION, write_jsonl
    from assayer.streaming import start_scoring, stream_jsonl

    from .test_scoring import rule_scorer

    folder, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))

    def arrive(ids):
        rows = [(str(i), f"profit {i}" if i % 2 else f"loss {i}", "bullish") for i in ids]
        write_jsonl(spark.createDataFrame(rows, LABELED), folder, "append")
        records = stream_jsonl(spark, folder, files_per_batch=2)
        start_scoring(records, rule_scorer, out, state, availableNow=True).awaitTermination()
        return spark.read.schema(PREDICTION).parquet(out).collect()

    assert len(arrive(range(10))) == 10
    found = arrive(range(10, 25))
    assert sorted(int(r["id"]) for r in found) == list(range(25))
    assert all(r["prediction"] == ("positive" if int(r["id"]) % 2 else "negative") for r in found)
    assert {r["label"] for r in found} == {"positive"}


@pytest.mark.parametrize("name", ["streamed_preference_pairs", "streamed_scores"])
def test_streamed_table_may_be_a_folder_of_files(spark, tmp_path, name):
    rows = [(1, 0, "user", "the gain"), (1, 1, "assistant", " "), (2, 0, "user", None), (None, 3, None, "x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    folders = [str(tmp_path / kind) for kind in ("folder", "file")]
    turns.repartition(3).write.parquet(f"{folders[0]}/conversations.parquet")
    (tmp_path / "file").mkdir()
    pq.write_table(turns.toArrow(), f"{folders[1]}/conversations.parquet")
    found = [sorted(map(str, QUERIES[name](spark, folder).collect())) for folder in folders]
    assert found[0] == found[1] and len(found[0]) >= 1


@pytest.mark.parametrize("name", ["streamed_preference_pairs", "streamed_scores"])
def test_streamed_table_may_be_a_partitioned_folder(spark, tmp_path, name):
    rows = [(1, 0, "user", "the gain"), (1, 1, "assistant", "a loss"), (2, 0, "user", None), (None, 3, None, "x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    folders = [str(tmp_path / kind) for kind in ("keyed", "plain")]
    turns.write.partitionBy("role").parquet(f"{folders[0]}/conversations.parquet")
    turns.write.parquet(f"{folders[1]}/conversations.parquet")
    folders.append(str(tmp_path / "pl*n"))  # patterns of unpartitioned folders stay possible
    found = [sorted(map(str, QUERIES[name](spark, folder).collect())) for folder in folders]
    assert found[0] == found[1] == found[2] and len(found[0]) > 1
