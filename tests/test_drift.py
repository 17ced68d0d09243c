"""Drift measures against plain Python, and a stream against the table."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from assayer.streaming import DriftLimits, drift, start_drift_monitor, windowed_cells

DAY = dt.datetime(2024, 1, 1)
LIMITS = DriftLimits(reference=3, silence=3 * 86_400)


def rows_of(rng, days=14):
    rows = []
    for day in range(days):
        for key in ("steady", "shifts", "stops"):
            if key == "stops" and day > 5:
                continue
            for i in range(rng.randint(10, 30)):
                odd = key == "shifts" and day > 6
                answer = rng.choice(["positive"] * 8 + ["none"] if odd else ["positive", "neutral", "negative"])
                at = DAY + dt.timedelta(days=day, seconds=rng.randrange(86_400))
                rows.append((at, key, "positive", answer, 0.9 - 0.05 * odd - rng.random() / 20, 1.0))
    return rows


def brute(rows, limits):
    out, keys = [], sorted({r[1] for r in rows})
    for key in keys:
        by_day = {}
        for at, own, _, answer, confidence, _ in rows:
            if own == key:
                by_day.setdefault(at.date(), []).append((answer, confidence))
        reference, total, up, down, ups, downs = [0] * 4, 0.0, 0.0, 0.0, [], []
        for n, day in enumerate(sorted(by_day), 1):
            answers = [a for a, _ in by_day[day]]
            counts = [answers.count(c) for c in ("negative", "neutral", "positive", "none")]
            index = None
            if n <= limits.reference:
                reference = [a + b for a, b in zip(reference, counts)]
            else:
                shares = [((a + 0.5) / (sum(counts) + 2), (b + 0.5) / (sum(reference) + 2)) for a, b in zip(counts, reference)]
                index = sum((p - r) * math.log(p / r) for p, r in shares)
            x = sum(c for _, c in by_day[day]) / len(answers)
            total += x
            up += x - total / n - limits.tolerance
            down += x - total / n + limits.tolerance
            ups.append(up)
            downs.append(down)
            rise, fall = up - min(ups), max(downs) - down
            out.append((key, str(day), len(answers), *counts, x, index, rise, fall,
                        index is not None and index > limits.stability,
                        max(rise, fall) > limits.page_hinkley, False))
    return out


def plain(found):
    def cell(v):
        return round(v, 9) if isinstance(v, float) else v

    return sorted((tuple(map(cell, r)) for r in found), key=str)


def listed(df):
    day = F.date_format("window_start", "yyyy-MM-dd").alias("day")
    rest = [c for c in df.columns if c not in ("key", "window_start")]
    return plain(map(tuple, df.select("key", day, *rest).collect()))


def frame(spark, rows):
    return spark.createDataFrame(
        rows, "ts timestamp, key string, label string, prediction string, confidence double, latency_ms double"
    )


def cells_of(df):
    return windowed_cells(df, "ts", by=["key"])


def test_measures_equal_plain_python(spark):
    rows = rows_of(random.Random(1))
    found = listed(drift(cells_of(frame(spark, rows)), ["key"], LIMITS))
    assert found == plain(brute(rows, LIMITS))
    alarms = {(r[0], r[11], r[12]) for r in found}
    assert ("shifts", True, True) in alarms and not any(a[2] for a in alarms if a[0] == "steady")


@pytest.mark.parametrize("per_batch", [1, 20])
def test_stream_equals_table(spark, tmp_path, per_batch):
    rows = rows_of(random.Random(2))
    df = frame(spark, rows)
    folder, path = str(tmp_path / "in"), str(tmp_path / "drift")
    for day in range(14):  # files arrive in time order
        df.where(F.datediff("ts", F.lit(DAY)) == day).coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", per_batch).parquet(folder)
    store = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    query = start_drift_monitor(
        cells_of(stream), path, str(tmp_path / "state"), ["key"], LIMITS, availableNow=True
    )
    assert query.awaitTermination(300)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == store
    until = max(r[0] for r in rows) - dt.timedelta(hours=1)
    closed = cells_of(df).where(F.col("window.end") <= F.lit(until))
    expected = listed(drift(closed, ["key"], LIMITS, until=F.lit(until)))
    found = listed(spark.read.parquet(path))
    assert found == expected
    assert [r[:2] for r in found if r[-1]] == [("stops", "2024-01-07")]


def test_empty_table_and_no_key(spark):
    rows = rows_of(random.Random(3), days=5)
    df = frame(spark, rows).where("key = 'steady'")
    assert drift(windowed_cells(df.limit(0), "ts")).collect() == []
    whole = drift(windowed_cells(df, "ts"), limits=LIMITS)
    assert whole.count() == 5 and whole.where("stability_index is null").count() == 3
