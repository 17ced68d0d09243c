"""Monitoring of predictions over time, on streams and tables alike.

A stream keeps only the evaluation cells of its open windows as state. Closed windows
are appended to a table of cells, from which all metrics are derived when it is read. A live
monitor writes open windows, too: with each batch, the cells that it changed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.vocabulary import DEFAULT_BINS
from ..operators.evaluation import CELL_SUMS, evaluation_cells, metrics
from .scoring import start_appending


def windowed_cells(
    predictions: DataFrame,
    time: str,
    window: str = "1 day",
    watermark: str = "1 hour",
    bins: int = DEFAULT_BINS,
    by: Sequence[str] = (),
    latency_sketch: int | None = None,
) -> DataFrame:
    """Evaluation cells per time window, and ``by``; late rows beyond the watermark are left out."""
    timed = predictions.withColumn(time, F.col(time).cast("timestamp"))
    if timed.isStreaming:
        timed = timed.withWatermark(time, watermark)
    return evaluation_cells(timed, [F.window(time, window).alias("window"), *by], bins, latency_sketch=latency_sketch)


def start_monitor(cells: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append the cells of closed windows to the Parquet table at ``path``."""
    return start_appending(cells, path, checkpoint, **trigger)


def start_live_monitor(
    cells: DataFrame, path: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Write the cells of open and closed windows, as far as each batch changed them.

    A batch has a folder of its own, which a repeated batch replaces.
    """

    def keep(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    return (
        cells.writeStream.foreachBatch(keep)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )


def read_live_cells(spark: SparkSession, path: str) -> DataFrame:
    """The cells that a live monitor wrote, each as its last batch left it."""
    rows = spark.read.parquet(path)
    keys = [c for c in rows.columns if c not in (*CELL_SUMS, "batch")]
    sums = [c for c in rows.columns if c in CELL_SUMS]
    last = F.max_by(F.struct(*sums), "batch").alias("last")
    return rows.groupBy(*keys).agg(last).select(*keys, "last.*")


def late_cells(query: StreamingQuery) -> int:
    """How many sums of late rows, one per task and cell, were left out in the batches whose
    progress the query still holds."""
    return sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )


def window_metrics(cells: DataFrame, bins: int = DEFAULT_BINS) -> DataFrame:
    """Quality and latency metrics per window."""
    return metrics(cells, ["window"], bins)


def prediction_shares(cells: DataFrame) -> DataFrame:
    """Share of each predicted label per window; null is the unparseable share."""
    counts = cells.groupBy("window", "prediction").agg(F.sum("n").alias("n"))
    total = F.sum("n").over(Window.partitionBy("window"))
    return counts.withColumn("share", F.col("n") / total)
