"""Record building and scoring on streams.

The row-wise operators are stateless, so they apply to a stream as they are; this module
only adds the sources and sinks around them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.scoring import ScorerFactory, score_records
from ..sources.schemas import LABELED_INPUT


def stream_jsonl(
    spark: SparkSession, folder: str, schema: str = LABELED_INPUT, files_per_batch: int | None = None
) -> DataFrame:
    """JSON lines files as they arrive in a folder; a broken line stops the query."""
    reader = spark.readStream.schema(schema).option("mode", "FAILFAST")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(folder)


def start_appending(rows: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append rows to the Parquet table at ``path``, each input row once."""
    return (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )


def start_scoring(
    records: DataFrame,
    factory: ScorerFactory,
    path: str,
    checkpoint: str,
    normalize_gold: bool = True,
    prompts: bool = True,
    **trigger,
) -> StreamingQuery:
    """Score a stream of labeled records into the Parquet table at ``path``."""
    scored = score_records(records, factory, normalize_gold, prompts)
    return start_appending(scored, path, checkpoint, **trigger)
