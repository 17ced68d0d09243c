"""Experiment tracking: a table with commits, of which the last log of a run counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.experiments import flatten_params, scalar_metrics
from .commits import CommitConflict, CommittedTable, Manifest

_SCHEMA = (
    "experiment STRING, run_id STRING, kind STRING, key STRING, value STRING, number DOUBLE, "
    "committed BIGINT"
)
_COLUMNS = ["run_id", "kind", "key", "value", "number", "experiment"]


def tracked_rows(runs: DataFrame, kind: str) -> DataFrame:
    """Rows ``(experiment, run_id, kind, key, value, number)`` of one kind.

    ``runs`` has one row per run with ``experiment`` and ``run_id``. Parameters are
    flattened to text values; metrics keep their scalar columns as numbers.
    """
    keep = ["experiment", "run_id"]
    if kind == "param":
        rows = flatten_params(runs, keep)
        value, number = F.col("value"), F.lit(None).cast("double")
    elif kind == "metric":
        rows = scalar_metrics(runs, keep)
        value, number = F.lit(None).cast("string"), F.col("value")
    else:
        raise ValueError(f"unknown kind {kind!r}")
    return rows.select(
        *keep, F.lit(kind).alias("kind"), "key", value.alias("value"), number.alias("number")
    )


def _write(rows: DataFrame, table: CommittedTable) -> str:
    """Write rows to a new folder. Runs are dealt out, however many an experiment has, and sorted,
    so that files and their row groups hold few experiments each."""
    folder = table.new_folder()
    keys = ["experiment", "run_id"]
    dealt = rows.repartition(*keys).sortWithinPartitions(*keys)
    dealt.select(*[f.split()[0] for f in _SCHEMA.split(", ")]).write.parquet(f"{table.path}/{folder}")
    return folder


def log_runs(params: DataFrame, metrics: DataFrame, path: str) -> None:
    """Add the parameters and metrics of runs to the tracking table at ``path``, all or none.

    A run logged again is replaced by its new rows, so a repeated job changes nothing. Writers
    at once all land; of one run, the rows that were committed last count.
    """
    rows = tracked_rows(params, "param").unionByName(tracked_rows(metrics, "metric"))
    table = CommittedTable(params.sparkSession, path)
    folder = _write(rows.withColumn("committed", F.lit(None).cast("bigint")), table)
    table.commit(lambda base: {**base.folders, folder: None})


def _rows(table: CommittedTable, manifest: Manifest) -> DataFrame:
    """All rows of a version, each with the version that committed it."""
    spark = table.spark
    if not manifest.folders:
        return spark.createDataFrame([], _SCHEMA)
    paths = [f"{table.path}/{folder}" for folder in manifest.folders]
    rows = spark.read.schema(_SCHEMA).parquet(*paths)
    names = [F.lit(v) for f, n in manifest.folders.items() for v in (f.split("/")[-1], n)]
    folder = F.element_at(F.split("_metadata.file_path", "/"), -2)
    # Compacted rows keep the version that first committed them.
    version = F.coalesce("committed", F.element_at(F.create_map(*names), folder).cast("bigint"))
    return rows.withColumn("committed", version)


def _current(rows: DataFrame) -> DataFrame:
    """The rows of each run's last commit. One row per run is shuffled to find it."""

    def key(name: str) -> Column:
        return F.col(name).eqNullSafe(F.col(f"__{name}"))

    names = ("experiment", "run_id")
    last = rows.groupBy(*[F.col(n).alias(f"__{n}") for n in names]).agg(
        F.max("committed").alias("__committed")
    )
    return rows.join(last, key("experiment") & key("run_id") & key("committed"), "left_semi")


def read_runs(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of each run's last log; as of an earlier ``version`` if one is given, unless a
    compaction has dropped what was replaced since."""
    table = CommittedTable(spark, path)
    manifest = table.last()
    if version is not None:
        folders = {f: v for f, v in manifest.folders.items() if v <= version}
        rows = _rows(table, Manifest(version, folders)).where(F.col("committed") <= version)
    else:
        rows = _rows(table, manifest)
    return _current(rows).select(*_COLUMNS)


def compact_runs(spark: SparkSession, path: str) -> None:
    """Rewrite the table as one folder without replaced rows.

    Commits made meanwhile stay; if another compaction was faster, this one is dropped. The old
    folders are left to their readers until ``CommittedTable.remove_unlisted``.
    """
    table = CommittedTable(spark, path)
    base = table.last()
    if len(base.folders) < 2:
        return
    folder = _write(_current(_rows(table, base)), table)

    def replaced(now: Manifest) -> dict[str, int | None]:
        if not set(base.folders) <= set(now.folders):
            raise CommitConflict("another compaction was faster")
        added = {f: v for f, v in now.folders.items() if f not in base.folders}
        return {folder: base.version, **added}

    table.commit(replaced)
