"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings the library is tuned for; ``settings`` override them."""
    builder = SparkSession.builder.appName("assayer")
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Texts may be long: keep the batches that go to Python scorers small.
        "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
        "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
    }
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    A local session that names none gets a temporary one; on a cluster a
    machine-local folder would not survive or be shared, so its absence is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = _local_folder()
    return folder


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="assayer-")


def _application_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/assayer-{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, name: str) -> str:
    """An unused path in the shared folder, below a folder of this application's own."""
    return f"{_application_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to a Parquet table in the shared folder, and read back.

    Cuts the lineage, fixes non-deterministic columns, and lets later passes read
    only the columns they need.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_written(spark: SparkSession) -> None:
    """Delete the tables this application has written to the shared folder.

    For the end of a job: frames that still read from them cannot be used afterwards.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(_application_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
