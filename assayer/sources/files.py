"""File sources and sinks: JSON lines, CSV manifests, labeled tables, reports."""

from __future__ import annotations

import logging
import re
from collections.abc import Sequence
from urllib.parse import unquote, urlparse

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


_log = logging.getLogger(__name__)

# Columns that order the rows of JSON lines as they stand in their files.
JSONL_ORDER = ["file", "block", "line"]


def read_jsonl(
    spark: SparkSession, path: str, schema: str | StructType, source_order: bool = False
) -> DataFrame:
    """JSON lines with a declared schema. Blank lines are skipped; a broken one fails the job.

    ``source_order`` adds the columns ``file``, ``block`` and ``line``, which sort the
    rows as they stand in the files.
    """
    rows = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    if not source_order:
        return rows
    return rows.select(
        "*",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        # A block is read in order by one task, so this number grows with its lines.
        F.monotonically_increasing_id().alias("line"),
    )


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines in ASCII with nulls kept."""
    (
        df.write.mode(mode)
        .option("ignoreNullFields", "false")
        .option("writeNonAsciiCharacterAsCodePoint", "true")
        .json(path)
    )


def write_csv(df: DataFrame, path: str, columns: Sequence[str], mode: str = "overwrite") -> None:
    """CSV with a header and a fixed column order."""
    df.select(*columns).write.mode(mode).option("header", "true").csv(path)


def read_labeled(
    spark: SparkSession,
    primary: str,
    mirror: str,
    text_field: str = "sentence",
    label_field: str = "label",
) -> DataFrame:
    """A labeled Parquet table, from the mirror when the primary one is missing or broken.

    The cause is logged. Denied access and throttling are errors, not causes for the mirror.

    Both have the same columns. Only those two, and the row's place in the source as
    ``file`` and ``row``, are read.
    """
    try:
        table = spark.read.parquet(primary)
    except (PySparkException, Py4JJavaError) as error:
        if re.search("AccessDenied|AccessControl|Forbidden|SlowDown|Throttl", str(error)):
            raise
        _log.warning("reading the mirror, since %s cannot be opened: %s", primary, error)
        table = spark.read.parquet(mirror)
    return table.select(
        F.col(text_field),
        F.col(label_field),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row"),
    )


def write_report(report: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Report rows as indented JSON; one file, since a report is a row per run at most."""
    row = F.to_json(F.struct(*report.columns), {"pretty": "true", "ignoreNullFields": "false"})
    report.select(row.alias("value")).coalesce(1).write.mode(mode).text(path)


def read_verified(
    spark: SparkSession,
    primary: str,
    mirror: str,
    text_field: str = "sentence",
    label_field: str = "label",
) -> DataFrame:
    """``read_labeled``, file by file: those of the primary table that cannot be read whole come
    from the mirror, which has files of the same names.

    Two passes look at every file first: one takes the row counts from the footers and reads
    no data, one decodes both columns of every row group and counts what came out. A file
    without a footer, or with fewer rows than its footer tells, is broken; each is logged. ``file``
    is the path below the table, so rows keep their order and numbers whichever table a file is from.
    A broken file that the mirror lacks is an error.
    """
    columns = [text_field, label_field]
    broken = broken_files(spark, primary, columns)
    for name in broken:
        _log.warning("reading %s from the mirror, since %s has it broken", name, primary)
    if not broken:
        return _named_rows(spark.read.parquet(primary), primary, columns)
    replaced = [f"{mirror.rstrip('/')}/{name}" for name in broken]
    tables = [_named_rows(spark.read.parquet(*replaced), mirror, columns)]
    whole = [name for name in _names(spark, primary) if name not in set(broken)]
    if whole:
        table = spark.read.option("ignoreCorruptFiles", "true").parquet(primary)
        rows = _named_rows(table, primary, columns)
        tables.insert(0, rows.where(~F.col("file").isin(broken)))
    return tables[0] if len(tables) == 1 else tables[0].unionByName(tables[1])


def broken_files(spark: SparkSession, path: str, columns: Sequence[str]) -> list[str]:
    """Paths below a Parquet table of the files whose footer or whose ``columns`` cannot be read."""
    names = _names(spark, path)
    try:
        table = spark.read.option("ignoreCorruptFiles", "true").parquet(path)
        table.select(*columns)
    except (PySparkException, Py4JJavaError):  # no file has a footer
        return names
    file = F.col("_metadata.file_path").alias("path")
    told = table.select(file).groupBy("path").agg(F.count("*").alias("told"))
    digest = F.xxhash64(*[F.col(c) for c in columns]).alias("digest")
    # The digest needs the values of every row.
    decoded = table.select(file, digest).groupBy("path").agg(
        F.count("*").alias("read"), F.max("digest").alias("digest")
    )
    whole = told.join(decoded, "path").where("told = read and digest is not null")
    good = {_below(row["path"], path) for row in whole.select("path").collect()}  # names only
    return [name for name in names if name not in good]


def _names(spark: SparkSession, path: str) -> list[str]:
    """Paths below a table of the files that Spark would read, in order; none is opened."""
    return sorted(_below(file, path) for file in spark.read.schema("x INT").parquet(path).inputFiles())


def _below(file: str, path: str) -> str:
    """The part of a file's path below a table's, whatever scheme either is given with."""
    at = unquote(urlparse(file).path)
    root = urlparse(path).path.rstrip("/")
    return at.removeprefix(root).lstrip("/") or at.rsplit("/", 1)[-1]


def _named_rows(table: DataFrame, path: str, columns: Sequence[str]) -> DataFrame:
    root = urlparse(path).path.rstrip("/")
    full = F.call_function("url_decode", F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    at = F.instr(full, root) + len(root) + 1
    return table.select(
        *columns,
        F.substring(full, at, F.length(full)).alias("file"),
        F.col("_metadata.row_index").alias("row"),
    )
