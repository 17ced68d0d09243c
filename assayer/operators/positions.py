"""Dense global row positions without a global window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

#: Blocks of a source whose offsets are broadcast, some 100 bytes each; more are joined as Spark
#: plans it.
_BROADCAST_BLOCKS = 1_000_000

# monotonically_increasing_id() keeps the partition in the bits above this one and
# the row's number within its partition in the bits below.
_ROW_BITS = 33


def _offsets(df: DataFrame, part: str, row: str) -> DataFrame:
    """Per value of ``part``, a partition or file, the number of rows in all earlier values.

    Rows are counted by the last number in use, so that positions stay distinct even
    where rows have been filtered out.
    """
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.groupBy(part)
        .agg((F.max(row) + 1).alias("n"))
        .select(part, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__offset"))
    )


def _with_offsets(
    df: DataFrame, offsets: DataFrame, part: str, row: str, name: str
) -> DataFrame:
    return (
        df.join(offsets, part)
        .withColumn(name, F.col("__offset") + F.col(row))
        .drop("__offset")
    )


def with_position(
    df: DataFrame, order_by: list[str], name: str = "position", partitions: int | None = None
) -> DataFrame:
    """Add the 0-based position of each row in ``order_by`` order, which must be unique.

    The rows are range-partitioned and sorted in parallel and written once, see
    ``number_partitions``. ``partitions`` defaults to ``spark.sql.shuffle.partitions``.
    """
    ranged = (
        df.repartitionByRange(partitions, *order_by)
        if partitions
        else df.repartitionByRange(*order_by)
    )
    return number_partitions(ranged.sortWithinPartitions(*order_by), name)


def number_partitions(df: DataFrame, name: str = "position") -> DataFrame:
    """Add the 0-based position of each row, partition after partition, as the rows stand in them.

    The rows are written once with their partition and their place in it; a second pass over
    that one narrow column counts the rows per partition.
    """
    placed = written(df.withColumn("__place", F.monotonically_increasing_id()), "placed")
    split = placed.withColumns(
        {
            "__part": F.shiftright("__place", _ROW_BITS),
            "__row": F.col("__place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)),
        }
    )
    # One row per shuffle partition.
    offsets = F.broadcast(_offsets(split, "__part", "__row"))
    return _with_offsets(split, offsets, "__part", "__row", name).drop("__part", "__row", "__place")


def with_source_position(
    df: DataFrame,
    file: str = "file",
    row: str = "row",
    name: str = "position",
    whole: DataFrame | None = None,
) -> DataFrame:
    """Add the 0-based position of rows that know their file and their row within it.

    Files count in path order. Where ``df`` lacks rows of its source, the whole source (at
    least its columns ``file`` and ``row``) is given as ``whole``, or else positions after
    missing rows may be lower than in the source. Nothing but the row counts of the files
    is shuffled to number them; they are written, one row per file, so that the join with
    them is planned by their true size.
    """
    source = df if whole is None else whole
    offsets = written(_offsets(source.select(file, row), file, row), "offsets")
    return _with_offsets(df, offsets, file, row, name)


def with_line_position(
    df: DataFrame, file: str = "file", block: str = "block", line: str = "line", name: str = "position"
) -> DataFrame:
    """Add the 0-based position of rows that know their file, the block that they were read from,
    and a number that grows by one from line to line of a block.

    Files count in path order. The rows are written once as they come, which fixes their
    blocks, and are neither sorted nor shuffled: a second pass over those three columns counts
    the lines of each block, and a third adds the sum of the blocks before.
    """
    placed = written(df, "lines")
    before = Window.orderBy(file, block).rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        placed.groupBy(file, block)
        .agg(F.min(line).alias("__first"), (F.max(line) - F.min(line) + 1).alias("__n"))
        .select(
            F.col(file).alias("__file"),
            F.col(block).alias("__block"),
            (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__offset"),
        )
    )
    offsets = written(blocks, "line-offsets")
    if offsets.count() <= _BROADCAST_BLOCKS:
        offsets = F.broadcast(offsets)
    same = (F.col(file) == F.col("__file")) & (F.col(block) == F.col("__block"))
    return (
        placed.join(offsets, same)
        .withColumn(name, F.col("__offset") + F.col(line))
        .drop("__file", "__block", "__offset")
    )
