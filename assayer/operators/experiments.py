"""Experiment grids, and parameters and metrics in the form they are tracked."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import mul

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.vocabulary import ABLATION_ID_FORMAT

#: Combinations that a task makes, on average, of sweeps that have more.
ROWS_PER_TASK = 1_000_000

_SCALAR = (T.StringType, T.NumericType, T.BooleanType)


def _leaves(schema: T.StructType, parent: Column | None, prefix: str) -> list[tuple[str, Column]]:
    found = []
    for field in schema.fields:
        column = F.col(f"`{field.name}`") if parent is None else parent.getField(field.name)
        name = f"{prefix}.{field.name}" if prefix else field.name
        if isinstance(field.dataType, T.StructType):
            found += _leaves(field.dataType, column, name)
        elif isinstance(field.dataType, _SCALAR):
            found.append((name, column))
    return found


def flatten(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Nested structs as dotted columns; only string, number and boolean leaves stay.

    A map's keys differ from row to row, so maps have no columns; see ``flatten_params``.
    """
    nested = df.drop(*keep)
    return df.select(*keep, *[c.alias(name) for name, c in _leaves(nested.schema, None, "")])


_ENTRIES = "array<struct<key:string,value:string>>"


def _entries(column: Column, kind: T.DataType, key: Column) -> Column | None:
    """Entries ``(key, value)`` of all scalars in a column, through structs and maps alike."""
    if isinstance(kind, _SCALAR):
        return F.array(F.struct(key.alias("key"), column.cast("string").alias("value")))
    if isinstance(kind, T.StructType):
        parts = [
            _entries(column.getField(f.name), f.dataType, F.concat(key, F.lit(f".{f.name}")))
            for f in kind.fields
        ]
        parts = [p for p in parts if p is not None]
        return F.concat(*parts) if parts else None
    if isinstance(kind, T.MapType):
        probe = _entries(column, kind.valueType, key)
        if probe is None:
            return None
        nested = F.transform(
            F.map_entries(column),
            lambda e: _entries(
                e["value"], kind.valueType, F.concat(key, F.lit("."), e["key"].cast("string"))
            ),
        )
        return F.coalesce(F.flatten(nested), F.array().cast(_ENTRIES))
    return None


def flatten_params(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Nested parameters as rows ``(*keep, key, value)`` with dotted keys.

    Structs and maps are followed to any depth; lists and nulls are dropped.
    """
    found = [
        _entries(F.col(f"`{field.name}`"), field.dataType, F.lit(field.name))
        for field in df.drop(*keep).schema.fields
    ]
    entries = [e for e in found if e is not None]
    if not entries:
        raise ValueError("no scalar parameters to flatten")
    return df.select(*keep, F.inline(F.concat(*entries))).where(F.col("value").isNotNull())


def scalar_metrics(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Numeric and boolean columns as rows ``(*keep, key, value)``; others are dropped."""
    numeric = [
        F.col(f"`{field.name}`").cast("double").alias(field.name)
        if isinstance(field.dataType, T.NumericType)
        else F.col(f"`{field.name}`").cast("int").cast("double").alias(field.name)
        for field in df.drop(*keep).schema.fields
        if isinstance(field.dataType, (T.NumericType, T.BooleanType))
    ]
    if not numeric:
        raise ValueError("no scalar metrics")
    return (
        df.select(*keep, *numeric)
        .unpivot(list(keep), None, "key", "value")
        .where(F.col("value").isNotNull())
    )


def _combinations(sweeps: DataFrame, lists: Sequence[str]) -> float:
    sizes = [F.greatest(F.size(column), F.lit(0)).cast("double") for column in lists]
    return sweeps.agg(F.sum(reduce(mul, sizes))).first()[0] or 0.0


def expand_grid(
    sweeps: DataFrame,
    dimensions: Mapping[str, str],
    keep: Sequence[str] = (),
    id_format: str = ABLATION_ID_FORMAT,
) -> DataFrame:
    """All combinations of each sweep's lists, the last dimension varying fastest.

    ``dimensions`` maps output columns to array columns of ``sweeps``. ``run_id``
    numbers the combinations of a sweep from 1. There is no join: the combinations are counted
    first, and the sweeps, not their combinations, are dealt evenly over tasks that make about
    ``ROWS_PER_TASK`` each. Streams and fewer combinations than that are not shuffled.
    """
    if not sweeps.isStreaming:
        tasks = math.ceil(_combinations(sweeps, list(dimensions.values())) / ROWS_PER_TASK)
        if tasks > 1:
            sweeps = sweeps.select(*dict.fromkeys([*keep, *dimensions.values()])).repartition(tasks)
    index: Column = F.lit(0).cast("bigint")
    sizes = {f"__size_{name}": F.size(column) for name, column in dimensions.items()}
    expanded = sweeps.select(
        *keep,
        *[F.col(column).alias(f"__list_{name}") for name, column in dimensions.items()],
        *[size.alias(name) for name, size in sizes.items()],
    )
    for name in dimensions:
        expanded = expanded.select(
            "*", F.posexplode(f"__list_{name}").alias(f"__at_{name}", name)
        ).drop(f"__list_{name}")
        index = index * F.col(f"__size_{name}") + F.col(f"__at_{name}")
    run_id = F.format_string(id_format, index + 1).alias("run_id")
    return expanded.select(*keep, run_id, *dimensions)


def ablation_manifest(
    spark: SparkSession,
    models: Sequence[str],
    learning_rates: Sequence[float],
    lora_ranks: Sequence[int],
    data_mixtures: Sequence[str],
) -> DataFrame:
    """``(run_id, model, learning_rate, lora_rank, data_mixture)`` for one sweep's lists."""
    lists = {
        "model": (models, "array<string>"),
        "learning_rate": (learning_rates, "array<double>"),
        "lora_rank": (lora_ranks, "array<int>"),
        "data_mixture": (data_mixtures, "array<string>"),
    }
    sweep = spark.range(1).select(
        *[F.array(*map(F.lit, v)).cast(kind).alias(name) for name, (v, kind) in lists.items()]
    )
    return expand_grid(sweep, {name: name for name in lists})
