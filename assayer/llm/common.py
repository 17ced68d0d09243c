"""Helpers shared by the operators: batches of texts, free column names, filtered rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

Batches = Iterator[pa.RecordBatch]


def texts_of(df: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """``id, text`` (null: empty) and further columns, and nothing else, under fixed names."""
    return df.select(
        F.col(f"`{id_col}`").alias("id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
        *[F.col(f"`{name}`") for name in more],
    )


def annotate(
    df: DataFrame,
    text_col: str,
    make: Callable[[], Callable[[bytes], dict]],
    added: str,
    keep: Iterable[str] | None = None,
) -> DataFrame:
    """The ``keep`` columns (all by default) and the ``added`` ones, which a function, made
    once per task, finds from the text's UTF-8 bytes (null: empty)."""
    names = df.columns if keep is None else list(keep)
    fields = arrow_schema(added)
    kept = df.select(*[F.col(f"`{n}`") for n in names]).schema
    schema = StructType([*kept.fields, *StructType.fromDDL(added).fields])
    at = df.columns.index(text_col)
    places = [df.columns.index(n) for n in names]

    def run(batches: Batches) -> Batches:
        function = make()
        for batch in batches:
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            rows = [function(text or b"") for text in texts]
            found = pa.RecordBatch.from_pylist(rows, schema=fields)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in places], *found.columns],
                names=[*names, *fields.names],
            )

    return df.mapInArrow(run, schema)


def filter_rows(
    df: DataFrame, text_col: str, make: Callable[[], Callable[[bytes], bool]]
) -> DataFrame:
    """The rows, all columns unchanged, whose text's UTF-8 bytes (null: empty) pass."""
    at = df.columns.index(text_col)

    def run(batches: Batches) -> Batches:
        passes = make()
        for batch in batches:
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            yield batch.filter(pa.array([passes(t or b"") for t in texts], pa.bool_()))

    return df.mapInArrow(run, df.schema)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def arrow_schema(schema: str) -> pa.Schema:
    """Arrow's form of a schema in DDL; to be called on the driver."""
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(StructType.fromDDL(schema))


def in_rows(rows: Iterable[dict], schema: pa.Schema, size: int = 1000) -> Batches:
    """Record batches of at most ``size`` rows each."""
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def spans_text(spans: Column, kinds: Sequence[str]) -> Column:
    """``kind:start:end`` of spans, by start, then by the order of the kinds."""
    order = F.array(*map(F.lit, kinds))
    keyed = F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"),
            F.array_position(order, s["kind"]).alias("order"),
            s["end"].alias("end"),
            s["kind"].alias("kind"),
        ),
    )
    return F.array_join(
        F.transform(
            F.array_sort(keyed), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
        ),
        ",",
    )
