"""Best-fit packing planned over the histogram of lengths.

Documents become pieces of at most ``capacity`` tokens. The plan is made from the number
of pieces of each length alone: groups of equal sequences, best-fit decreasing, thousands of
copies in one step, so it stays small however many documents there are. Pieces then
get their rank among the pieces of their length, from one range partitioning without a
hot key, and the rank says which slot of the plan is theirs.

Defined results: a null or empty text is one piece, the end token alone; repeated rows
each get their own pieces and slots; an empty table has none; other columns are not read.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.positions import with_position
from ..session import written
from .common import Batches, arrow_schema, texts_of
from .tokens import text_encoder

CAPACITY = 1024
END_TOKEN = 2


@dataclass(frozen=True)
class Run:
    """Pieces of one length, by rank from ``first``: each sequence from ``sequence`` on takes
    ``each`` of them, beginning at ``offset``."""

    length: int
    first: int
    count: int
    sequence: int
    each: int
    offset: int


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[list[Run], int]:
    """Best-fit decreasing over counts: the runs, and the number of sequences.

    ``open_at[r]`` has the ``(first sequence, number)`` of sequences with ``r`` tokens left.
    """
    runs: list[Run] = []
    open_at: dict[int, list[tuple[int, int]]] = {}
    rests: list[int] = []  # the keys of open_at, ascending
    made = 0

    def leave(rest: int, first: int, number: int) -> None:
        if rest and number:
            if rest not in open_at:
                open_at[rest] = []
                bisect.insort(rests, rest)
            open_at[rest].append((first, number))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            at = bisect.bisect_left(rests, length)
            if at < len(rests):
                rest = rests[at]
                first, number = open_at[rest].pop()
                if not open_at[rest]:
                    del open_at[rest], rests[at]
            else:
                rest, first = capacity, made
                number = -(-left // (capacity // length))
                made += number
            each = rest // length
            full = min(number, left // each)
            if full:
                runs.append(Run(length, rank, full * each, first, each, capacity - rest))
                leave(rest - each * length, first, full)
                rank, left, first, number = rank + full * each, left - full * each, first + full, number - full
            if number and left:  # fewer pieces than one more sequence could take
                runs.append(Run(length, rank, left, first, left, capacity - rest))
                leave(rest - left * length, first, 1)
                rank, left, first, number = rank + left, 0, first + 1, number - 1
            leave(rest, first, number)
    return runs, made


def cut(n: int, capacity: int) -> Iterator[tuple[int, int]]:
    """``(start, length)`` of the pieces of ``n`` tokens; only the first may be shorter."""
    start, length = 0, n % capacity or capacity
    while start < n:
        yield start, length
        start, length = start + length, capacity


def token_pieces(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    keep_ids: bool = False,
) -> DataFrame:
    """``id, piece, start, length, ids_crc32`` of each piece, and its ``ids`` if asked for."""
    texts = texts_of(docs, id_col, text_col)
    kind = texts.schema["id"].dataType.simpleString()
    schema = f"id {kind}, piece int, start long, length int, ids_crc32 long"
    schema += ", ids array<int>" * keep_ids
    target = arrow_schema(schema)
    end = np.array([END_TOKEN], "<u4").tobytes()

    def run(batches: Batches) -> Batches:
        encode = text_encoder()
        for batch in batches:
            columns: dict[str, list] = {name: [] for name in target.names}
            rows: list[int] = []
            for row, text in enumerate(batch.column(1).to_pylist()):
                ids = encode(text) + end
                for piece, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    own = ids[4 * start : 4 * (start + length)]
                    rows.append(row)
                    columns["piece"].append(piece)
                    columns["start"].append(start)
                    columns["length"].append(length)
                    columns["ids_crc32"].append(zlib.crc32(own))
                    if keep_ids:
                        columns["ids"].append(np.frombuffer(own, "<i4"))
            columns["id"] = batch.column(0).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [
                    c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type)
                    for c, f in zip(columns.values(), target)
                ],
                schema=target,
            )

    return texts.mapInArrow(run, schema)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with the ``sequence_id`` and ``offset`` of each."""
    held = written(pieces, "pieces")
    order = ["length", "id", "piece", "ids_crc32"]
    placed = with_position(held, order, "__position")
    counts = {r["length"]: r["count"] for r in placed.groupBy("length").count().collect()}
    runs, _ = plan(counts, capacity)
    # Positions go by length first, so a run of ranks is also a run of positions.
    before, starts = 0, {}
    for length in sorted(counts):
        starts[length] = before
        before += counts[length]
    runs = sorted(runs, key=lambda r: starts[r.length] + r.first)
    firsts = np.array([starts[r.length] + r.first for r in runs], np.int64)
    table = np.array([[r.sequence, r.each, r.offset, r.length] for r in runs], np.int64)
    names = [c for c in placed.columns if c != "__position"]
    out = placed.select(*names, "__position")
    schema = ", ".join(f"`{n}` {t}" for n, t in out.dtypes if n != "__position")
    schema += ", sequence_id long, offset int"
    target = arrow_schema(schema)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            position = batch.column(batch.num_columns - 1).to_numpy()
            at = np.searchsorted(firsts, position, side="right") - 1
            sequence, each, offset, length = table[at].T if len(table) else np.zeros((4, 0), int)
            rank = position - firsts[at] if len(table) else position
            columns = [
                *batch.columns[:-1],
                pa.array(sequence + rank // each, pa.int64()),
                pa.array((offset + rank % each * length).astype(np.int32), pa.int32()),
            ]
            yield pa.RecordBatch.from_arrays(
                [c.cast(f.type) for c, f in zip(columns, target)], schema=target
            )

    return out.mapInArrow(run, schema)


def pack_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    keep_ids: bool = False,
) -> DataFrame:
    """Tokenise, cut and pack: one row per piece."""
    return pack(token_pieces(docs, id_col, text_col, capacity, keep_ids), capacity)


def sequences(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``sequence_id, ids, starts``: the packed sequences themselves, of pieces with ``ids``.

    A sequence has at most ``capacity`` pieces, so no group can be large.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return (
        packed.groupBy("sequence_id")
        .agg(parts.alias("parts"))
        .select(
            "sequence_id",
            F.flatten(F.col("parts.ids")).alias("ids"),
            F.col("parts.offset").alias("starts"),
        )
    )


