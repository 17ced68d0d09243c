"""Which windows of a document also start in another, over any number of documents.

Documents are written once in batches of about half a megabyte, compressed. A batch sends the
sorted hashes of its distinct windows to ranges of the hash space; a range's task
compares the batches and answers each with one bit per hash; and each batch meets its
answers again, where they become places in its texts. A common window is sent once by
each batch, not by each document, so no range can be hot, and what moves is
some eight bytes per distinct window, however long or common it is.

Two windows with the same 64-bit hash count as equal. Among ``n`` windows about
``n * n / 2**65`` pairs of different ones are expected to be: one in the nine billion windows of
30 GB.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from .common import Batches, arrow_schema

BATCH_BYTES = 1 << 19
#: So that a document's number within its batch is one byte.
BATCH_DOCS = 256
#: Hashes that one range's task compares, at about 40 bytes each.
RANGE_KEYS = 1_000_000
#: Stands for a null id: greater than any other.
NO_ID = (1 << 63) - 1

_BASE = np.uint64(0x9E3779B97F4A7C15)
_LEVEL = 6


@dataclass
class Batch:
    """Documents in the order of their ids."""

    number: int
    ids: np.ndarray
    texts: list[bytes]


def write_batches(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    most_bytes: int | None = None,
    most_docs: int | None = None,
) -> DataFrame:
    """``batch, bytes, ids, ends, payload``; ids are whole numbers.

    A batch ends with the document that reaches ``BATCH_BYTES`` or ``BATCH_DOCS``, or the numbers
    given instead.
    """
    most_bytes, most_docs = most_bytes or BATCH_BYTES, most_docs or BATCH_DOCS
    texts = docs.select(
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID)).alias("id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )
    schema = "batch long, bytes long, ids array<long>, ends array<long>, payload binary"
    target = arrow_schema(schema)

    def run(batches: Batches) -> Batches:
        import zstandard
        from pyspark import TaskContext

        pack = zstandard.ZstdCompressor(level=_LEVEL).compress
        number = TaskContext.get().partitionId() << 32
        held: list[tuple[int, bytes]] = []

        def row() -> pa.RecordBatch:
            held.sort(key=lambda d: d[0])
            ends = np.cumsum([len(t) for _, t in held])
            payload = pack(b"".join(t for _, t in held))
            values = [[number], [int(ends[-1])], [[i for i, _ in held]], [ends], [payload]]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, f.type) for v, f in zip(values, target)], schema=target
            )

        size = 0
        for batch in batches:
            found = batch.column(1).cast(pa.binary()).to_pylist()
            for doc, text in zip(batch.column(0).to_pylist(), found):
                held.append((doc, text))
                size += len(text)
                if size >= most_bytes or len(held) == most_docs:
                    yield row()
                    number, held, size = number + 1, [], 0
        if held:
            yield row()

    return written(texts.mapInArrow(run, schema), "batches")


def read_batches(table: pa.RecordBatch | pa.Table) -> Iterator[Batch]:
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    for row in table.select(["batch", "bytes", "ids", "ends", "payload"]).to_pylist():
        data = unpack(row["payload"], max_output_size=row["bytes"]) if row["bytes"] else b""
        ends = row["ends"]
        texts = [data[a:b] for a, b in zip([0, *ends], ends)]
        yield Batch(row["batch"], np.array(row["ids"], np.int64), texts)


def mixed(keys: np.ndarray) -> np.ndarray:
    """Hashes with all bits stirred, so that ranges of them are even."""
    keys = keys ^ (keys >> np.uint64(33))
    keys = keys * np.uint64(0xFF51AFD7ED558CCD)
    keys ^= keys >> np.uint64(33)
    keys *= np.uint64(0xC4CEB9FE1A85EC53)
    return keys ^ (keys >> np.uint64(33))


def joined(left: np.ndarray, right: np.ndarray, size: int) -> np.ndarray:
    """Rabin-Karp: hashes of strings from those of a first part and of ``size`` units after."""
    return left * np.uint64(pow(int(_BASE), size, 1 << 64)) + right


def rolled(codes: np.ndarray, size: int) -> np.ndarray:
    """Rabin-Karp hashes of all windows of ``size`` units, by doubling."""
    n = len(codes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    have, width, out, done = codes, 1, None, 0
    left = size
    while left:
        if left & 1:
            part = have[done : done + n] if out is not None else have[:n]
            out = part.copy() if out is None else joined(out, part, width)
            done += width
        left >>= 1
        if left:
            have = joined(have[:-width], have[width:], width)
            width *= 2
    return out


def _packed(keys: np.ndarray) -> bytes:
    """Sorted numbers by their differences, byte by byte, compressed."""
    import zstandard

    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    planes = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    steps = np.ascontiguousarray(planes.reshape(8, -1).T).view("<u8").reshape(-1)
    return np.cumsum(steps, dtype=np.uint64)


def packed_numbers(numbers: np.ndarray, cuts: np.ndarray, steps: bool = False) -> list[bytes]:
    """The numbers between each two ``cuts`` that differ, byte by byte, without the high bytes
    that all lack; with ``steps`` they ascend there, and their differences are.

    Not compressed: low bytes are random, and equal high ones are left to Spark's shuffle.
    """
    own = np.flatnonzero(cuts[1:] > cuts[:-1])
    if steps:
        held = np.diff(numbers, prepend=np.uint64(0))
        held[cuts[own]] = numbers[cuts[own]]
        numbers = held
    width = max(1, -(-int(numbers.max(initial=0)).bit_length() // 8))
    held = numbers.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8)
    planes = np.ascontiguousarray(held[:, :width].T)
    edges = zip(cuts[own].tolist(), cuts[own + 1].tolist())
    return [planes[:, a:b].tobytes() for a, b in edges]


def unpacked_numbers(data: bytes, n: int, steps: bool = False) -> np.ndarray:
    numbers = np.zeros((n, 8), np.uint8)
    planes = np.frombuffer(data, np.uint8).reshape(-1, n)
    numbers[:, : len(planes)] = planes.T
    numbers = numbers.view("<u8").reshape(-1)
    return np.cumsum(numbers, dtype=np.uint64) if steps else numbers


def distinct(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, the first document of each, and for each given key its place among them.

    ``docs`` ascends.
    """
    found, first, place = np.unique(keys, return_index=True, return_inverse=True)
    return found, docs[first], place


def _cuts(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Where each of ``ranges`` equal ranges of the hash space begins in sorted keys."""
    edges = np.array([(i << 64) // ranges for i in range(1, ranges)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def ranges_for(batches: DataFrame, keys_per_byte: float) -> int:
    total = batches.agg(F.sum("bytes")).first()[0] or 0
    return max(1, int(total * keys_per_byte / RANGE_KEYS))


QUESTIONS = "range int, batch long, ids binary, keys binary, docs binary"
ANSWERS = "batch long, range int, bits binary"

#: Sets of questions: distinct sorted keys of a batch, the number of the first document of
#: each, the first range that is theirs, and the number of their ranges.
Asked = tuple[np.ndarray, np.ndarray, int, int]
Ask = Callable[[Batch, "Answers"], list[Asked]]


class Answers:
    """The bits of one batch, by rounds."""

    def __init__(self, rows: list[dict]):
        self.bits = {r["range"]: r["bits"] for r in rows}

    def of(self, keys: np.ndarray, first: int, ranges: int) -> np.ndarray:
        """One boolean for each of the sorted keys that the batch has sent to these ranges."""
        out = np.zeros(len(keys), bool)
        cuts = _cuts(keys, ranges)
        for i in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
            bits = np.frombuffer(self.bits[first + i], np.uint8)
            out[cuts[i] : cuts[i + 1]] = np.unpackbits(bits, count=int(cuts[i + 1] - cuts[i]))
        return out


def _questions(batch: Batch, sets: list[Asked]) -> pa.RecordBatch:
    ids = batch.ids.tobytes()
    rows = []
    for keys, docs, first, ranges in sets:
        cuts = _cuts(keys, ranges)
        rows += [
            {
                "range": first + i,
                "batch": batch.number,
                "ids": ids,
                "keys": _packed(keys[cuts[i] : cuts[i + 1]]),
                "docs": docs[cuts[i] : cuts[i + 1]].astype(np.uint8).tobytes(),
            }
            for i in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist()
        ]
    return pa.RecordBatch.from_pylist(rows, schema=_QUESTIONS)


_QUESTIONS = pa.schema(
    [("range", pa.int32()), ("batch", pa.int64()), ("ids", pa.binary()), ("keys", pa.binary()),
     ("docs", pa.binary())]
)


def ask(
    batches: DataFrame,
    answers: DataFrame | None,
    question: Ask,
    make: Callable[[Batch, list], pa.RecordBatch] = _questions,
    schema: str = QUESTIONS,
) -> DataFrame:
    """The questions of all batches, which may build on the answers to earlier ones; ``make``
    makes their rows of sets."""
    if answers is None:

        def run(tables: Batches) -> Batches:
            for table in tables:
                for batch in read_batches(table):
                    yield make(batch, question(batch, Answers([])))

        return batches.mapInArrow(run, schema)

    def again(table: pa.Table, rows: pa.Table) -> pa.Table:
        (batch,) = read_batches(table)
        sets = question(batch, Answers(rows.to_pylist()))
        return pa.Table.from_batches([make(batch, sets)])

    return meet(batches, answers, again, schema)


def meet(batches: DataFrame, answers: DataFrame, function: Callable, schema: str) -> DataFrame:
    return batches.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(function, schema)


#: From a range's number, and the keys and first ids of its batches, the bits of each batch.
Compare = Callable[[int, list[np.ndarray], list[np.ndarray]], list[np.ndarray]]


def answer(questions: DataFrame, compare: Compare) -> DataFrame:
    """One bit for each key of each question, found by comparing all questions of a range."""
    target = arrow_schema(ANSWERS)

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        keys = [_unpacked(r["keys"]) for r in rows]
        ids = [
            np.frombuffer(r["ids"], np.int64)[np.frombuffer(r["docs"], np.uint8)]
            if r["docs"]
            else np.zeros(0, np.int64)
            for r in rows
        ]
        return pa.Table.from_pylist(
            [
                {"batch": r["batch"], "range": r["range"], "bits": np.packbits(bits).tobytes()}
                for r, bits in zip(rows, compare(rows[0]["range"], keys, ids))
            ],
            schema=target,
        )

    return questions.groupBy("range").applyInArrow(run, ANSWERS)


def results(batches: DataFrame, answers: DataFrame, finish: Callable, schema: str) -> DataFrame:
    """Rows that ``finish(batch, answers)`` makes of each batch, as dictionaries."""
    target = arrow_schema(schema)

    def run(table: pa.Table, rows: pa.Table) -> pa.Table:
        (batch,) = read_batches(table)
        return pa.Table.from_pylist(finish(batch, Answers(rows.to_pylist())), schema=target)

    return meet(batches, answers, run, schema)


def covered(starts: np.ndarray, size: int) -> np.ndarray:
    """Which units windows of ``size`` cover, of as many units as ``starts`` has windows,
    plus ``size - 1``."""
    edges = np.zeros(len(starts) + size, np.int32)
    edges[: len(starts)] += starts
    edges[size:] -= starts
    return np.cumsum(edges[:-1]) > 0


def seen_before(keys: list[np.ndarray], ids: list[np.ndarray]) -> list[np.ndarray]:
    """Whether a smaller id than the batch's own smallest has a key."""
    all_keys, all_ids = np.concatenate(keys), np.concatenate(ids)
    order = np.argsort(all_keys, kind="stable")
    new = np.concatenate([[True], all_keys[order[1:]] != all_keys[order[:-1]]])
    least = np.minimum.reduceat(all_ids[order], np.flatnonzero(new))
    bits = np.empty(len(order), bool)
    bits[order] = all_ids[order] > least[np.cumsum(new) - 1]
    return np.split(bits, np.cumsum([len(k) for k in keys])[:-1])
