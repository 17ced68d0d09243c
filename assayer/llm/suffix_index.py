"""Suffix-array dedup on bytes with a logarithmic family of index levels.

A byte is removed if it lies in a string of ``LENGTH`` bytes that also starts in a document with
a smaller id. Every batch of documents gets an array of its suffixes, sorted; equality is all
that a match of fixed length asks for, so the order is that of a hash of the
suffix's first ``LENGTH`` bytes, and the arrays fall into ranges of that hash, one task each.
In a range, the arrays enter a family of levels one by one: a level is merged into the
next as soon as it is about as large, so there are as many levels as the logarithm of
the batches and an entry moves that often. Then each batch's array is merge-scanned against
all levels for suffixes that begin in a smaller document.

Only suffixes that can match are indexed. First, each string of ``LENGTH`` bytes names its least
``GRAM``-byte substring by hash, its anchor; equal strings have equal anchors. Consecutive
strings with one anchor make a stretch. If a smaller document has the whole stretch, or the
whole text, its strings are repeats that need no entries. If all stretches with its anchor are
equal, or first occur in one document, no other string can match. Only ends of passages and
their first occurrences there are left, and chance hits of anchors.

Batches are of some megabytes, as each sends a row to every range, and there are as many ranges
as the corpus is large.

Defined results: a null or empty text has no bytes; rows with the same id do not remove each
other's bytes; a null id counts as greater than any other; an empty table gives an empty
one; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from . import windows
from .common import arrow_schema
from .windows import (
    ANSWERS,
    NO_ID,
    Answers,
    Batch,
    ask,
    joined,
    meet,
    mixed,
    packed_numbers,
    read_batches,
    seen_before,
    unpacked_numbers,
    write_batches,
)

LENGTH = 50
GRAM = 24
#: Bytes and documents of a batch, which sends one row at most to each range.
BATCH_BYTES = 1 << 23
BATCH_DOCS = 1 << 16
#: Expected entries per byte of text, for the numbers of ranges only.
_ANCHORS, _SUFFIXES = 0.07, 0.1
#: Strings whose hashes are made at once, so that they stay in the cache.
_BLOCK = 1 << 15


class Levels:
    """Sorted arrays of keys with the smallest id of each; equal-sized ones merge."""

    def __init__(self) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, keys: np.ndarray, ids: np.ndarray) -> None:
        while self.levels and len(self.levels[-1][0]) <= 2 * len(keys):
            keys, ids = _merged(self.levels.pop(), (keys, ids))
        self.levels.append((keys, ids))

    def least(self, keys: np.ndarray) -> np.ndarray:
        """The smallest id that any level has for each key; ``NO_ID`` if none."""
        out = np.full(len(keys), NO_ID)
        for own, ids in self.levels:
            at = np.minimum(np.searchsorted(own, keys), len(own) - 1)
            hit = own[at] == keys
            out[hit] = np.minimum(out[hit], ids[at[hit]])
        return out


def _merged(
    left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]
) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([left[0], right[0]])
    ids = np.concatenate([left[1], right[1]])
    order = np.argsort(keys, kind="stable")  # two sorted runs: a merge
    keys, ids = keys[order], ids[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[starts], np.minimum.reduceat(ids, starts)


def scan_levels(keys: list[np.ndarray], ids: list[np.ndarray]) -> list[np.ndarray]:
    """Whether a smaller id than the batch's own smallest has a key."""
    index = Levels()
    for own, least in zip(keys, ids):
        index.add(own, least)
    return [index.least(own) < least for own, least in zip(keys, ids)]


def _order(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stable order of numbers, and the numbers in it: sorts places in their low bits along."""
    low = np.uint64(max(1, len(keys) - 1).bit_length())
    mask = (np.uint64(1) << low) - np.uint64(1)
    order = np.sort((keys & ~mask) | np.arange(len(keys), dtype=np.uint64))
    order = (order & mask).astype(np.int64)
    found = keys[order]
    if (found[1:] < found[:-1]).any():  # numbers that differ in the low bits only
        order = np.argsort(keys, kind="stable")
        found = keys[order]
    return order, found


def _starts(ordered: np.ndarray) -> np.ndarray:
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    return new


class _Distinct:
    """The distinct keys of a batch, sorted, with the smallest id and one occurrence of each;
    ``place`` has each key's place among them."""

    def __init__(self, keys: np.ndarray, ids: np.ndarray):
        order, found = _order(keys)
        new = _starts(found)
        starts = np.flatnonzero(new)
        self.keys, self.one = found[starts], order[starts]
        self.ids = np.minimum.reduceat(ids[order], starts) if len(starts) else ids[:0]
        self.place = np.empty(len(keys), np.int64)
        self.place[order] = np.cumsum(new) - 1


def _compared(keys: list, anchors: list, ids: list) -> list[np.ndarray]:
    """For each stretch of each batch, whether a smaller id than the batch's smallest has it,
    and then whether strings of it can be in other stretches: its anchor has several that first
    occur in different documents."""
    all_keys, all_ids = np.concatenate(keys), np.concatenate(ids)
    found = _Distinct(all_keys, all_ids)
    seen = all_ids > found.ids[found.place]
    order, ordered = _order(np.concatenate(anchors)[found.one])
    new = _starts(ordered)
    starts, least = np.flatnonzero(new), found.ids[order]
    several = np.minimum.reduceat(least, starts) != np.maximum.reduceat(least, starts)
    open_ = np.empty(len(order), bool)
    open_[order] = several[np.cumsum(new) - 1]
    cuts = np.cumsum([len(k) for k in keys])[:-1]
    both = zip(np.split(seen, cuts), np.split(open_[found.place], cuts))
    return [np.concatenate(pair) for pair in both]


def _least_of(values: np.ndarray, size: int) -> np.ndarray:
    """Minimum of every ``size`` consecutive values."""
    width = 1
    while 2 * width <= size:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    return np.minimum(values[: len(values) - (size - width)], values[size - width :])


def _spanned(codes: np.ndarray, width: int, size: int) -> np.ndarray:
    """Rabin-Karp hashes of all strings of ``size`` from the codes of those of ``width``, which
    may overlap at the end."""
    while 2 * width <= size:
        codes = joined(codes[:-width], codes[width:], width)
        width *= 2
    rest = size - width
    return joined(codes[:-rest], codes[rest:], rest) if rest else codes


class _Suffixes:
    """The strings of ``length`` bytes of a batch in runs with one anchor, which lie in one
    document: ``first`` string and ``counts``, ``doc``, ``anchor`` and the ``stretch``, a hash
    of all bytes of the run's strings."""

    def __init__(self, batch: Batch, length: int, gram: int):
        self.data = b"".join(batch.texts)
        self.sizes = np.array([len(t) for t in batch.texts], np.int64)
        self.ends = np.cumsum(self.sizes)
        self.length = length
        self.word = min(8, gram, length)
        self.padded = self.data + bytes(8)
        n = max(0, len(self.data) - length + 1)
        edges = np.concatenate(
            [self.ends - self.sizes, np.maximum(self.ends - self.sizes, self.ends - length + 1)]
        )
        edges = np.unique(edges[edges < n])
        none = np.zeros(0, np.uint64)
        firsts, anchors, heads, tails = [], [none], [none], [none]
        before = none
        for a in range(0, n, _BLOCK):
            b = min(n, a + _BLOCK)
            codes = self._codes(slice(a, b + length - self.word))
            grams = _spanned(codes, self.word, gram)
            hashes = _spanned(codes, self.word, length)
            least = _least_of(grams, length - gram + 1)
            new = np.ones(b - a, bool)
            new[1:] = least[1:] != least[:-1]
            if len(before):
                new[0] = least[0] != before[0]
            new[edges[slice(*np.searchsorted(edges, [a, b]))] - a] = True
            found = np.flatnonzero(new)
            firsts.append(found + a)
            anchors.append(least[found])
            heads.append(hashes[found])
            # The last string of the run before each.
            tails += [before[1:]] if new[0] else []
            tails.append(hashes[found[int(new[0]) :] - 1])
            before = np.array([least[-1], hashes[-1]], np.uint64)
        first = np.concatenate([*firsts, np.zeros(0, np.int64)])
        counts = np.diff(np.append(first, n))
        doc = np.searchsorted(self.ends, first, "right")
        inside = first + length <= self.ends[doc] if n else np.zeros(0, bool)
        last = np.concatenate([*tails, before[1:]])
        self.first, self.counts, self.doc = first[inside], counts[inside], doc[inside]
        self.anchor = mixed(np.concatenate(anchors)[inside])
        heads = joined(np.concatenate(heads)[inside], last[inside], length)
        # First and last string have all bytes of a run, but of a long one.
        self.stretch = mixed(heads ^ mixed(self.counts.astype(np.uint64)))
        for i in np.flatnonzero(self.counts > length).tolist():
            self.stretch[i] = self._hash(int(self.first[i]), int(self.counts[i]) + length - 1)

    def _codes(self, at: slice | np.ndarray) -> np.ndarray:
        """Hashes of the words of up to 8 bytes that start at the given places."""
        codes = np.ndarray((len(self.data),), "<u8", self.padded, 0, (1,))[at].astype(np.uint64)
        if self.word < 8:
            codes &= np.uint64((1 << 8 * self.word) - 1)
        codes ^= codes >> np.uint64(32)
        codes *= np.uint64(0xFF51AFD7ED558CCD)
        codes ^= codes >> np.uint64(29)
        codes *= np.uint64(0xC4CEB9FE1A85EC53)
        codes ^= codes >> np.uint64(32)
        return codes

    def _hash(self, start: int, size: int) -> int:
        import xxhash

        return xxhash.xxh64_intdigest(memoryview(self.data)[start : start + size])

    def strings(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, hash and document of each string in the given runs."""
        counts = self.counts[runs]
        starts = np.repeat(self.first[runs] - np.cumsum(counts) + counts, counts)
        starts += np.arange(len(starts))
        # Where the words are whose codes ``_spanned`` joins.
        offsets, width = [0], self.word
        while 2 * width <= self.length:
            offsets += [o + width for o in offsets]
            width *= 2
        if self.length > width:
            offsets += [o + self.length - width for o in offsets]
        hashes = np.empty(len(starts), np.uint64)
        for a in range(0, len(starts), _BLOCK):
            at = starts[a : a + _BLOCK]
            held = np.zeros(len(at), np.uint64)
            for offset in offsets:
                held = joined(self._codes(at + offset), held, self.length - self.word - offset)
            hashes[a : a + _BLOCK] = held
        return starts, mixed(hashes), np.repeat(self.doc[runs], counts)


def _copies(batch: Batch) -> _Distinct:
    """The hashes of whole texts."""
    import xxhash

    hashes = np.array([xxhash.xxh64_intdigest(t) for t in batch.texts], np.uint64)
    return _Distinct(hashes, batch.ids)


def _by_range(by: np.ndarray, bits: int, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of keys with numbers ``by`` of so many bits, range by range, in the keys' order
    within each, and where each range begins."""
    if bits > 32:
        by, bits = by >> np.uint64(bits - 32), 32
    held = (by * np.uint64(ranges)) >> np.uint64(bits)
    held = held.astype(np.uint16 if ranges <= 1 << 16 else np.uint32)
    cuts = np.concatenate([[0], np.cumsum(np.bincount(held, minlength=ranges))])
    return np.argsort(held, kind="stable"), cuts


#: A set of questions: the distinct keys of a batch, the numbers that deal them out and their
#: bits, the first range that is theirs, the number of their ranges, and whether the numbers are
#: sent with the keys, to be compared, too.
_Asked = tuple[_Distinct, np.ndarray, int, int, int, bool]

_QUESTIONS = "range int, batch long, n int, least long, keys binary, ids binary, anchors binary"


def _rows(target: pa.Schema) -> Callable[[Batch, list[_Asked]], pa.RecordBatch]:
    def rows(batch: Batch, sets: list[_Asked]) -> pa.RecordBatch:
        columns: list[list] = [[] for _ in target]
        for found, by, bits, first, ranges, sent in sets:
            order, cuts = _by_range(by, bits, ranges)
            least = int(found.ids.min(initial=NO_ID))
            own = np.flatnonzero(cuts[1:] > cuts[:-1])
            sizes = (cuts[own + 1] - cuts[own]).tolist()
            keys = packed_numbers(found.keys[order], cuts, steps=True)
            ids = packed_numbers((found.ids[order] - least).astype(np.uint64), cuts)
            anchors = packed_numbers(by[order], cuts) if sent else [b""] * len(own)
            values = [
                (own + first).tolist(), [batch.number] * len(own), sizes, [least] * len(own),
                keys, ids, anchors,
            ]
            for column, more in zip(columns, values):
                column += more
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, target)], schema=target
        )

    return rows


def _answer(questions: DataFrame, compare: Callable) -> DataFrame:
    """Bits for each row of questions, which ``compare`` finds from a range's number, and the
    keys, anchors and ids of its batches."""
    target = arrow_schema(ANSWERS)

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("batch")
        numbers = table.column("range").to_pylist()
        keys, anchors, ids = [], [], []
        for row in table.select(["n", "least", "keys", "ids", "anchors"]).to_pylist():
            keys.append(unpacked_numbers(row["keys"], row["n"], steps=True))
            ids.append(unpacked_numbers(row["ids"], row["n"]).astype(np.int64) + row["least"])
            anchors.append(unpacked_numbers(row["anchors"], row["n"]) if row["anchors"] else None)
        found = compare(numbers[0], keys, anchors, ids)
        bits = pa.array([np.packbits(b).tobytes() for b in found], pa.binary())
        columns = [table.column("batch"), table.column("range"), bits]
        return pa.Table.from_arrays(columns, schema=target)

    return questions.groupBy("range").applyInArrow(run, ANSWERS)


def _told(answers: Answers, asked: _Asked, each: int = 1) -> np.ndarray:
    """``each`` rows of booleans, one for each key of the questions."""
    found, by, bits, first, ranges, _ = asked
    order, cuts = _by_range(by, bits, ranges)
    out = np.zeros((each, len(found.keys)), bool)
    for i in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
        n = int(cuts[i + 1] - cuts[i])
        own = np.unpackbits(np.frombuffer(answers.bits[first + i], np.uint8), count=each * n)
        out[:, order[cuts[i] : cuts[i + 1]]] = own.reshape(each, n)
    return out


def _spans(starts: np.ndarray, ends: np.ndarray, docs: np.ndarray) -> tuple:
    """The spans, and their documents, that the given ones make where they overlap or touch."""
    order = np.argsort(starts, kind="stable")
    starts, docs, ends = starts[order], docs[order], np.maximum.accumulate(ends[order])
    new = np.ones(len(starts), bool)
    new[1:] = (starts[1:] > ends[:-1]) | (docs[1:] != docs[:-1])
    at = np.flatnonzero(new)
    return starts[at], ends[np.append(at[1:], len(ends)) - 1] if len(at) else ends, docs[at]


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    keep_bytes: bool = True,
) -> DataFrame:
    """``id, n_bytes, n_removed, removed, kept_sha256`` and the ``kept`` bytes if asked for.

    ``removed`` has the maximal removed runs of bytes. Kept bytes need not be valid text.
    """
    batches = write_batches(docs, id_col, text_col, BATCH_BYTES, BATCH_DOCS)
    total = batches.agg(F.sum("bytes")).first()[0] or 0
    # As many of the anchors' bits as make chance hits rare: a hit costs work, not truth.
    bits = min(63, 8 + math.ceil(math.log2(total + 2)))
    # The ranges of anchors, of whole texts, and then of suffixes.
    anchor_ranges, text_ranges, suffix_ranges = (
        max(1, int(total * density / windows.RANGE_KEYS))
        for density in (_ANCHORS, 1 / length / 8, _SUFFIXES)
    )
    texts_from = anchor_ranges
    suffixes_from = texts_from + text_ranges

    def first_question(batch: Batch) -> tuple[_Suffixes, _Asked, _Asked]:
        own = _Suffixes(batch, length, gram)
        stretches = _Distinct(own.stretch, batch.ids[own.doc])
        anchors = own.anchor[stretches.one] >> np.uint64(64 - bits)
        texts = _copies(batch)
        return (
            own,
            (stretches, anchors, bits, 0, anchor_ranges, True),
            (texts, texts.keys, 64, texts_from, text_ranges, False),
        )

    def first_answer(number: int, keys: list, anchors: list, ids: list) -> list[np.ndarray]:
        return _compared(keys, anchors, ids) if number < texts_from else seen_before(keys, ids)

    def indexed(batch: Batch, answers: Answers):
        """The runs and texts that are known to be repeats, and the strings that need an entry."""
        own, stretches, texts = first_question(batch)
        found = texts[0]
        copy = _told(answers, texts)[0][found.place]
        copy |= batch.ids > found.ids[found.place]
        found, ids = stretches[0], batch.ids[own.doc]
        known, several = _told(answers, stretches, 2)[:, found.place]
        known |= ids > found.ids[found.place]
        starts, keys, docs = own.strings(several & ~known & ~copy[own.doc])
        strings = _Distinct(keys, batch.ids[docs])
        return own, copy, known, starts, docs, (
            strings, strings.keys, 64, suffixes_from, suffix_ranges, False,
        )

    def finish(batch: Batch, answers: Answers) -> list:
        own, copy, known, starts, docs, asked = indexed(batch, answers)
        strings = asked[0]
        before = _told(answers, asked)[0][strings.place]
        before |= batch.ids[docs] > strings.ids[strings.place]
        copies = np.flatnonzero(copy & (own.sizes >= length))
        known &= ~copy[own.doc]
        begins = own.ends - own.sizes
        firsts, hits = own.first[known], starts[before]
        starts, ends, docs = _spans(
            np.concatenate([begins[copies], firsts, hits]),
            np.concatenate(
                [own.ends[copies], firsts + own.counts[known] + length - 1, hits + length]
            ),
            np.concatenate([copies, own.doc[known], docs[before]]),
        )
        cuts = np.searchsorted(docs, np.arange(len(batch.ids) + 1))
        removed = np.concatenate([[0], np.cumsum(ends - starts)])
        removed = removed[cuts[1:]] - removed[cuts[:-1]]
        kept = list(batch.texts)
        for doc in np.flatnonzero(removed).tolist():
            spans = slice(cuts[doc], cuts[doc + 1])
            froms = [int(begins[doc]), *ends[spans].tolist()]
            tos = [*starts[spans].tolist(), int(own.ends[doc])]
            kept[doc] = b"".join([own.data[a:b] for a, b in zip(froms, tos)])
        spans = pa.StructArray.from_arrays(
            [pa.array(starts - begins[docs]), pa.array(ends - begins[docs])], ["start", "end"]
        )
        return [
            pa.array(batch.ids),
            pa.array(own.sizes),
            pa.array(removed),
            pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), spans),
            pa.array([hashlib.sha256(k).hexdigest() for k in kept]),
            *([pa.array(kept, pa.binary())] if keep_bytes else []),
        ]

    schema = (
        "id long, n_bytes long, n_removed long, removed array<struct<start:long,end:long>>, "
        "kept_sha256 string" + ", kept binary" * keep_bytes
    )
    target = arrow_schema(schema)
    rows = _rows(arrow_schema(_QUESTIONS))

    def again(table: pa.Table, answers: pa.Table) -> pa.Table:
        (batch,) = read_batches(table)
        asked = indexed(batch, Answers(answers.to_pylist()))[-1]
        return pa.Table.from_batches([rows(batch, [asked])])

    def last(table: pa.Table, answers: pa.Table) -> pa.Table:
        (batch,) = read_batches(table)
        columns = finish(batch, Answers(answers.to_pylist()))
        columns = [column.cast(field.type) for column, field in zip(columns, target)]
        return pa.Table.from_arrays(columns, schema=target)

    questions = ask(batches, None, lambda batch, _: first_question(batch)[1:], rows, _QUESTIONS)
    shared = written(_answer(questions, first_answer), "anchor-answers")
    repeats = _answer(
        meet(batches, shared, again, _QUESTIONS),
        lambda _, keys, anchors, ids: scan_levels(keys, ids),
    )
    found = meet(batches, shared.union(repeats), last, schema)
    return found.withColumn("id", F.nullif("id", F.lit(NO_ID)))
