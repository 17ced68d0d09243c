"""Vector codes by dual-tree Lloyd iteration.

Components become whole numbers, vectors are cut into parts, and each part position gets a
codebook of its own. Tasks put their vectors into blocks once; a block has a balanced tree
over its points for each part position, with the box and the cached sum of every leaf, and
is written to the shared folder. In a round the trees over points and a tree over
the codebook's entries are descended together: an entry node whose box is farther from a
point node's box than some other entry can be from any of its points is pruned, for all points
below. A point node with one entry left takes it whole, by its cached sum; leaves that stay
uncertain compare whole numbers with the entries left. All bounds are exact whole
numbers, so the result is that of plain Lloyd iteration. A round shuffles sums per entry only,
and the driver gets a codebook, whose size is fixed.

Defined results: rows whose vector is null or holds null or non-finite components get no
code, nor do vectors of another length than the most frequent one that the parts divide (the
smaller of two as frequent), empty vectors among them. Repeated rows each get their row; a
null id takes part but never starts a codebook; of rows with one id the one with the smaller
components does so first. With fewer rows than entries, codebooks have as many entries
as there are rows; an empty table gives an empty one. Components beyond 21 bits are
computed with unbounded numbers; an error, or a label's sum, beyond 64 bits is null.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .common import Batches, arrow_schema, in_rows

PARTS = 8
ENTRIES = 16
ROUNDS = 6
UNIT = 4096
#: Components of a block, and points of a leaf of its trees.
BLOCK_COMPONENTS = 1 << 18
LEAF = 16
#: Up to so many bits squared distances and sums fit 64-bit numbers.
NARROW_BITS = 21
#: Sums of wider numbers are added up by digits of so many bits.
_DIGIT_BITS = 32
_LONG = 2**63


def whole_numbers(values: np.ndarray) -> np.ndarray:
    """``floor(UNIT * x)`` of finite doubles: 64-bit numbers where they fit ``NARROW_BITS``."""
    if not values.size or np.abs(values).max() < 2.0**NARROW_BITS / UNIT:
        return np.floor(values * UNIT).astype(np.int64)
    # A power of two moves the exponent only; Python's numbers hold what a double cannot.
    exact = [(n * UNIT) // d for n, d in map(float.as_integer_ratio, values.ravel().tolist())]
    return np.array(exact, object).reshape(values.shape)


def fitting(*arrays: np.ndarray) -> list[np.ndarray]:
    """The arrays as 64-bit numbers if all are, else all of them as Python's."""
    if any(a.dtype == object for a in arrays):
        return [a.astype(object) for a in arrays]
    return list(arrays)


def make_tree(points: np.ndarray) -> dict:
    """Balanced trees over ``(parts, n, components)``: points in leaf order, their places, boxes
    and sums of the leaves. Places beyond the last repeat it, with no weight in sums."""
    parts, n, width = points.shape
    depth = max(0, (-(-n // LEAF) - 1).bit_length())
    size = LEAF << depth
    order = np.minimum(np.arange(size), n - 1)
    weight = np.broadcast_to(np.arange(size) < n, (parts, size))
    places = np.broadcast_to(order, (parts, size))
    own = points[:, order]
    for level in range(depth):
        boxes = own.reshape(parts, 1 << level, -1, width)
        spread = boxes.max(axis=2) - boxes.min(axis=2)
        widest = np.argmax(spread, axis=2)[:, :, None, None]
        keys = np.take_along_axis(boxes, widest, axis=3)[..., 0]
        by = np.argsort(keys, axis=2, kind="stable")
        own = np.take_along_axis(boxes, by[..., None], axis=2).reshape(parts, size, width)
        shape = (parts, 1 << level, -1)
        places = np.take_along_axis(places.reshape(shape), by, axis=2).reshape(parts, size)
        weight = np.take_along_axis(weight.reshape(shape), by, axis=2).reshape(parts, size)
    leaves = own.reshape(parts, -1, LEAF, width)
    counted = weight.reshape(parts, -1, LEAF, 1).astype(np.int64)
    return {
        "n": n,
        "points": own if own.dtype == object else own.astype(np.int32),
        "places": places.astype(np.int32),
        "weight": weight,
        "lo": leaves.min(axis=2),
        "hi": leaves.max(axis=2),
        "sums": (leaves * counted).sum(axis=2),
        "counts": counted.sum(axis=(2, 3)),
    }


def levels(leaf: np.ndarray, join) -> list[np.ndarray]:
    """Of an array per leaf, the arrays per node of each level, root first."""
    found = [leaf]
    while found[-1].shape[1] > 1:
        found.append(join(found[-1][:, 0::2], found[-1][:, 1::2]))
    return found[::-1]


class EntryTree:
    """A balanced tree over the entries of each part's codebook ``(parts, entries, components)``."""

    def __init__(self, codebooks: np.ndarray) -> None:
        self.codebooks = codebooks
        n = codebooks.shape[1]
        size = 1 << max(0, n - 1).bit_length()
        self.index = np.empty((len(codebooks), size), np.int64)
        for part, entries in enumerate(codebooks):
            self.index[part] = self._order(entries, np.minimum(np.arange(size), n - 1))
        own = np.take_along_axis(codebooks, self.index[..., None], axis=1)
        self.lo, self.hi = levels(own, np.minimum), levels(own, np.maximum)

    def _order(self, entries: np.ndarray, among: np.ndarray) -> np.ndarray:
        if len(among) < 2:
            return among
        widest = np.argmax(entries[among].max(axis=0) - entries[among].min(axis=0))
        by = among[np.argsort(entries[among, widest], kind="stable")]
        half = len(by) // 2
        return np.concatenate([self._order(entries, by[:half]), self._order(entries, by[half:])])


def assign(tree: dict, entry_tree: EntryTree) -> Iterator[tuple]:
    """Nodes of points and their entries: ``(part, first leaf, leaves, entry)`` of whole nodes, as
    arrays, and last ``(part, leaf, entry of each point)`` of the leaves that stayed uncertain."""
    lo, hi, codebooks, points = fitting(
        tree["lo"], tree["hi"], entry_tree.codebooks, tree["points"].astype(tree["lo"].dtype)
    )
    los, his = levels(lo, np.minimum), levels(hi, np.maximum)
    parts = len(lo)
    part, node = np.arange(parts), np.zeros(parts, np.int64)
    mask = np.ones((parts, 1), bool)
    at = 0  # the level in the entry tree
    for level in range(len(los)):
        while True:
            low, high = los[level][part, node][:, None], his[level][part, node][:, None]
            e_lo, e_hi = fitting(lo, entry_tree.lo[at], entry_tree.hi[at])[1:]
            e_lo, e_hi = e_lo[part], e_hi[part]
            gap = np.maximum(np.maximum(low - e_hi, e_lo - high), 0)
            reach = np.maximum(high - e_lo, e_hi - low)
            nearest, farthest = (gap * gap).sum(axis=2), (reach * reach).sum(axis=2)
            top = farthest.max() + 1 if farthest.size else 0
            bound = np.where(mask, farthest, top).min(axis=1) if farthest.size else farthest[:, 0]
            mask = mask & (nearest <= bound[:, None])
            # Both trees go down a level; the entries' tree to its end where points have no more.
            if at == len(entry_tree.lo) - 1 or (level < len(los) - 1 and at > level):
                break
            mask, at = np.repeat(mask, 2, axis=1), at + 1
        if at == len(entry_tree.lo) - 1:
            left = entry_tree.index[part]
            least = np.where(mask, left, left.max() + 1).min(axis=1)
            done = (mask & (left != least[:, None])).sum(axis=1) == 0
            span = 1 << (len(los) - 1 - level)
            yield part[done], node[done] * span, span, least[done]
            part, node, mask = part[~done], node[~done], mask[~done]
        if level < len(los) - 1:
            part, mask = np.repeat(part, 2), np.repeat(mask, 2, axis=0)
            node = np.stack([2 * node, 2 * node + 1], axis=1).reshape(-1)
    width = points.shape[2]
    own = points.reshape(parts, -1, LEAF, width)[part, node]
    entries = np.empty((len(part), LEAF), np.int64)
    allowed = np.zeros((len(part), codebooks.shape[1]), bool)
    rows, cols = np.nonzero(mask)
    allowed[rows, entry_tree.index[part[rows], cols]] = True
    for start in range(0, len(part), 256):
        some = slice(start, start + 256)
        apart = own[some][:, :, None] - codebooks[part[some]][:, None]
        distance = (apart * apart).sum(axis=3)
        if distance.size:
            distance = np.where(allowed[some][:, None], distance, distance.max() + 1)
            entries[some] = np.argmin(distance, axis=2)  # the first of equals
    yield part, node, None, entries


def entry_sums(tree: dict, entry_tree: EntryTree) -> tuple[np.ndarray, np.ndarray]:
    """Sums and numbers of the points of each entry, ``(parts, entries, components)``."""
    parts, n, width = entry_tree.codebooks.shape
    leaf_sums, points = fitting(tree["sums"], tree["points"].astype(tree["sums"].dtype))
    sums = np.zeros((parts, n, width), leaf_sums.dtype)
    counts = np.zeros((parts, n), np.int64)
    add = lambda a, b: a + b
    node_sums, node_counts = levels(leaf_sums, add), levels(tree["counts"], add)
    weight = tree["weight"].reshape(parts, -1, LEAF)
    points = points.reshape(parts, -1, LEAF, width)
    for part, leaf, span, entry in assign(tree, entry_tree):
        if span is None:
            counted = weight[part, leaf].astype(np.int64)
            where = (np.repeat(part, LEAF), entry.reshape(-1))
            np.add.at(counts, where, counted.reshape(-1))
            own = points[part, leaf] * counted[..., None]
            np.add.at(sums, where, own.reshape(-1, width))
        else:
            level = len(node_sums) - span.bit_length()
            np.add.at(counts, (part, entry), node_counts[level][part, leaf // span])
            np.add.at(sums, (part, entry), node_sums[level][part, leaf // span])
    return sums, counts


def block_codes(tree: dict, entry_tree: EntryTree) -> tuple[np.ndarray, np.ndarray]:
    """Codes ``(n, parts)`` of a block's vectors in their own order, and their errors."""
    parts, size, width = tree["points"].shape
    codes = np.empty((parts, size // LEAF, LEAF), np.int64)
    for part, leaf, span, entry in assign(tree, entry_tree):
        if span is None:
            codes[part, leaf] = entry
        else:
            for step in range(span):
                codes[part, leaf + step] = entry[:, None]
    codes = codes.reshape(parts, size)
    points, codebooks = fitting(tree["points"].astype(tree["lo"].dtype), entry_tree.codebooks)
    apart = points - np.take_along_axis(codebooks, codes[..., None], axis=1)
    distance = (apart * apart).sum(axis=2)
    ordered = np.empty((parts, tree["n"]), np.int64)
    errors = np.zeros(tree["n"], distance.dtype)
    for part in range(parts):
        real = tree["weight"][part]
        places = tree["places"][part][real]
        ordered[part, places] = codes[part][real]
        errors[places] += distance[part][real]
    return ordered.T, errors


def kept_vectors(df: DataFrame, id_col: str, vector_col: str, label_col: str, parts: int) -> DataFrame:
    """``id, label, vector`` of the rows that get a code; vectors of doubles."""
    vectors = df.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{label_col}`").alias("label"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("vector"),
    ).where(
        "vector is not null and size(vector) > 0 and "
        f"size(vector) % {parts} = 0 and "
        "forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('inf'))"
    )
    lengths = vectors.groupBy(F.size("vector").alias("length")).count()
    usual = lengths.orderBy(F.desc("count"), "length").first()
    return vectors.where(F.size("vector") == (usual["length"] if usual else 0))


def make_blocks(vectors: DataFrame, parts: int, block_components: int = BLOCK_COMPONENTS) -> DataFrame:
    """``ids, labels, tree``: the vectors of each task in blocks, with their trees."""
    kinds = {name: vectors.schema[name].dataType.simpleString() for name in ("id", "label")}
    schema = f"ids array<{kinds['id']}>, labels array<{kinds['label']}>, bits int, tree binary"
    target = arrow_schema(schema)

    def block(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        held = pa.Table.from_batches(batches)
        lists = held.column(2).combine_chunks()
        n = len(lists)
        values = lists.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
        numbers = whole_numbers(values)
        bits = max(int(numbers.max()).bit_length(), int(numbers.min()).bit_length())
        points = numbers.reshape(n, parts, -1).transpose(1, 0, 2)
        one = pa.array([0, n], pa.int32())
        columns = [
            pa.ListArray.from_arrays(one, held.column(i).combine_chunks()).cast(target.field(i).type)
            for i in (0, 1)
        ]
        tree = pa.array([pickle.dumps(make_tree(points))], target.field(3).type)
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array([bits], pa.int32()), tree], schema=target
        )

    def run(batches: Batches) -> Batches:
        waiting: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            while len(batch):
                most = max(LEAF, block_components // max(1, len(batch.column(2)[0])))
                some = batch.slice(0, most - rows)
                waiting.append(some)
                rows, batch = rows + len(some), batch.slice(len(some))
                if rows >= most:
                    yield block(waiting)
                    waiting, rows = [], 0
        if waiting:
            yield block(waiting)

    return vectors.mapInArrow(run, schema)


def _digits(value: int, digits: int) -> list[int]:
    """``value`` by digits, lowest first; the highest has its sign."""
    low = [(value >> _DIGIT_BITS * i) & ((1 << _DIGIT_BITS) - 1) for i in range(digits - 1)]
    return [*low, value >> _DIGIT_BITS * (digits - 1)]


def lloyd_round(blocks: DataFrame, codebooks: np.ndarray, bits: int) -> np.ndarray:
    """The codebooks after one assignment of all points and one replacement."""
    # Narrow sums stay below 2**63 for 2**42 points; wider ones have room in their digits.
    digits = 1 if bits <= NARROW_BITS else -(-(bits + 43) // _DIGIT_BITS)
    schema = "part int, entry int, place int, value long"
    target = arrow_schema(schema)

    def rows(sums: np.ndarray, counts: np.ndarray) -> Iterator[dict]:
        for part, entry in np.argwhere(counts).tolist():
            own = {"part": part, "entry": entry}
            yield {**own, "place": -1, "value": int(counts[part, entry])}
            for i, total in enumerate(sums[part, entry].tolist()):
                for j, digit in enumerate(_digits(total, digits)):
                    yield {**own, "place": i * digits + j, "value": digit}

    def run(batches: Batches) -> Batches:
        entry_tree, held = EntryTree(codebooks), None
        for batch in batches:
            for tree in batch.column(0):
                sums, counts = entry_sums(pickle.loads(tree.as_py()), entry_tree)
                if held is not None:
                    sums, before = fitting(sums, held[0])
                    sums, counts = sums + before, counts + held[1]
                held = sums, counts
        if held is not None:
            yield from in_rows(rows(*held), target, 10_000)

    parts = blocks.select("tree").mapInArrow(run, schema)
    summed = parts.groupBy("part", "entry", "place").agg(F.sum("value").alias("value"))
    found: dict[tuple[int, int], dict[int, int]] = {}
    for row in summed.collect():  # at most the codebooks' own size
        found.setdefault((row["part"], row["entry"]), {})[row["place"]] = row["value"]
    after = codebooks.astype(object)
    for (part, entry), values in found.items():
        for i in range(codebooks.shape[2]):
            total = sum(values[i * digits + j] << _DIGIT_BITS * j for j in range(digits))
            after[part, entry, i] = total // values[-1]
    return after if bits > NARROW_BITS else after.astype(np.int64)


def first_codebooks(vectors: DataFrame, parts: int, entries: int) -> np.ndarray:
    """The parts of the vectors with the smallest ids, ``(parts, entries, components)``."""
    first = vectors.where("id is not null").orderBy("id", "vector").limit(entries).collect()
    if not first:
        return np.zeros((parts, 0, 0), np.int64)
    numbers = whole_numbers(np.array([row["vector"] for row in first], float))
    return numbers.reshape(len(first), parts, -1).transpose(1, 0, 2)


def digest(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def encode(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, np.ndarray]:
    """``id, label, code, error, label_error`` of every kept vector, and the codebooks. A code is
    the index of each part's entry, in part order."""
    vectors = kept_vectors(df, id_col, vector_col, label_col, parts)
    kinds = {name: vectors.schema[name].dataType.simpleString() for name in ("id", "label")}
    schema = f"id {kinds['id']}, label {kinds['label']}, code array<int>, error long"
    codebooks = first_codebooks(vectors, parts, entries)
    if not codebooks.size:
        empty = df.sparkSession.createDataFrame([], f"{schema}, label_error long")
        return empty, codebooks
    blocks = written(make_blocks(vectors, parts), "vector-blocks")
    bits = blocks.agg(F.max("bits")).first()[0]
    if bits > NARROW_BITS:
        codebooks = codebooks.astype(object)
    for _ in range(rounds):
        codebooks = lloyd_round(blocks, codebooks, bits)
    coded = written(_coded(blocks, codebooks, schema), "vector-codes")
    labels = written(
        coded.groupBy("label").agg(
            F.try_sum("error").alias("label_error"), F.max(F.col("error").isNull()).alias("unknown")
        ),
        "label-errors",
    ).withColumnRenamed("label", "of_label")
    total = F.when(~F.col("unknown"), F.col("label_error")).alias("label_error")
    joined = coded.join(labels, coded["label"].eqNullSafe(labels["of_label"]))
    return joined.select("id", "label", "code", "error", total), codebooks


def _coded(blocks: DataFrame, codebooks: np.ndarray, schema: str) -> DataFrame:
    target = arrow_schema(schema)

    def run(batches: Batches) -> Batches:
        entry_tree = EntryTree(codebooks)
        for batch in batches:
            for i, tree in enumerate(batch.column(2)):
                codes, errors = block_codes(pickle.loads(tree.as_py()), entry_tree)
                offsets = pa.array(np.arange(len(codes) + 1) * codes.shape[1], pa.int32())
                flat = pa.array(codes.reshape(-1).astype(np.int32))
                held = [e if e < _LONG else None for e in errors.tolist()]
                columns = [
                    batch.column(0).slice(i, 1).flatten(),
                    batch.column(1).slice(i, 1).flatten(),
                    pa.ListArray.from_arrays(offsets, flat),
                    pa.array(held, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(
                    [c.cast(f.type) for c, f in zip(columns, target)], schema=target
                )

    return blocks.select("ids", "labels", "tree").mapInArrow(run, schema)


def hex_code(code: str) -> Column:
    """The indexes of a code, two hexadecimal digits each."""
    return F.array_join(F.transform(code, lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
