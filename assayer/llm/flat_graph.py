"""Near-duplicate vectors by a robust-pruned flat graph.

Equal vectors form one node. Nodes go to the shards of their nearest centres, several each, so
that shards overlap; centres are nodes of a bounded sample that are not close to each other,
so a dense ball has one centre and not many between which its members would be divided. Each
shard builds a graph of its own: greedy searches collect candidates and robust pruning keeps
few, spread neighbours. The adjacency lists of a node are united over its shards. Then
every node searches its shards from their medoids along the united lists, with a beam that widens
while much of it is within range. Cosines of what is found are verified in double precision.
A pair counts in the first shard that both have, so shards return numbers of links and a
spanning forest instead of pairs. An audit compares a bounded sample of nodes with all nodes;
if recall is short of what is asked, shards overlap more, and at last it is an error.

A shard larger than ``SHARD_LIMIT`` is cut into pieces, each with a graph of its own, and the
shard's nodes, as blocks of queries, search every piece: no task holds more than a piece
and a block, and no pair of the shard is out of reach.

Defined results: vectors that are null, empty, zero or hold null or non-finite components
link with nothing, and neither do vectors of different lengths; 0.0 and -0.0 are equal.
Repeated rows are copies of each other and link; an empty table gives an empty one. A component
is named by its smallest id that is not null; rows with a null id take part. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from .common import Batches, arrow_schema
from .simhash import components

THRESHOLD = 0.9
#: Shards of a node, and nodes of a shard: on average, and at most in a task.
OVERLAP = 3
SHARD_NODES = 1_024
SHARD_LIMIT = 4_096
#: The sample of centres: so many nodes and so many components at most.
MOST_CENTRES = 16_384
MOST_COMPONENTS = 1 << 22
#: Centres of a higher cosine are not both kept.
CENTRES_APART = 0.8
#: Neighbours of a node in a shard's graph, candidates that are pruned at once, the width of the
#: beam to begin with, and how many nodes of it are expanded in a step (a quarter of a wide one).
DEGREE = 24
CANDIDATES = 64
BEAM = 32
STEP = 8
#: Robust pruning drops what is so many times closer to a neighbour than to the node.
ALPHA = 1.2
QUERIES = 256
#: Nodes of the audit, the recall below which shards overlap more, and the least accepted.
AUDITED = 512
WANTED_RECALL = 0.995
LEAST_RECALL = 0.9
_SLACK = 1e-4  # of single-precision cosines


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1, in double precision; huge and tiny ones are scaled first."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def matrix(lists: pa.ChunkedArray | pa.Array, width: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Vectors as rows, padded with zeros to the longest (or cut to ``width``), and their lengths."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    most = int(lengths.max()) if len(lengths) else 0
    out = np.zeros((len(lengths), max(most, width or 0)))
    at = np.arange(out.shape[1])[None] < lengths[:, None]
    out[at] = flat
    return (out if width is None else out[:, :width]), lengths


# -- The graph of one shard


def beam_search(
    nodes: np.ndarray,
    adjacent: np.ndarray,
    queries: np.ndarray,
    starts: np.ndarray,
    beam: int,
    within: float | None = None,
) -> np.ndarray:
    """Cosines of each query with the nodes that its greedy search met, minus infinity elsewhere.

    ``adjacent`` and ``starts`` hold places, -1 for none. With ``within`` the beam doubles
    while half of it is within that cosine.
    """
    n, rows = len(nodes), np.arange(len(queries))[:, None]
    scores = np.full((len(queries), n + 1), -np.inf, np.float32)  # the last column takes the -1
    expanded = np.zeros((len(queries), n + 1), bool)
    widths = np.full(len(queries), min(beam, n))
    found = starts
    while True:
        new = np.zeros((len(queries), n + 1), bool)
        new[rows, found] = True
        new &= np.isneginf(scores)
        new[:, n] = False
        q, v = np.nonzero(new)
        scores[q, v] = np.einsum("ij,ij->i", queries[q], nodes[v])
        real = scores[:, :n]
        if within is not None:
            inside = (real >= within).sum(axis=1)
            while (wide := (2 * inside > widths) & (widths < n)).any():
                widths[wide] = np.minimum(2 * widths[wide], n)
        frontier = np.where(expanded[:, :n], -np.inf, real)
        for width in np.unique(widths):
            own = widths == width
            least = np.partition(real[own], n - width, axis=1)[:, n - width]
            frontier[own] = np.where(real[own] >= least[:, None], frontier[own], -np.inf)
        step = min(max(STEP, int(widths.max()) // 4), n)
        best = np.argpartition(frontier, n - step, axis=1)[:, n - step :]
        best = np.where(np.isneginf(np.take_along_axis(frontier, best, axis=1)), n, best)
        if (best == n).all():
            return real
        expanded[rows, best] = True
        found = np.where(best[..., None] == n, -1, adjacent[np.minimum(best, n - 1)])
        found = found.reshape(len(queries), -1)


def robust_prune(nodes: np.ndarray, own: np.ndarray, scores: np.ndarray, degree: int) -> np.ndarray:
    """Neighbours of ``own`` among the nodes that have a score: the nearest, again and
    again, without those that a chosen one is ``ALPHA`` times closer to."""
    n = len(nodes)
    scores = scores.copy()
    scores[np.arange(len(own)), own] = -np.inf
    most = min(CANDIDATES, n)
    among = np.argpartition(scores, n - most, axis=1)[:, n - most :]
    own_scores = np.take_along_axis(scores, among, axis=1)
    by = np.argsort(-own_scores, axis=1, kind="stable")
    among, own_scores = (np.take_along_axis(a, by, axis=1) for a in (among, own_scores))
    vectors = nodes[among]
    apart = 2 - 2 * (vectors @ vectors.transpose(0, 2, 1))
    from_own = 2 - 2 * own_scores
    alive = ~np.isneginf(own_scores)
    chosen = np.full((len(own), degree), -1, np.int64)
    row = np.arange(len(own))
    for i in range(degree):
        some = alive.any(axis=1)
        if not some.any():
            break
        first = alive.argmax(axis=1)
        chosen[:, i] = np.where(some, among[row, first], -1)
        alive &= ALPHA**2 * apart[row, first] > from_own
        alive[row, first] = False
    return chosen


def medoid(nodes: np.ndarray) -> int:
    return int(np.argmax(nodes @ nodes.mean(axis=0)))


def build_graph(nodes: np.ndarray, degree: int = DEGREE) -> np.ndarray:
    """Places of the neighbours of each node, -1 for none: batches of nodes are searched for in
    the graph as it is, pruned, and entered at their neighbours."""
    n = len(nodes)
    degree = min(degree, max(1, n - 1))
    random = np.random.default_rng(n)
    adjacent = random.integers(0, n, (n, degree))
    adjacent[adjacent == np.arange(n)[:, None]] = -1
    start = np.array([medoid(nodes)])
    order = random.permutation(n)
    for at in range(0, n, QUERIES):
        own = order[at : at + QUERIES]
        starts = np.concatenate([np.tile(start, (len(own), 1)), adjacent[own]], axis=1)
        scores = beam_search(nodes, adjacent, nodes[own], starts, BEAM)
        adjacent[own] = robust_prune(nodes, own, scores, degree)
        _enter(nodes, adjacent, own)
    return _connected(nodes, adjacent, start[0])


#: Lost nodes that are entered at one node at once.
_ENTERED = 4


def _reached(adjacent: np.ndarray, start: int) -> np.ndarray:
    seen = np.zeros(len(adjacent), bool)
    todo = np.array([start])
    while len(todo):
        seen[todo] = True
        near = np.unique(adjacent[todo])
        near = near[near >= 0]
        todo = near[~seen[near]]
    return seen


def _connected(nodes: np.ndarray, adjacent: np.ndarray, start: int) -> np.ndarray:
    """The lists with what pruning lost: a node that nobody reaches from the medoid is entered at
    the nearest one that its search meets, again and again until all are reached."""
    while True:
        lost = np.flatnonzero(~_reached(adjacent, start))[:QUERIES]
        if not len(lost):
            return adjacent
        starts = np.full((len(lost), 1), start)
        scores = beam_search(nodes, adjacent, nodes[lost], starts, BEAM)
        at, best = scores.argmax(axis=1), scores.max(axis=1)
        order = np.lexsort((-best, at))
        lost, at = lost[order], at[order]
        first = np.flatnonzero(np.diff(at, prepend=-1))
        place = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
        entered = place < _ENTERED
        more = np.full((len(nodes), int(place[entered].max()) + 1), -1)
        more[at[entered], place[entered]] = lost[entered]
        adjacent = np.concatenate([adjacent, more], axis=1)


def _enter(nodes: np.ndarray, adjacent: np.ndarray, own: np.ndarray) -> None:
    """Enter the nodes at their neighbours; lists without room are pruned."""
    to = adjacent[own]
    pairs = np.stack([to.ravel(), np.repeat(own, to.shape[1])], axis=1)
    pairs = pairs[pairs[:, 0] >= 0]
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    targets, first = np.unique(pairs[:, 0], return_index=True)
    for some in np.array_split(np.arange(len(targets)), max(1, -(-len(targets) // QUERIES))):
        if not len(some):
            continue
        ends = np.append(first[1:], len(pairs))[some]
        scores = np.full((len(some), len(nodes) + 1), -np.inf, np.float32)
        row = np.arange(len(some))
        scores[row[:, None], adjacent[targets[some]]] = 0
        lengths = ends - first[some]
        spread = np.repeat(row, lengths)
        scores[spread, pairs[first[some][0] : ends[-1], 1]] = 0
        scores = scores[:, :-1]
        q, v = np.nonzero(scores == 0)
        scores[q, v] = np.einsum("ij,ij->i", nodes[targets[some]][q], nodes[v])
        adjacent[targets[some]] = robust_prune(nodes, targets[some], scores, adjacent.shape[1])


# -- Shards


def _sampled(nodes: DataFrame, rows: int) -> DataFrame:
    """About so many nodes, those whose hashes are lowest."""
    share = min(1.0, rows / max(1, nodes.count()))
    return nodes.where(F.pmod("k2", F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))


def centres_of(nodes: DataFrame, per_shard: int, overlap: int) -> np.ndarray:
    """Centres apart from each other, from a bounded sample of the nodes."""
    width = nodes.agg(F.max(F.size("vector"))).first()[0]
    most = max(1, min(MOST_CENTRES, MOST_COMPONENTS // width))
    wanted = max(1, min(most, -(-overlap * nodes.count() // per_shard)))
    rows = _sampled(nodes, wanted).select("vector").limit(2 * most).toArrow()
    if not len(rows):
        rows = nodes.select("vector").limit(1).toArrow()
    vectors, _ = matrix(rows.column(0), width)
    vectors = unit(vectors)
    vectors = vectors[np.lexsort(vectors.T)]  # the same centres whatever order the rows came in
    kept: list[int] = []
    for start in range(0, len(vectors), 256):
        block = vectors[start : start + 256]
        near = (block @ vectors[kept].T > CENTRES_APART).any(axis=1) if kept else np.zeros(len(block), bool)
        own = block @ block.T > CENTRES_APART
        chosen: list[int] = []
        for i in np.nonzero(~near)[0]:
            if not own[i, chosen].any():
                chosen.append(i)
        kept += [start + i for i in chosen]
    return vectors[kept]


def shard_members(nodes: DataFrame, centres: np.ndarray, overlap: int) -> DataFrame:
    """``node, copies, vector, shards``: the nearest centres, ascending."""
    schema = "node long, copies long, vector array<double>, shards array<int>"
    target = arrow_schema(schema)
    width, each = centres.shape[1], min(overlap, len(centres))

    def run(batches: Batches) -> Batches:
        for batch in batches:
            vectors, _ = matrix(batch.column(2), width)
            near = vectors @ centres.T
            shards = np.sort(np.argpartition(near, len(centres) - each, axis=1)[:, -each:], axis=1)
            offsets = pa.array(np.arange(len(batch) + 1) * each, pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(shards.ravel().astype(np.int32)))
            columns = [*batch.columns, lists]
            yield pa.RecordBatch.from_arrays(
                [c.cast(f.type) for c, f in zip(columns, target)], schema=target
            )

    return nodes.select("node", "copies", "vector").mapInArrow(run, schema)


def _pieced(members: DataFrame, limit: int) -> DataFrame:
    """Members once per shard, with ``shard``, its number of ``pieces`` and the own ``piece``."""
    each = members.withColumn("shard", F.explode("shards"))
    sizes = each.groupBy("shard").agg(
        F.ceil(F.count("*") / limit).cast("int").alias("pieces")
    )
    # A row per centre, and centres are bounded.
    return each.join(F.broadcast(sizes), "shard").withColumn(
        "piece", F.pmod(F.xxhash64("node"), "pieces").cast("int")
    )


def adjacency(members: DataFrame, limit: int = SHARD_LIMIT) -> DataFrame:
    """``node, near``: the neighbours of each node, united over the graphs of its shards."""
    schema = "node long, near array<long>"
    target = arrow_schema(schema)

    def build(group: pa.Table) -> pa.Table:
        group = group.sort_by("node")
        ids = group.column("node").to_numpy()
        vectors, _ = matrix(group.column("vector"))
        found = build_graph(unit(vectors).astype(np.float32))
        real = found >= 0
        offsets = np.concatenate([[0], np.cumsum(real.sum(axis=1))])
        near = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids[found[real]]))
        return pa.Table.from_arrays([pa.array(ids), near.cast(target.field(1).type)], schema=target)

    pieces = _pieced(members, limit).select("shard", "piece", "node", "vector")
    graphs = pieces.groupBy("shard", "piece").applyInArrow(build, schema)
    return graphs.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))


def _places(ids: np.ndarray, lists: pa.ChunkedArray, degree: int) -> np.ndarray:
    """Lists of ids as places among sorted ``ids``, -1 for those that are not there."""
    lists = lists.combine_chunks()
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    at = np.minimum(np.searchsorted(ids, flat), len(ids) - 1) if len(ids) else np.zeros(len(flat), int)
    at = np.where(ids[at] == flat, at, -1) if len(ids) else at - 1
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.full((len(lengths), max(1, degree)), -1, np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    column = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[row, column] = at
    return out


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest place that each of ``n`` places reaches by links."""
    label = np.arange(n)
    while True:
        before = label.copy()
        least = np.minimum(label[a], label[b])
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        label = label[label]
        if (label == before).all():
            return label


def search_group(group: pa.Table, threshold: float, beam: int) -> Iterator[tuple]:
    """``(node, links, root)`` arrays of a piece's members and a block's queries."""
    group = group.sort_by("node")
    ids = group.column("node").to_numpy()
    member = group.column("member").to_numpy(zero_copy_only=False)
    asked = group.column("asked").to_numpy(zero_copy_only=False)
    vectors, lengths = matrix(group.column("vector"))
    exact = unit(vectors)
    nodes, copies = exact.astype(np.float32), group.column("copies").to_numpy()
    shards, _ = matrix(group.column("shards"))
    shard = group.column("shard")[0].as_py()
    own_ids, graph = ids[member], np.nonzero(member)[0]
    near = group.column("near")
    degree = int(near.combine_chunks().value_lengths().to_numpy(zero_copy_only=False).max())
    places = _places(own_ids, near, degree)
    links = np.zeros(len(ids), np.int64)
    pairs: list[np.ndarray] = []
    queries = np.nonzero(asked)[0]
    start = medoid(nodes[graph]) if len(graph) else 0
    for at in range(0, len(queries) if len(graph) else 0, QUERIES):
        some = queries[at : at + QUERIES]
        starts = np.concatenate([np.full((len(some), 1), start), places[some]], axis=1)
        scores = beam_search(
            nodes[graph], places[graph], nodes[some], starts, beam, threshold - _SLACK
        )
        q, v = np.nonzero(scores >= threshold - _SLACK)
        q, v = some[q], graph[v]
        verified = (q != v) & (lengths[q] == lengths[v])
        q, v = q[verified], v[verified]
        verified = np.concatenate(
            [
                np.einsum("ij,ij->i", exact[q[i : i + 65536]], exact[v[i : i + 65536]]) >= threshold
                for i in range(0, len(q), 65536)
            ]
            or [np.zeros(0, bool)]
        )
        q, v = q[verified], v[verified]
        counted = _first_shared(shards, q, v) == shard
        np.add.at(links, q[counted], copies[v[counted]])
        tree = _forest(len(ids), q, v)  # as many links as nodes at most are held
        rest = np.nonzero(tree != np.arange(len(ids)))[0]
        pairs.append(np.stack([rest, tree[rest]], axis=1))
    both = np.concatenate(pairs) if pairs else np.zeros((0, 2), np.int64)
    yield ids, links, ids[_forest(len(ids), both[:, 0], both[:, 1])]


def _first_shared(shards: np.ndarray, q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The first shard that two nodes share; their shards ascend."""
    first = np.full(len(q), np.inf)
    for i in range(shards.shape[1]):
        shared = (shards[q, i][:, None] == shards[v]).any(axis=1)
        first = np.where(shared, np.minimum(first, shards[q, i]), first)
    return first


def search(
    members: DataFrame, near: DataFrame, threshold: float, limit: int = SHARD_LIMIT, beam: int = BEAM
) -> DataFrame:
    """``node, links, root``: per node and shard, links counted there and a linked node."""
    schema = "node long, links long, root long"
    target = arrow_schema(schema)

    def run(group: pa.Table) -> pa.Table:
        columns = next(search_group(group, threshold, beam))
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=target)

    pieces = _pieced(members.join(near, "node"), limit)
    every = F.sequence(F.lit(0), F.col("pieces") - 1)
    own = F.col("piece")
    roles = F.concat(
        F.transform(
            every,
            lambda b: F.struct(own.alias("graph"), b.alias("block"), F.lit(True).alias("member"), (b == own).alias("asked")),
        ),
        F.transform(
            F.array_except(every, F.array(own)),
            lambda g: F.struct(g.alias("graph"), own.alias("block"), F.lit(False).alias("member"), F.lit(True).alias("asked")),
        ),
    )
    rows = pieces.select(
        "shard", "node", "copies", "vector", "shards", "near", F.inline(roles)
    )
    return rows.groupBy("shard", "graph", "block").applyInArrow(run, schema)


# -- The whole table


def _keyed(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, vector, usable, k1, k2``: two hashes of the vector stand for it."""
    vector = F.transform(
        F.col(f"`{vector_col}`").cast("array<double>"), lambda x: x + F.lit(0.0)
    )
    rows = df.select(F.col(f"`{id_col}`").alias("id"), vector.alias("vector"))
    usable = F.expr(
        "coalesce(forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('inf')) "
        "and exists(vector, x -> x != 0), false)"
    )
    return rows.select(
        "id",
        "vector",
        usable.alias("usable"),
        F.xxhash64("vector").alias("k1"),
        F.xxhash64(F.lit(1), F.col("vector")).alias("k2"),
    )


def distinct_vectors(keyed: DataFrame) -> DataFrame:
    """``node, k1, k2, least, copies, vector`` of the distinct usable vectors."""
    return (
        keyed.where("usable")
        .groupBy("k1", "k2")
        .agg(
            F.min("id").alias("least"), F.count("*").alias("copies"), F.first("vector").alias("vector")
        )
        .withColumn("node", F.monotonically_increasing_id())
    )


def audit(nodes: DataFrame, links: DataFrame, threshold: float, sample: int = AUDITED) -> float:
    """Recall of ``node, links`` for a bounded sample of the nodes, held against all nodes."""
    rows = _sampled(nodes, sample).select("node", "vector").limit(4 * sample).toArrow()
    if not len(rows):
        return 1.0
    ids = rows.column(0).to_numpy()
    asked, lengths = matrix(rows.column(1))
    asked = unit(asked)
    schema = "node long, links long"
    target = arrow_schema(schema)

    def run(batches: Batches) -> Batches:
        width = asked.shape[1]
        for batch in batches:
            vectors, own = matrix(batch.column(2), width)
            known = vectors.any(axis=1)  # not those whose only numbers lie beyond the width
            vectors, own = unit(vectors[known]), own[known]
            linked = (asked @ vectors.T >= threshold) & (lengths[:, None] == own[None])
            linked &= ids[:, None] != batch.column(0).to_numpy()[known][None]
            sums = linked @ batch.column(1).to_numpy()[known]
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(sums, pa.int64())], schema=target)

    every = nodes.select("node", "copies", "vector").mapInArrow(run, schema)
    there = every.groupBy("node").agg(F.sum("links").alias("there"))
    compared = there.join(links, "node", "left").agg(
        F.sum("there"), F.sum(F.least("there", F.coalesce("links", F.lit(0))))
    )
    total, found = compared.first()
    return found / total if total else 1.0


def near_vectors(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = THRESHOLD,
    overlap: int = OVERLAP,
    shard_nodes: int = SHARD_NODES,
    limit: int = SHARD_LIMIT,
) -> DataFrame:
    """``id, n_links, component`` of every row: the other rows linked with it, and the smallest id
    that links reach."""
    keyed = _keyed(df, id_col, vector_col)
    nodes = written(distinct_vectors(keyed), "distinct-vectors")
    if nodes.isEmpty():
        return keyed.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    while True:
        centres = centres_of(nodes, shard_nodes, overlap)
        members = written(shard_members(nodes, centres, overlap), "shard-members")
        near = written(adjacency(members, limit), "adjacency")
        found = written(search(members, near, threshold, limit), "found-links")
        links = found.groupBy("node").agg(F.sum("links").alias("links"))
        recall = audit(nodes, links, threshold)
        if recall >= WANTED_RECALL or overlap >= min(len(centres), 4 * OVERLAP):
            break
        overlap *= 2
    if recall < LEAST_RECALL:
        raise RuntimeError(f"the audit found {recall:.3f} of the links")
    edges = found.where("node != root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    roots = components(edges)
    named = (
        nodes.select("node", "k1", "k2", "least", "copies")
        .join(roots, "node", "left")
        .join(links, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    named = written(named, "named-vectors")
    least = named.groupBy("root").agg(F.min("least").alias("component"))
    of_node = written(
        named.join(least, "root").select(
            "k1",
            "k2",
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            "component",
        ),
        "linked-vectors",
    )
    linked = keyed.where("usable").select("id", "k1", "k2").join(of_node, ["k1", "k2"])
    alone = keyed.where("not usable").select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component")
    )
    return linked.select("id", "n_links", "component").union(alone)
