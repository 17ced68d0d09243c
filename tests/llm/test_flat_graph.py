"""Near vectors by the flat graph against all pairs."""

import math

import numpy as np
import pytest

from assayer.llm import flat_graph as fg

SCHEMA = "vec_id long, embedding array<double>, node string, k1 int, vector int, shards string"


def brute(rows, threshold=0.9):
    """``(id, n_links, component)`` of rows ``(id, vector)``."""
    usable = [
        bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v in rows
    ]
    units = [fg.unit(np.array([v]))[0] if u else None for (_, v), u in zip(rows, usable)]
    near = [
        [
            j
            for j in range(len(rows))
            if j != i and usable[i] and usable[j] and len(units[i]) == len(units[j])
            and units[i] @ units[j] >= threshold
        ]
        for i in range(len(rows))
    ]
    out, seen = [None] * len(rows), set()
    for i in range(len(rows)):
        if i in seen:
            continue
        reached, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in reached:
                    reached.add(j)
                    todo.append(j)
        seen |= reached
        ids = [rows[j][0] for j in reached if rows[j][0] is not None]
        for j in reached:
            out[j] = (rows[j][0], len(near[j]), min(ids, default=None))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def linked(spark):
    def run(rows, **more):
        df = spark.createDataFrame([(*r, "x", 1, None, "y") for r in rows], SCHEMA).repartition(4)
        return sorted(map(tuple, fg.near_vectors(df, **more).collect()), key=repr)

    return run


def cloud(seed, groups, singles, width=16):
    """Groups of near copies of several sizes among single vectors."""
    rng = np.random.default_rng(seed)
    found = [rng.normal(size=width) for _ in range(singles)]
    for size in groups:
        centre = rng.normal(size=width)
        found += [centre + rng.normal(size=width) * rng.choice([0.01, 0.1, 0.3]) for _ in range(size)]
    return [(i, list(map(float, v))) for i, v in enumerate(rng.permutation(np.array(found)))]


def test_equals_all_pairs_with_odd_rows(linked):
    rows = cloud(1, [2, 3, 10, 60], 300)
    rows += [(1000, None), (1001, []), (1002, [0.0] * 16), (1003, [None] * 16), (1004, [math.nan] * 16)]
    rows += [(1005, [math.inf] * 16), (1006, [1e200] * 16), (1007, [1e-200] * 16), (1008, [1.0])]
    rows += [(1009, [2.0] * 16), (1010, [-0.0] * 15 + [1.0]), (1011, [0.0] * 15 + [3.0])]
    rows += [(7, rows[7][1]), (7, rows[8][1]), (None, rows[9][1]), (None, None)]
    assert linked(rows) == brute(rows)


def test_small_shards_of_several_pieces_lose_no_pair(linked):
    rows = cloud(2, [150, 40], 60)
    assert linked(rows, shard_nodes=80, limit=40) == brute(rows)


def test_one_vector_on_a_third_of_the_rows(linked):
    rows = cloud(3, [5], 100)
    rows = [(i, rows[0][1] if i % 3 == 0 else v) for i, v in rows]
    assert linked(rows) == brute(rows)


def test_empty_and_unusable_tables(linked):
    assert linked([]) == []
    assert linked([(1, None), (2, [0.0])]) == [(1, 0, 1), (2, 0, 2)]
    assert linked([(1, [1.0])]) == [(1, 0, 1)]


def test_graph_finds_what_is_within_range():
    rows = cloud(4, [30] * 10, 1500, width=32)
    nodes = fg.unit(np.array([v for _, v in rows])).astype(np.float32)
    adjacent = fg.build_graph(nodes)
    start = np.full((len(nodes), 1), fg.medoid(nodes))
    scores = fg.beam_search(nodes, adjacent, nodes, start, fg.BEAM, 0.9)
    truth = nodes @ nodes.T >= 0.9
    assert (truth & (scores >= 0.9)).sum() >= 0.99 * truth.sum()
    assert np.isneginf(scores).mean() > 0.1  # by far not all nodes are met


def test_every_node_is_reached_from_the_medoid():
    rng = np.random.default_rng(8)
    dense = rng.normal(size=32) + 0.001 * rng.normal(size=(900, 32))
    nodes = fg.unit(np.concatenate([dense, rng.normal(size=(600, 32))])).astype(np.float32)
    adjacent = fg.build_graph(nodes)
    assert fg._reached(adjacent, fg.medoid(nodes)).all()
    islands = np.full((len(nodes), 3), -1)
    islands[:, 0] = np.arange(len(nodes)) ^ 1  # pairs that nobody else points to
    joined = fg._connected(nodes, islands, fg.medoid(nodes))
    assert fg._reached(joined, fg.medoid(nodes)).all() and (joined[:, 0] == islands[:, 0]).all()
    start = np.full((len(nodes), 1), fg.medoid(nodes))
    scores = fg.beam_search(nodes, adjacent, nodes, start, fg.BEAM, 0.9)
    truth = nodes @ nodes.T >= 0.9
    assert (truth & (scores >= 0.9)).sum() >= 0.999 * truth.sum()


def test_audit_counts_what_is_missing(spark):
    rows = cloud(5, [50], 20)
    nodes = fg.distinct_vectors(fg._keyed(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding")).cache()
    truth = {i: n for i, n, _ in brute(rows)}
    links = nodes.selectExpr("node", "least").toPandas()
    links["links"] = [truth[i] for i in links["least"]]
    whole = spark.createDataFrame(links[["node", "links"]])
    assert fg.audit(nodes, whole, 0.9) == 1
    assert abs(fg.audit(nodes, whole.selectExpr("node", "links div 2 as links"), 0.9) - 0.5) < 0.05
