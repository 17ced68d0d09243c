"""Dual-tree Lloyd iteration against plain Lloyd iteration on Python's numbers."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from assayer.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<double>, label int, id string, tree int, bits string"


def brute(rows, parts=8, entries=16, rounds=6):
    """``(id, code, error, label_error)`` of rows ``(id, vector, label)``, and the codebooks."""
    kept = [
        r for r in rows if r[1] and len(r[1]) % parts == 0 and all(x is not None and math.isfinite(x) for x in r[1])
    ]
    lengths = Counter(len(r[1]) for r in kept)
    usual = max(lengths, key=lambda n: (lengths[n], -n)) if lengths else 0
    kept = [r for r in kept if len(r[1]) == usual]
    width = usual // parts

    def whole(vector):
        numbers = [(n * 4096) // d for n, d in map(float.as_integer_ratio, vector)]
        return [tuple(numbers[i * width : (i + 1) * width]) for i in range(parts)]

    cut = [whole(r[1]) for r in kept]
    first = sorted((r[0], r[1], i) for i, r in enumerate(kept) if r[0] is not None)[:entries]
    books = [[cut[i][p] for _, _, i in first] for p in range(parts)]

    def distance(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b))

    def nearest(part, p):
        return min(range(len(books[p])), key=lambda e: (distance(part, books[p][e]), e))

    for _ in range(rounds if kept else 0):
        after = []
        for p in range(parts):
            own = defaultdict(list)
            for c in cut:
                own[nearest(c[p], p)].append(c[p])
            after.append(
                [
                    tuple(sum(x) // len(own[e]) for x in zip(*own[e])) if e in own else entry
                    for e, entry in enumerate(books[p])
                ]
            )
        books = after
    codes = [[nearest(c[p], p) for p in range(parts)] for c in cut]
    errors = [sum(distance(c[p], books[p][e]) for p, e in enumerate(code)) for c, code in zip(cut, codes)]
    by_label = Counter()
    for r, error in zip(kept, errors):
        by_label[r[2]] += error
    out = [(r[0], code, e, by_label[r[2]]) for r, code, e in zip(kept, codes, errors)]
    return sorted(out, key=repr), [list(map(list, b)) for b in books] if kept else None


@pytest.fixture(scope="module")
def encoded(spark):
    def run(rows, **more):
        df = spark.createDataFrame([(*r, "x", None, "y") for r in rows], SCHEMA).repartition(3)
        found, books = vc.encode(df, **more)
        got = [(r["id"], r["code"], r["error"], r["label_error"]) for r in found.collect()]
        return sorted(got, key=repr), books.tolist() if books.size else None

    return run


def vectors(rng, n, width=16, near=5):
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(near)]
    return [
        (i, [x + rng.gauss(0, 0.1) for x in rng.choice(centres)], rng.choice([0, 1, None]))
        for i in range(n)
    ]


def test_equals_plain_iteration_with_odd_rows(encoded):
    rng = random.Random(1)
    rows = vectors(rng, 300)
    rows += [(5, rows[5][1], 7), (5, rows[9][1], None), (None, rows[3][1], 1)]  # repeats, ties
    rows += [(1000, None, 1), (1001, [None] * 16, 1), (1002, [math.nan] + [0.0] * 15, 1)]
    rows += [(1003, [math.inf] * 16, 1), (1004, [], 1), (1005, [1.0] * 8, 1), (1006, [1.0] * 13, 1)]
    rows += [(-1, [0.0] * 16, 2), (-2, [0.0] * 16, 2)]  # equal first entries
    rng.shuffle(rows)
    assert encoded(rows) == brute(rows)


def test_one_vector_on_a_third_of_the_rows_and_whole_nodes(encoded):
    rng = random.Random(2)
    rows = vectors(rng, 400, width=8, near=30)
    rows = [(i, rows[0][1] if i % 3 == 0 else v, label) for i, v, label in rows]
    assert encoded(rows) == brute(rows)


def test_wide_numbers_stay_exact(encoded):
    rng = random.Random(3)
    rows = vectors(rng, 60)
    rows += [(100 + i, [x * 1e5 for x in v], label) for i, v, label in rows[:20]]
    assert encoded(rows, rounds=3) == brute(rows, rounds=3)
    rows += [(200, [1e300] * 16, 9)]
    got, books = encoded(rows, rounds=2)
    expected, brute_books = brute(rows, rounds=2)
    fits = lambda n: n if n < 2**63 else None
    assert books == brute_books
    assert got == sorted([(i, c, fits(e), fits(t)) for i, c, e, t in expected], key=repr)


def test_few_rows_and_none(encoded):
    rows = vectors(random.Random(4), 3)
    assert encoded(rows) == brute(rows)
    assert encoded([]) == ([], None)
    assert encoded([(1, None, None)]) == ([], None)


def test_small_blocks_give_the_same(encoded, monkeypatch):
    rows = vectors(random.Random(5), 200)
    whole = encoded(rows)
    monkeypatch.setattr(vc.make_blocks, "__defaults__", (16 * 40,))
    assert encoded(rows) == whole


def test_pruning_settles_whole_nodes():
    rng = np.random.default_rng(6)
    centres = rng.integers(-4000, 4000, (1, 16, 8))
    points = (centres[:, rng.integers(0, 16, 2000)] + rng.integers(-20, 20, (1, 2000, 8))).astype(np.int64)
    tree, entries = vc.make_tree(points), vc.EntryTree(centres)
    uncertain = 0
    for found in vc.assign(tree, entries):
        uncertain += len(found[1]) if found[2] is None else 0
    assert uncertain <= 0.2 * len(tree["counts"][0])
    sums, counts = vc.entry_sums(tree, entries)
    apart = ((points[0][:, None] - centres[0][None]) ** 2).sum(axis=2)
    nearest = apart.argmin(axis=1)
    assert counts[0].tolist() == np.bincount(nearest, minlength=16).tolist()
    for e in range(16):
        assert (sums[0, e] == points[0][nearest == e].sum(axis=0)).all()
