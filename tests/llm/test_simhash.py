import itertools
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from assayer.llm import simhash as s


def fingerprint(text):
    words = (text or "").encode().lower().split()
    own = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(x, seed=42) for x in own]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(prints):
    """Smallest reachable position of each, by trying all pairs."""
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(prints)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 2:
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_masks_cover_every_pair_of_bits():
    masks = s.masks()
    for i, j in itertools.combinations(range(64), 2):
        assert any(not m >> i & 1 and not m >> j & 1 for m in masks)


def chain_of(n, seed):
    """Fingerprints in clusters: chains of small steps, and dense neighbourhoods."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        x = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 3, 12])):
            out.append(x)
            for _ in range(rng.choice([0, 1, 2, 3])):
                x ^= 1 << rng.randrange(64)
    centre = rng.getrandbits(64)
    out += [centre ^ 1 << i ^ 1 << j for i in range(12) for j in range(i)]
    return list(dict.fromkeys(out))


@pytest.mark.parametrize("paired", [64, 0])
def test_components_of_links(spark, paired):
    prints = chain_of(60, 1)
    signed = [p - (p >> 63 << 64) for p in prints]
    nodes = spark.createDataFrame([(p,) for p in signed], "fingerprint long")
    found = {r["node"]: r["root"] for r in s.components(s.links(nodes, paired)).collect()}
    want = roots(prints)
    for group in {w: [i for i, x in enumerate(want) if x == w] for w in want}.values():
        names = {found.get(signed[i], signed[i]) for i in group}
        assert names == {min(signed[i] for i in group)}


def test_long_chain(spark):
    edges = spark.range(2000).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r["root"] for r in s.components(edges).collect()} == {0}


def test_groups_equal_brute_force(docs, prose, edges):
    rng = random.Random(2)
    rows = [(50 + i, t) for i, t in enumerate(prose(60, 200, seed=3))]
    for i in range(60):
        words = rows[i][1].split()
        words[rng.randrange(len(words))] = "changed"
        rows.append((500 - i, " ".join(words)))
    rows += [*edges, rows[5]]
    found = sorted((str(r["id"]), r["fingerprint"], str(r["component"])) for r in s.near_groups(docs(rows)).collect())
    prints = [fingerprint(t) for _, t in rows]
    root = roots(prints)
    least = {}
    for (key, _), w in zip(rows, root):
        if key is not None:
            least[w] = min(least.get(w, key), key)
    want = sorted((str(k), p - (p >> 63 << 64), str(least.get(w))) for (k, _), p, w in zip(rows, prints, root))
    assert found == want
    kept = s.drop_near(docs(rows))
    assert kept.columns == docs(rows).columns
    got = sorted(str(r["doc_id"]) for r in kept.collect())
    names = sorted([*{str(v) for v in least.values()}, *[str(k) for k, _ in rows if k is None]])
    assert got == names


def test_empty_and_digits(docs, spark):
    assert s.near_groups(docs([])).count() == 0 and s.drop_near(docs([])).count() == 0
    rows = spark.createDataFrame([(0,), (-1,), (255,)], "f long").select(s.digits(F.col("f"))).collect()
    assert [r[0] for r in rows] == ["0" * 16, "f" * 16, "0" * 14 + "ff"]
