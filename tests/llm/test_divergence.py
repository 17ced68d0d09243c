"""The source divergence audit against brute force in plain Python."""

import random
import re
from collections import Counter, defaultdict

import pytest

from assayer.llm import divergence

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def brute(rows, top=200):
    """Rows of ``(text, lang, source)``."""
    own, whole, docs = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        lang, words = lang or "", [w.translate(LOWER) for w in TERM.findall(text or "")]
        own[lang, source or ""].update(words)
        whole[lang].update(words)
        docs[lang].update(set(words))
    out = []
    for lang, source in own:
        kept = [t for t, n in docs[lang].items() if n >= 3]

        def profile(counts):
            total = sum(counts[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (counts[t] + 1) // total for t in kept}

        p, q = profile(own[lang, source]), profile(whole[lang])
        pairs = []
        for other_lang, other in own:
            if other_lang == lang and other != source:
                r = profile(own[lang, other])
                pairs.append((-sum((p[t] - r[t]) ** 2 // r[t] for t in kept), other.encode()))
        terms = [
            (-((p[t] - q[t]) ** 2 // q[t]), t.encode())
            for t in kept
            if own[lang, source][t] and p[t] > q[t]
        ]
        for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
            out += [
                (lang, source, part, item.decode(), -value, rank)
                for rank, (value, item) in enumerate(found, 1)
            ]
    return sorted(out)


@pytest.fixture(scope="module")
def audited(spark):
    def run(rows, **more):
        df = spark.createDataFrame(
            [(t, lang, s, "x", None, 1) for t, lang, s in rows],
            "text string, lang string, source string, term string, value long, shard int",
        )
        return sorted(map(tuple, divergence.audit(df.repartition(5), **more).collect()))

    return run


def words(rng, n):
    return " ".join(rng.choice("aA bB c d é É 日本 x1y z's E F g".split()) for _ in range(n))


def test_equals_brute_force_with_odd_rows(audited):
    rng = random.Random(3)
    rows = [
        (words(rng, rng.randint(0, 30)), rng.choice(["en", "EN", None, ""]), rng.choice("pqrs"))
        for _ in range(120)
    ]
    rows += [(None, "en", "only-null"), ("", None, None), ("1 2 3", "xx", "no-terms")]
    rows += [("word " * 3, "rare", "a"), ("word", "rare", "b")]  # in too few documents
    rows += [rows[0]] * 4 + [("tie tie", "en", s) for s in "pqrs"]
    assert audited(rows) == brute(rows)


def test_hot_source_and_long_text(audited, monkeypatch):
    rng = random.Random(4)
    long = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(200_000))
    rows = [(long, "en", "hot")] * 3 + [(words(rng, 20), "en", "hot") for _ in range(60)]
    rows += [(words(rng, 20), "en", rng.choice("abc")) for _ in range(30)]
    assert audited(rows) == brute(rows)


def test_blocks_and_held_sums_do_not_matter(audited, monkeypatch):
    rng = random.Random(5)
    rows = [
        (" ".join(f"t{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}" for _ in range(40)), "en", rng.choice("abcde"))
        for _ in range(60)
    ]
    monkeypatch.setattr(divergence.index_runs, "__defaults__", (200, 50))
    monkeypatch.setattr(divergence, "CHUNK_ENTRIES", 7)
    monkeypatch.setattr(divergence, "PIECE_BYTES", 16)
    monkeypatch.setattr(divergence, "HELD_PAIRS", 10)
    monkeypatch.setattr(divergence, "PAIRS_AT_ONCE", 10)
    monkeypatch.setattr(divergence, "MERGED_TERMS", 5)
    assert audited(rows, top_terms=5) == brute(rows, 5)


def test_empty_table(audited):
    assert audited([]) == []


def test_heap_merge_holds_only_ranges_that_have_begun():
    class Part:
        def __init__(self, terms):
            self.lang, self.terms = "en", terms

    letters = [chr(97 + i) for i in range(26)]
    parts = [Part(letters[k::3][i : i + 3]) for k in range(3) for i in range(0, 9, 3)]
    parts.append(Part(["", "a", "z"]))
    merged = list(divergence.heap_merge(sorted(parts, key=lambda c: c.terms[0])))
    assert [term for _, term, _, _ in merged] == sorted([*letters, "", "a", "z"])
    assert all(chunk.terms[at] == term for _, term, chunk, at in merged)
