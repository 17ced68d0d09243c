"""Substring dedup on words and suffix dedup on bytes against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from assayer.llm import substring, suffix_index, windows


def units(rows, size, split):
    """Per row ``(units, removed flags)`` by trying every window."""
    big = windows.NO_ID
    owned = [(i if i is not None else big, split(t or "")) for i, t in rows]
    first = {}
    for i, own in owned:
        for j in range(len(own) - size + 1):
            key = bytes(own[j : j + size]) if isinstance(own, bytes) else tuple(own[j : j + size])
            first[key] = min(first.get(key, big), i)
    out = []
    for i, own in owned:
        gone = [False] * len(own)
        for j in range(len(own) - size + 1):
            key = bytes(own[j : j + size]) if isinstance(own, bytes) else tuple(own[j : j + size])
            if first[key] < i:
                gone[j : j + size] = [True] * size
        out.append((own, gone))
    return out


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def corpus(prose, n=80):
    """Texts with shared passages, near copies and copies under several ids."""
    rng = random.Random(3)
    texts = prose(n, 120, seed=4)
    shared = prose(4, 80, seed=5)
    rows = []
    for i, text in enumerate(texts):
        if i % 3 == 0:
            cut = rng.randrange(len(text))
            text = text[:cut] + shared[i % 4] + text[cut:]
        if i % 5 == 0:
            text = texts[i // 2]
        if i % 7 == 0:
            text = text.replace("a", "é", 1) + "\t" + shared[0][:60]
        rows.append((i * 3 % n, text))
    return [*rows, rows[9], (None, shared[1]), (999, shared[1] * 3)]


@pytest.fixture(params=[1_000_000, 300])
def range_keys(request, monkeypatch):
    monkeypatch.setattr(windows, "RANGE_KEYS", request.param)
    monkeypatch.setattr(windows, "BATCH_DOCS", 7 if request.param == 300 else 256)


def test_substring_equals_brute_force(docs, prose, range_keys):
    rows = corpus(prose)
    found = substring.remove_repeats(docs(rows)).collect()
    want = sorted(
        (str(i), len(own), sum(gone), " ".join(w for w, g in zip(own, gone) if not g))
        for (i, _), (own, gone) in zip(rows, units(rows, 13, words))
    )
    assert sorted((str(r["id"]), r["n_words"], r["n_removed"], r["kept"]) for r in found) == want
    assert sum(r["n_removed"] for r in found) > 500
    for r in found:
        assert sum(s["end"] - s["start"] for s in r["removed"]) == r["n_removed"]
        assert hashlib.sha256(r["kept"].encode()).hexdigest() == r["kept_sha256"]


def test_suffixes_equal_brute_force(docs, prose, range_keys):
    rows = corpus(prose)
    found = suffix_index.remove_repeats(docs(rows)).collect()
    want = sorted(
        (str(i), len(own), sum(gone), bytes(b for b, g in zip(own, gone) if not g))
        for (i, _), (own, gone) in zip(rows, units(rows, 50, str.encode))
    )
    got = [(str(r["id"]), r["n_bytes"], r["n_removed"], bytes(r["kept"])) for r in found]
    assert sorted(got) == want and sum(r["n_removed"] for r in found) > 3000


@pytest.mark.parametrize("operator", [substring, suffix_index])
def test_edges(docs, edges, operator):
    rows = [*edges, (8, "word " * 15), (0, "word " * 14)]
    found = operator.remove_repeats(docs(rows)).collect()
    size, split = (13, words) if operator is substring else (50, str.encode)
    want = sorted((str(i), sum(g)) for (i, _), (_, g) in zip(rows, units(rows, size, split)))
    assert sorted((str(r["id"]), r["n_removed"]) for r in found) == want
    assert operator.remove_repeats(docs([])).count() == 0


def test_rolled_hashes_are_those_of_the_windows():
    codes = np.random.default_rng(0).integers(0, 1 << 63, 100, dtype=np.uint64)
    for size in (1, 2, 13, 24, 50):
        rolled = windows.rolled(codes, size)
        base = int(windows._BASE)
        for i in range(len(rolled)):
            value = 0
            for c in codes[i : i + size].tolist():
                value = (value * base + c) % (1 << 64)
            assert value == int(rolled[i])
    assert len(windows.rolled(codes[:5], 6)) == 0


def test_packed_keys_and_cuts():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 1000, dtype=np.uint64) * 2 + 1)
    assert (windows._unpacked(windows._packed(keys)) == keys).all()
    cuts = windows._cuts(keys, 7)
    for i in range(7):
        own = keys[cuts[i] : cuts[i + 1]].tolist()
        assert all((i << 64) // 7 <= k < ((i + 1) << 64) // 7 for k in own)


def test_levels_merge_geometrically():
    index = suffix_index.Levels()
    rng = np.random.default_rng(2)
    least = {}
    for i in range(64):
        keys = np.unique(rng.integers(0, 5000, 100).astype(np.uint64))
        ids = rng.integers(0, 1000, len(keys))
        index.add(keys, ids)
        for k, v in zip(keys.tolist(), ids.tolist()):
            least[k] = min(least.get(k, v), v)
    assert len(index.levels) <= 7
    asked = np.arange(5000, dtype=np.uint64)
    assert index.least(asked).tolist() == [least.get(k, windows.NO_ID) for k in range(5000)]


def test_least_of_is_a_sliding_minimum():
    values = np.random.default_rng(3).integers(0, 100, 60)
    for size in (1, 2, 27, 35):
        want = [values[i : i + size].min() for i in range(60 - size + 1)]
        assert suffix_index._least_of(values, size).tolist() == want


def test_suffixes_of_small_batches_equal_brute_force(docs, prose, monkeypatch):
    monkeypatch.setattr(windows, "RANGE_KEYS", 300)
    monkeypatch.setattr(suffix_index, "BATCH_DOCS", 5)
    rows = corpus(prose, 60)
    rows += [(i, text[7:]) for i, text in rows[:20]] + [(i, "ab" * 90) for i in (1, 70, None)]
    rows += [(71, "xab" * 120 + rows[0][1]), (72, "xab" * 70 + "c"), (72, "xab" * 200)]
    for gram in (5, 16, suffix_index.GRAM):
        found = suffix_index.remove_repeats(docs(rows), gram=gram).collect()
        want = sorted(
            (str(i), len(own), sum(gone), bytes(b for b, g in zip(own, gone) if not g))
            for (i, _), (own, gone) in zip(rows, units(rows, 50, str.encode))
        )
        got = [(str(r["id"]), r["n_bytes"], r["n_removed"], bytes(r["kept"])) for r in found]
        assert sorted(got) == want
        for r in found:
            spans = [(s["start"], s["end"]) for s in r["removed"]]
            assert sum(b - a for a, b in spans) == r["n_removed"]
            assert all(b < c for (_, b), (c, _) in zip(spans, spans[1:]))


def test_index_questions_are_few_and_even(spark, docs, prose, monkeypatch):
    """A batch sends at most one row to each range, and no range of anchors is hot."""
    monkeypatch.setattr(windows, "RANGE_KEYS", 1000)
    written = {}
    keep = suffix_index.written

    def spy(df, name):
        written[name] = keep(df, name)
        return written[name]

    monkeypatch.setattr(suffix_index, "written", spy)
    texts = prose(1500, 60, seed=8)
    total = sum(map(len, texts))
    frame = docs(list(enumerate(texts))).coalesce(1)
    assert suffix_index.remove_repeats(frame).count() == 1500
    rows = written["anchor-answers"].selectExpr("range", "length(bits) n").collect()
    ranges = total * 0.06 / 1000
    assert len(rows) < 2 * ranges  # 1,500 documents were six batches with two sets of ranges
    sizes = sorted(r["n"] for r in rows if r["range"] < int(ranges))
    assert sizes[-1] < 2 * sizes[len(sizes) // 2]


def suffixes_of(texts, length=50, gram=24):
    batch = windows.Batch(0, np.arange(len(texts)), texts)
    return suffix_index._Suffixes(batch, length, gram)


@pytest.mark.parametrize("length, gram", [(50, 24), (50, 16), (20, 5), (9, 9), (51, 3)])
def test_runs_hold_every_string_once(prose, monkeypatch, length, gram):
    texts = [t.encode() for t in prose(6, 90, seed=6, alphabet="ab")]
    texts += [b"", b"short", texts[1][30:], b"ab" * 300, b"ab" * 301, texts[2], b"x" * length]
    whole = suffixes_of(texts, length, gram)
    monkeypatch.setattr(suffix_index, "_BLOCK", 64)
    own = suffixes_of(texts, length, gram)
    for name in ("first", "counts", "doc", "anchor", "stretch"):
        assert (getattr(own, name) == getattr(whole, name)).all()
    starts, keys, docs = own.strings(np.ones(len(own.first), bool))
    begins = np.concatenate([[0], own.ends]).tolist()
    want = [(begins[d] + i, d) for d, t in enumerate(texts) for i in range(len(t) - length + 1)]
    assert list(zip(starts.tolist(), docs.tolist())) == want
    strings = [own.data[s : s + length] for s in starts.tolist()]
    assert len(set(strings)) == len(set(keys.tolist())) == len(set(zip(strings, keys.tolist())))
    anchors = np.repeat(own.anchor, own.counts).tolist()
    assert len(set(zip(strings, anchors))) == len(set(strings))
    spans = zip(own.first.tolist(), own.counts.tolist())
    stretches = [own.data[a : a + n + length - 1] for a, n in spans]
    pairs = set(zip(stretches, own.stretch.tolist()))
    assert len(pairs) == len(set(stretches)) == len(set(own.stretch.tolist()))


def test_stretches_need_entries_where_others_share_their_anchor():
    keys = [np.array([1, 2, 3, 6, 7], np.uint64), np.array([1, 4, 5, 6], np.uint64)]
    anchors = [np.array([10, 20, 30, 40, 50], np.uint64), np.array([10, 20, 30, 40], np.uint64)]
    ids = [np.array([1, 2, 3, 9, 9]), np.array([8, 7, 3, 2])]
    first, second = suffix_index._compared(keys, anchors, ids)
    assert first.tolist() == [False] * 3 + [True, False] + [False, True] + [False] * 3
    assert second.tolist() == [True, False, False, False] + [False, True, False, False]


def test_packed_numbers_and_order():
    rng = np.random.default_rng(4)
    numbers = np.sort(rng.integers(0, 1 << 63, 1000, dtype=np.uint64) * np.uint64(2))
    cuts = np.array([0, 0, 10, 700, 700, 1000])
    for steps in (False, True):
        packed = windows.packed_numbers(numbers, cuts, steps)
        parts = [windows.unpacked_numbers(p, n, steps) for p, n in zip(packed, (10, 690, 300))]
        assert (np.concatenate(parts) == numbers).all() and len(packed) == 3
    near = (numbers >> np.uint64(40)) | (numbers[500] << np.uint64(24))
    for keys in (rng.permutation(numbers), rng.permutation(near), numbers[:1], numbers[:0]):
        keys = np.concatenate([keys, keys])
        order, found = suffix_index._order(keys)
        assert (order == np.argsort(keys, kind="stable")).all() and (found == keys[order]).all()
