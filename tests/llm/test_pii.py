import re

from hypothesis import given
from hypothesis import strategies as st

from assayer.llm import pii

PATTERNS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def holds(kind, text):
    digits = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def brute(text):
    found = [
        (m.start(), i, m.end(), kind)
        for i, (kind, pattern) in enumerate(PATTERNS)
        for m in re.finditer(pattern, text)
        if holds(kind, m[0])
    ]
    return [(k, a, b) for a, _, b, k in sorted(found)]


PART = st.sampled_from(
    ["a", "@", ".", "b.c", "x@y.z", "-", " ", "+", "1", "25", "255", "256", "0", "007", "(", ")", "4", "é",
     "4111111111111111", "12.34.56.78", "+1 (555) 123-4567", "%", "5500 0000 0000 0004"]
)


@given(st.lists(PART, max_size=14).map("".join))
def test_base_spans_are_those_of_the_patterns(text):
    raw = text.encode()
    found = [(k, len(raw[:a].decode()), len(raw[:b].decode())) for k, a, b in pii.base_spans(raw)]
    assert found == brute(text)


def test_long_runs_take_linear_time():
    text = ("a" * 200_000 + "@" + "1" * 200_000 + "@b.c " + "1." * 3).encode()
    assert [k for k, _, _ in pii.base_spans(text)] == ["email"]


def test_learns_formats_and_leaves_prose(spark, docs, prose):
    rows = []
    for i, text in enumerate(prose(300, seed=3)):
        if i % 2:
            text += f" call phone +1 (555) 010-{1000 + i} now"
        if i % 3 == 0:
            text += f" order {10**13 + i * 7919} item {i}.400.3.{i}"
        rows.append((i, text))
    found = pii.find_personal_data(docs(rows)).collect()
    texts = dict(rows)
    assert sum(len(r["base"]) for r in found) >= 150
    for r in found:
        base = [(s["kind"], s["start"], s["end"]) for s in r["base"]]
        assert base == brute(texts[r["id"]])
        for e in r["extra"]:
            assert not any(e["start"] < b and a < e["end"] for _, a, b in base)
    assert sum(bool(r["extra"]) for r in found) <= 15


def test_edges(docs, edges):
    rows = pii.find_personal_data(docs(edges)).collect()
    assert len(rows) == len(edges) and not any(r["base"] or r["extra"] for r in rows)
    assert pii.find_personal_data(docs([])).count() == 0
    one = pii.find_personal_data(docs([(1, "a@b.c"), (1, "a@b.c"), (2, None)])).collect()
    assert sorted(len(r["base"]) for r in one) == [0, 1, 1]


def test_octets_of_any_length():
    zeros = b"0" * 5_000
    text = b"1.2.3." + zeros + b"4 1.2.3." + b"9" * 5_000 + b" 1.2." + zeros + b".255"
    assert [kind for kind, _, _ in pii.base_spans(text)] == ["ip", "ip"]


def test_every_candidate_is_learned_from_or_calibrated_on(spark):
    kept = [(row, ("number", row % 2, [float(row % 2), 7.0])) for row in range(24_003)]
    schema = "row long, c struct<kind:string,label:int,features:array<double>>"
    found = pii.labelled(spark.createDataFrame(kept, schema))
    sums = {(r["learned"], r["label"]): r["n"] for r in found.collect()}
    assert len(sums) == 4 and sum(sums.values()) == 24_003
    assert all(9_000 < n < 10_200 for (learned, _), n in sums.items() if learned)
    assert [sum(n for (_, label), n in sums.items() if label == i) for i in (0, 1)] == [12_002, 12_001]
