import re

import pytest

from assayer.llm import decontaminate as d


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(rows, items, size=10):
    out = []
    for key, text in rows:
        own, hit, found = words(text), set(), set()
        for item, other in items:
            theirs = words(other)
            spans = [theirs[i : i + size] for i in range(max(1, len(theirs) - size + 1))]
            for span in spans if theirs else []:
                for i in range(len(own) - len(span) + 1):
                    if own[i : i + len(span)] == span:
                        hit.update(range(i, i + len(span)))
                        found.add("" if item is None else str(item))
        out.append((str(key), len(own), len(hit), sorted(found)))
    return sorted(out)


@pytest.fixture(scope="module")
def tables(spark, docs, prose, edges):
    texts = prose(60, 90, seed=8)
    items = [(i, t) for i, t in enumerate(prose(12, 30, seed=9))]
    items += [(100, "Köln! is, far"), (101, None), (102, " ,.; "), (103, "One"), (None, "two three"),
              (7, items[3][1]), (8, items[8][1])]
    rows = [(200 + i, t) for i, t in enumerate(texts)]
    for i in range(0, 60, 4):
        quote = items[i % 12][1].split()
        rows[i] = (200 + i, f"{texts[i]}, {'; '.join(quote).upper()}. {texts[i]}")
    rows += [*edges, (70, "in KÖLN köln is far"), (71, "K\u00d6LN k\u00f6ln-IS_far two, three one")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    return rows, items, docs(rows), benchmark


@pytest.mark.parametrize("block", [d.BLOCK_CHARS, 500])
def test_scan_equals_brute_force(tables, block):
    rows, items, frame, benchmark = tables
    found = d.scan_benchmark(frame, benchmark, block_chars=block).collect()
    got = sorted(
        (str(r["id"]), r["n_words"], sum(s["end"] - s["start"] for s in r["spans"]), r["items"])
        for r in found
    )
    assert got == brute(rows, items)


def test_documents_and_spans(tables):
    rows, items, frame, benchmark = tables
    clean = sorted(key for key, _, hits, _ in brute(rows, items) if not hits)
    kept = d.decontaminate(frame, benchmark)
    assert kept.columns == frame.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == clean
    cut = d.decontaminate(frame, benchmark, mode="spans")
    assert cut.columns == frame.columns and cut.count() == len(rows)
    texts = {str(r["doc_id"]): r["text"] for r in cut.collect()}
    assert all(texts[str(k)] == t for k, t in rows if k is not None and str(k) in clean)
    assert texts["71"] == "KÖLN "
    with pytest.raises(ValueError):
        d.decontaminate(frame, benchmark, mode="lines")


def test_empty_tables(docs, spark):
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert d.scan_benchmark(docs([]), nothing).count() == 0
    assert d.scan_benchmark(docs([(1, "a b")]), nothing).first()["items"] == []
    assert d.decontaminate(docs([(1, "a b")]), nothing).count() == 1
