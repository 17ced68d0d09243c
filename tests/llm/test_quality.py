import collections
import re

import corpus_pipeline
from hypothesis import given
from hypothesis import strategies as st

from assayer.llm import quality


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counts = collections.Counter(windows)
    hit = {i + j for i, w in enumerate(windows) if counts[w] > 1 for j in range(8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        dup,
        len(hit),
    )


TEXT = st.lists(st.sampled_from(["a", "b", " ", " ", "\n", "a b\n", "é#", "\x85", "\x1c"]), max_size=60)


@given(TEXT.map("".join))
def test_counts(text):
    raw = text.encode()
    assert (quality.repeated_words(raw.split()), quality.repeated_lines(raw)) == brute(text)[:2:-1]


def test_judged_counts_and_rules(docs, prose, edges):
    rows = [*enumerate(prose(20, seed=2)), *edges, (90, "spam ham " * 40), (91, "a\nb\na\n" * 9)]
    found = quality.judge(docs(rows))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = sorted((str(r["id"]), *[r[n] for n in names], r["kept"]) for r in found.collect())
    want = []
    for i, text in rows:
        n = brute(text or "")
        want.append((str(i), *n, not (n[0] < 20 or 100 * n[4] > 30 * n[0])))
    assert got == sorted(want)


def test_bands_reject_outliers_of_a_language_only(docs, prose):
    usual = [(i, t, "de") for i, t in enumerate(prose(150, 90, seed=6))]
    odd = " ".join(chr(0x4E00 + i * 7) for i in range(30))
    rows = [*usual, (500, odd, "de"), (501, odd, None)]
    kept = {r["id"]: r["kept"] for r in quality.judge(docs(rows)).collect()}
    assert not kept[500] and kept[501] and sum(kept.values()) >= 150
    whole = quality.keep_good(docs(rows))
    assert whole.columns == docs(rows).columns
    assert {r["doc_id"] for r in whole.collect()} == {i for i, k in kept.items() if k}


def test_scripts():
    assert quality.script_of("abc где".encode()) == "latin"
    assert quality.script_of("где ёж a".encode()) == "cyrillic"
    assert quality.script_of("漢字 a".encode()) == "east_asian"
    assert quality.script_of(b"12 34") == "other"


def test_empty_and_missing_language(docs):
    assert quality.judge(docs([])).count() == 0 and quality.keep_good(docs([])).count() == 0
    assert quality.judge(docs([(1, "a " * 30)]).drop("lang")).first()["n_words"] == 30


def test_pipeline_stage_rejects_junk_inside_bands(spark, docs, prose):
    texts = prose(300, 90, seed=3, alphabet="abcdefghilmnorstu")
    junk = [" ".join(w + "###" * (i % 3 == 0) for i, w in enumerate(t.split())) for t in texts[:12]]
    rows = [*enumerate(texts), *enumerate(junk, 1000)]
    stage = dict(corpus_pipeline.STAGES)["quality rules"]
    kept = {r["doc_id"] for r in stage(spark, docs(rows), "").collect()}
    assert sum(i >= 1000 for i in kept) <= 3
    assert sum(i < 1000 for i in kept) >= 290


def test_small_groups_are_judged_by_coarser_bands(docs, prose):
    texts = prose(300, 90, seed=3, alphabet="abcdefghilmnorstu")
    long = " ".join(texts[:40])
    odd = [long.replace(" ", "### "), texts[1].replace(" ", "### ")]
    rows = [*enumerate(texts), (1000, odd[0], "en"), (1001, odd[1], "xx"), (1002, odd[1], None)]
    rows += [(1003, long, "en"), (1004, texts[1], "xx"), (1005, texts[1], None)]
    kept = {r["id"]: r["kept"] for r in quality.judge(docs(rows)).collect()}
    assert [kept[i] for i in range(1000, 1006)] == [False] * 3 + [True] * 3
    assert {r["doc_id"] for r in quality.keep_good(docs(rows)).collect()} == {
        i for i, k in kept.items() if k
    }


def test_very_long_white_space_inside_a_word(docs):
    text = "a " * 30 + "b" + "\u2003" * 500_000 + "c" + " " * 1_000_000 + "d"
    row = quality.judge(docs([(1, text)])).first()
    assert row["n_words"] == 32 and row["word_chars"] == 500_033
