import collections
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from assayer.llm import packing, tokens


def placed(histogram, capacity):
    """Every piece of the plan as ``(length, rank, sequence, offset)``."""
    runs, made = packing.plan(histogram, capacity)
    out = []
    for r in runs:
        for i in range(r.count):
            out.append((r.length, r.first + i, r.sequence + i // r.each, r.offset + i % r.each * r.length))
    return out, made


@settings(deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 40)))
def test_plan_places_every_piece_without_gaps(histogram):
    out, made = placed(histogram, 32)
    assert sorted((l, k) for l, k, _, _ in out) == sorted(
        (l, k) for l, n in histogram.items() for k in range(n)
    )
    filled = collections.defaultdict(int)
    for length, _, sequence, offset in sorted(out, key=lambda p: (p[2], p[3])):
        assert offset == filled[sequence]
        filled[sequence] += length
    assert sorted(filled) == list(range(made)) and all(n <= 32 for n in filled.values())
    # Not more than best-fit decreasing one by one.
    rests = []
    for length in sorted((l for l, n in histogram.items() for _ in range(n)), reverse=True):
        fitting = [r for r in rests if r >= length]
        best = min(fitting) if fitting else 32
        if fitting:
            rests.remove(best)
        rests.append(best - length)
    assert made == len(rests)


def test_cut():
    assert list(packing.cut(5, 4)) == [(0, 1), (1, 4)]
    assert list(packing.cut(8, 4)) == [(0, 4), (4, 4)] and list(packing.cut(3, 4)) == [(0, 3)]


TRICKY = [
    "", " ", "a", " a", "a ", "a  b", "a \n b", "\n\n x", "it's 'll  we've", "é\u00a0b", "x\u2003 y",
    "a\x1c b", "tab\t x", "1 2  3", "<|endoftext|> a", "a <|endoftext|>", "\U0001f600 \u200d z", "don't\r\n ok",
]


def own_ids():
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def test_ids_are_those_of_tokenizers(spark, sf_dir, prose):
    want, encode = own_ids(), tokens.text_encoder()
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()
    for text in [*TRICKY, *[r["text"] for r in rows]]:
        assert np.frombuffer(encode(text), "<u4").tolist() == want(text), text[:50]


@settings(deadline=None, max_examples=300)
@given(st.text(st.sampled_from("ab1' \n\t\u00a0.é"), max_size=25))
def test_ids_of_odd_white_space(text):
    whole = test_ids_of_odd_white_space.__dict__.setdefault("ids", own_ids())
    encode = test_ids_of_odd_white_space.__dict__.setdefault("encode", tokens.text_encoder())
    assert np.frombuffer(encode(text), "<u4").tolist() == whole(text)


@pytest.fixture(scope="module")
def vocabularies():
    import public_tokenizers
    import sentencepiece

    piece = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    starts = np.array([piece.IdToPiece(i)[:1] == "\u2581" for i in range(piece.GetPieceSize())])
    by_piece = tokens.word_encoder(lambda text: np.array(piece.encode(text[1:]), "<u4"), starts)
    bpe = tokens.byte_bpe()
    return (by_piece, piece.encode), (tokens.bpe_words(bpe), lambda w: bpe.encode(" " + w))


WORD = st.text(st.sampled_from("ab1'\u00a0\u2028\u2581\u200bé漢"), min_size=1, max_size=6)


@settings(deadline=None, max_examples=200)
@given(words=st.lists(WORD, min_size=1, max_size=9))
def test_words_together_have_the_ids_of_words_alone(vocabularies, words):
    for together, alone in vocabularies:
        for _ in range(2):  # the second time from memory
            assert together(words) == [tokens.as_bytes(alone(w)) for w in words]


def test_very_long_white_space_and_words(docs):
    texts = ["a" + " " * 1_000_000 + "b", "\n" * 1_000_000, "a\u00a0" * 3 + "\u2003" * 500_000]
    packed = packing.pack_documents(docs(enumerate(texts)), keep_ids=True)
    got = collections.defaultdict(list)
    for r in sorted(packed.collect(), key=lambda r: r["piece"]):
        got[r["id"]] += r["ids"]
    want = own_ids()
    assert [got[i] for i in range(3)] == [[*want(t), 2] for t in texts]


def test_memory_of_words_is_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 3)
    calls = []
    call = tokens.remembered(lambda x: calls.append(x) or -x)
    for values in ([1, 2, 3, 4, 5], [1, 2], [6, 1], [1, 2, 6]):
        assert call(values) == [-v for v in values]
    assert calls == [1, 2, 3, 4, 5, 6, 1, 2]


def test_pieces_and_sequences(docs, prose, edges):
    rows = [*edges, *[(100 + i, t) for i, t in enumerate(prose(30, 100, seed=1))]]
    packed = packing.pack_documents(docs(rows), capacity=64, keep_ids=True)
    want = own_ids()
    got = collections.defaultdict(list)
    at = collections.defaultdict(int)
    for r in sorted(packed.collect(), key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == at[r["sequence_id"]] and r["length"] == len(r["ids"])
        at[r["sequence_id"]] += r["length"]
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        got[r["id"]].append((r["piece"], r["start"], r["ids"]))
    expected = collections.defaultdict(list)
    for key, text in rows:
        ids = [*want(text or ""), 2]
        cuts = packing.cut(len(ids), 64)
        expected[key] += [(i, a, ids[a : a + n]) for i, (a, n) in enumerate(cuts)]
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in expected.items()}
    assert max(at.values()) <= 64
    whole = packing.sequences(packed).collect()
    assert sorted(len(r["ids"]) for r in whole) == sorted(at.values())
    assert packing.pack_documents(docs([])).count() == 0


def test_a_text_is_encoded_at_once(monkeypatch):
    bpe, texts = tokens.byte_bpe(), ["one two three", " a  b\n c ", "", "é two " * 300]
    met = []

    class Counted:
        n_vocab, decode_single_token_bytes = bpe.n_vocab, bpe.decode_single_token_bytes

        def encode_to_numpy(self, text):
            met.append(text)
            return bpe.encode_to_numpy(text)

    monkeypatch.setattr(tokens, "byte_bpe", Counted)
    encode, want = tokens.text_encoder(), tokens.tokenizers_encoder()
    assert [encode(text) for text in texts] == list(map(want, texts))
    assert met == texts
