"""Public vocabularies on executors: token ids of texts and words, remembering words already met."""

from __future__ import annotations

import base64
import re
from collections.abc import Callable

import numpy as np

#: Words remembered per task; beyond that the memory starts anew.
REMEMBERED = 300_000

# tiktoken recurses over a run of white space, and dies of some hundreds of thousands.
LONG_RUN = 10_000
_LONG_SPACE = re.compile(rf"\s{{{LONG_RUN}}}")
# Characters in a word that may be read as the border of another one.
_BORDER = re.compile("[\\s\u2581\u200b-\u200f\u2060\ufeff]")
SPECIAL = "<|endoftext|>"


def byte_bpe(name: str = "byte_bpe_50k.tiktoken"):
    """A tiktoken encoding of a public vocabulary, without special tokens."""
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(name), "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding(
        name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def as_bytes(ids) -> bytes:
    """Ids as little-endian unsigned 32-bit numbers."""
    return np.asarray(ids, "<u4").tobytes()


def tokenizers_encoder() -> Callable[[str], bytes]:
    """Ids of ``byte_bpe_50k.json`` by ``tokenizers``, which takes any text; loaded when called."""
    whole = []

    def run(text: str) -> bytes:
        if not whole:
            import public_tokenizers
            from tokenizers import Tokenizer

            whole.append(Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")))
        return as_bytes(whole[0].encode(text, add_special_tokens=False).ids)

    return run


def has_long_space(text: str) -> bool:
    return len(text) >= LONG_RUN and _LONG_SPACE.search(text) is not None


def remembered(function: Callable, together: bool = False) -> Callable:
    """``function`` of one hashable value, for lists of them, remembering a bounded number of
    results; with ``together`` it takes all that are missing of a list, and gives a list."""
    known: dict = {}

    def call(values: list) -> list:
        out = list(map(known.get, values))
        if None in out:
            if len(known) > REMEMBERED:
                known.clear()
            missing = list(dict.fromkeys(v for v, found in zip(values, out) if found is None))
            known.update(zip(missing, function(missing) if together else map(function, missing)))
            out = [known[v] if found is None else found for v, found in zip(values, out)]
        return out

    return call


def word_encoder(
    encode: Callable[[str], np.ndarray], starts: np.ndarray
) -> Callable[[list[str]], list[bytes]]:
    """Ids of words, each as if it stood alone after a space.

    ``encode`` gives the ids of several words in one text, each after a space, and ``starts`` tells
    which ids begin a word. Where they may not tell the words apart, each is encoded by itself.
    """

    def new(words: list[str]) -> list[bytes]:
        if len(words) > 1 and _BORDER.search("".join(words)):
            plain = [w for w in words if not _BORDER.search(w)]
            found = dict(zip(plain, new(plain))) if plain else {}
            return [found[w] if w in found else new([w])[0] for w in words]
        ids = encode(" " + " ".join(words))
        first = np.flatnonzero(starts[ids])
        if len(first) != len(words) or first[0] != 0:
            if len(words) == 1:
                return [as_bytes(ids)]
            return [found for word in words for found in new([word])]
        raw, ends = as_bytes(ids), [*(4 * first).tolist(), 4 * len(ids)]
        return [raw[a:b] for a, b in zip(ends, ends[1:])]

    return remembered(new, together=True)


def bpe_words(encoding) -> Callable[[list[str]], list[bytes]]:
    """A word encoder of a tiktoken encoding. Words without white space of their own."""
    tokens = [encoding.decode_single_token_bytes(i) for i in range(encoding.n_vocab)]
    return word_encoder(encoding.encode_to_numpy, np.array([t[:1] == b" " for t in tokens]))


def text_encoder() -> Callable[[str], bytes]:
    """Ids of ``byte_bpe_50k.json`` for a whole text, as little-endian unsigned 32-bit numbers.

    The same vocabulary is run by tiktoken, on the text at once: parting it into words and
    remembering theirs costs more than it saves; tests hold the ids against those of
    ``tokenizers``. Only texts that spell the special token or hold a very long run of white
    space are left to ``tokenizers``.
    """
    encoding, by_tokenizers = byte_bpe(), tokenizers_encoder()

    def run(text: str) -> bytes:
        if SPECIAL in text or has_long_space(text):
            return by_tokenizers(text)
        return as_bytes(encoding.encode_to_numpy(text))

    return run
