"""Quality rules on words and lines, and bands on tokeniser fertility.

Two public vocabularies, a byte-level BPE and one of pieces with byte fallback, measure
every word of a document: characters per token, the share of tokens that are bytes of a
broken character, and the entropy of the tokens relative to the most that their number
allows. The usual range of each measure is taken from all documents of a language (or of
a script, where the language is missing) and about the same length: Tukey's fences, two
interquartile ranges from the quartiles. A document outside a fence is rejected.

Defined results: a null, empty or blank text has no words, fails the base rules and is not
kept; a repeated row is judged like any other; where a group has fewer than
``MIN_GROUP`` documents the next coarser one counts, and a script with fewer rejects nothing,
since other scripts say nothing of its usual range; without a column for the language all go by script; an empty
table gives an empty one; other columns are neither read nor changed.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .common import annotate
from .tokens import bpe_words, byte_bpe, has_long_space, tokenizers_encoder, word_encoder

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
#: Words that go to a vocabulary at once.
WORDS_AT_ONCE = 5_000
_SYMBOLS = b"#*$%&|<>"
_SPACES = b" \t\n\x0b\x0c\r"

#: Fences stand this many interquartile ranges from the quartiles.
FENCE = 2.0
#: Fewest documents in a group whose bands reject any.
MIN_GROUP = 100
#: Narrowest range that counts as usual on either side of the quartiles, per measure.
MEASURES = {
    "chars_per_token": 0.05,
    "fallback_share": 0.03,
    "token_entropy": 0.05,
    "chars_per_piece": 0.05,
    "piece_fallback_share": 0.03,
    "piece_entropy": 0.05,
}

# First bytes of UTF-8 characters by script; ASCII letters count as Latin.
_SCRIPTS = ("other", "latin", "greek", "cyrillic", "semitic", "indic", "east_asian")
_SCRIPT_OF = np.zeros(256, np.int64)
_SCRIPT_OF[[*range(65, 91), *range(97, 123), *range(0xC3, 0xCA)]] = 1
_SCRIPT_OF[[0xCE, 0xCF]] = 2
_SCRIPT_OF[range(0xD0, 0xD4)] = 3
_SCRIPT_OF[range(0xD6, 0xDC)] = 4
_SCRIPT_OF[0xE0] = 5
_SCRIPT_OF[range(0xE3, 0xEE)] = 6


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words in windows that occur twice or more, the first occurrence included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    codes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    rolled, width, factor = codes, 1, 0x9E3779B97F4A7C15
    while width < window:  # windows of twice the width from two of the width, overlapping at last
        step = min(width, window - width)
        rolled = rolled[:-step] * np.uint64(factor) + rolled[step:]
        width, factor = width + step, factor * factor % 2**64
    in_order = np.sort(rolled)
    if not (in_order[1:] == in_order[:-1]).any():
        return 0
    order = np.argsort(rolled)
    same = rolled[order[1:]] == rolled[order[:-1]]
    # Equal windows have equal hashes; whether equal hashes are equal windows is looked up.
    suspects = np.unique(np.concatenate([order[1:][same], order[:-1][same]])).tolist()
    windows = {i: tuple(words[i : i + window]) for i in suspects}
    counts = Counter(windows.values())
    edges = np.zeros(len(words) + 1, np.int64)
    for i, key in windows.items():
        if counts[key] > 1:
            edges[i] += 1
            edges[i + window] -= 1
    return int((np.cumsum(edges) > 0).sum())


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip(_SPACES)]
    return len(lines) - len(set(lines))


def script_of(text: bytes) -> str:
    counts = np.bincount(_SCRIPT_OF[np.frombuffer(text, np.uint8)], minlength=len(_SCRIPTS))
    counts[0] = 0
    return _SCRIPTS[int(counts.argmax())] if counts.any() else _SCRIPTS[0]


def _entropy(ids: np.ndarray) -> float:
    """Entropy of the ids as a share of the entropy of as many different ones."""
    if len(ids) < 2:
        return 1.0
    counts = np.unique(ids, return_counts=True)[1] / len(ids)
    return float(-(counts * np.log(counts)).sum() / math.log(len(ids)))


def _broken(token: bytes) -> bool:
    try:
        token.decode()
    except UnicodeDecodeError:
        return True
    return False


def _vocabularies() -> list[tuple[Callable[[list[str]], list[bytes]], np.ndarray]]:
    """For each vocabulary: ids of words, and which ids are bytes of a broken character."""
    import public_tokenizers
    import sentencepiece

    bpe = byte_bpe()
    broken = np.array([_broken(bpe.decode_single_token_bytes(i)) for i in range(bpe.n_vocab)])
    piece = sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path("piece_bpe_32k.model")
    )
    fallback = np.array([piece.IsByte(i) for i in range(piece.GetPieceSize())])
    starts = np.array([piece.IdToPiece(i)[:1] == "\u2581" for i in range(piece.GetPieceSize())])
    by_bpe, by_tokenizers = bpe_words(bpe), tokenizers_encoder()

    def ids_of(words: list[str]) -> list[bytes]:
        # Only other characters than those that part words can make a run of white space here.
        if any(map(has_long_space, words)):
            return [by_tokenizers(" " + word) for word in words]
        return by_bpe(words)

    # This vocabulary puts the first space itself.
    by_piece = word_encoder(lambda text: np.array(piece.encode(text[1:]), "<u4"), starts)
    return [(ids_of, broken), (by_piece, fallback)]


def measured(df: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns and the counts and measures of each text."""
    return annotate(df, text_col, _measurer, _ADDED, keep)


_ADDED = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "script string, n_tokens long, " + ", ".join(f"{name} double" for name in MEASURES)
)


def _measurer() -> Callable[[bytes], dict]:
    vocabularies = _vocabularies()

    def measure(text: bytes) -> dict:
        words = text.split()
        chars = len(text.decode("utf-8", "replace")) - sum(text.count(s) for s in _SPACES)
        row = {
            "n_words": len(words),
            "word_chars": chars,
            "n_symbols": sum(text.count(s) for s in _SYMBOLS),
            "n_dup_lines": repeated_lines(text),
            "n_repeat_words": repeated_words(words),
            "script": script_of(text),
        }
        values, decoded = [], [word.decode("utf-8", "replace") for word in words]
        for ids_of, broken in vocabularies:
            blocks = (decoded[i : i + WORDS_AT_ONCE] for i in range(0, len(words), WORDS_AT_ONCE))
            ids = np.frombuffer(b"".join(b"".join(ids_of(block)) for block in blocks), "<u4")
            row.setdefault("n_tokens", len(ids))
            n = max(1, len(ids))
            values += [chars / n, float(broken[ids].sum()) / n, _entropy(ids)]
        return {**row, **dict(zip(MEASURES, values))}

    return measure


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


def _group(lang: Column) -> Column:
    """The language if it is a code of two or three letters, else the script.

    So there are at most some 18,000 languages, whatever the column holds.
    """
    code = F.lower(F.regexp_extract(lang, r"^([A-Za-z]{2,3})(?:[-_].*)?$", 1))
    return F.when(code != "", code).otherwise(F.concat(F.lit("script "), "script"))


#: Groups of documents from the finest to the coarsest; ``ALL_SIZES`` stands for any size.
LEVELS = ("size", "near sizes", "language", "script")
ALL_SIZES = -9


def _cell(level: int) -> tuple[Column, Column]:
    """The group and size of a document's band on a level."""
    group = F.concat(F.lit("script "), "script") if LEVELS[level] == "script" else F.col("group")
    return group, F.col("size") if level < 2 else F.lit(ALL_SIZES)


def bands(measures: DataFrame) -> DataFrame:
    """``level, group, size, <measure>_low, <measure>_high`` from all documents that pass the
    base rules; ``size`` is the number of tokens by powers of four, 32 at most. A document
    counts in its own size, in the near ones, and in all of its language and of its script.
    Bands of all sizes have no fences for entropy."""
    cells = []
    for level in range(len(LEVELS)):
        group, size = _cell(level)
        for by in (-1, 0, 1) if LEVELS[level] == "near sizes" else (0,):
            key = (F.lit(level).alias("level"), group.alias("group"), (size + by).alias("size"))
            cells.append(F.struct(*key))
    # Exact quartiles of values on a grid of 1/256: a sketch would depend on the order in
    # which tasks end, and the grid bounds the counts that are kept of each group.
    quartiles = [
        F.percentile(F.rint(F.col(m) * 256) / 256, F.array(F.lit(0.25), F.lit(0.75))).alias(m)
        for m in MEASURES
    ]
    dealt = measures.where(~F.col("base_failed")).select(
        F.explode(F.array(*cells)).alias("cell"), *MEASURES
    )
    found = dealt.groupBy("cell.level", "cell.group", "cell.size").agg(
        F.count("*").alias("n"), *quartiles
    )

    def fence(m: str, usual: float, sign: int) -> Column:
        low, high = F.col(m)[0], F.col(m)[1]
        reach = F.greatest(FENCE * (high - low), F.lit(usual))
        end = high + reach if sign > 0 else low - reach
        # Longer texts repeat more tokens: entropy says nothing across all sizes.
        return F.when(F.col("size") != ALL_SIZES, end) if m.endswith("entropy") else end

    return found.where(F.col("n") >= MIN_GROUP).select(
        "level",
        "group",
        "size",
        *[fence(m, u, -1).alias(f"{m}_low") for m, u in MEASURES.items()],
        *[fence(m, u, 1).alias(f"{m}_high") for m, u in MEASURES.items()],
    )


def _judged(measures: DataFrame) -> DataFrame:
    """``measures`` with ``kept``, by the finest band that a document has. The bands have at
    most 18,000 groups of 35 sizes, of some 100 bytes each, and in practice a few hundred
    rows, so they are broadcast."""
    found = written(bands(measures), "bands")
    limits = [f"{m}_{side}" for m in MEASURES for side in ("low", "high")]
    judged, levels = measures, range(len(LEVELS))
    for level in levels:
        own = found.where(F.col("level") == level).select(
            F.col("group").alias("band_group"),
            F.col("size").alias("band_size"),
            F.struct(*limits).alias(f"band{level}"),
        )
        group, size = _cell(level)
        at = (group == F.col("band_group")) & (size == F.col("band_size"))
        judged = judged.join(F.broadcast(own), at, "left").drop("band_group", "band_size")
    judged = judged.withColumn("band", F.coalesce(*[F.col(f"band{level}") for level in levels]))
    inside = F.lit(True)
    for m in MEASURES:
        # Without a fence, the comparison is null: nothing is rejected.
        usual = F.col(m).between(F.col(f"band.{m}_low"), F.col(f"band.{m}_high"))
        inside &= F.coalesce(usual, F.lit(True))
    return judged.select(*measures.columns, (~F.col("base_failed") & inside).alias("kept"))


def _grouped(measures: DataFrame, lang: Column) -> DataFrame:
    size = F.floor(F.log2(F.col("n_tokens") + 1) / 2).cast("int")
    return measures.select(
        "*", base_failed().alias("base_failed"), _group(lang).alias("group"), size.alias("size")
    )


def judge(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str | None = "lang",
) -> DataFrame:
    """``id``, the counts and measures, ``base_failed`` and ``kept`` of each document."""
    texts = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        _language(docs, lang_col).alias("lang"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    )
    rows = _grouped(measured(texts, "text", ["id", "lang"]), F.col("lang"))
    return _judged(written(rows, "quality")).drop("lang", "group", "size")


def _language(docs: DataFrame, lang_col: str | None) -> Column:
    known = lang_col is not None and lang_col in docs.columns
    return (F.col(f"`{lang_col}`") if known else F.lit(None)).cast("string")


def keep_good(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str | None = "lang",
) -> DataFrame:
    """The documents, all columns, that are kept. They are written once with their measures,
    so that a second reading needs no tokeniser and no join of texts."""
    whole = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document"),
        _language(docs, lang_col).alias("lang"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    )
    rows = _grouped(measured(whole, "text", ["document", "lang"]), F.col("lang"))
    return _judged(written(rows, "quality")).where("kept").select("document.*")
