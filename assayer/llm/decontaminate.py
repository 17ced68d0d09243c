"""Benchmark decontamination by windows of normalised words.

The benchmark's windows form a hash set that is broadcast in blocks of a bounded size;
every block is scanned against all documents in place, so texts are never shuffled and no
key can be hot. A hit of the hash is verified against the words themselves.

Defined results: a null or wordless text has no windows and no hits; a null or wordless
item matches nothing; a null item id is listed as an empty string; items that share an
id count once; repeated documents each get their own row; an empty benchmark hits
nothing; other columns are neither read nor, where rows are returned, changed.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from .common import annotate, filter_rows, free_name, texts_of

WINDOW = 10
#: Characters of benchmark windows that are broadcast at once.
BLOCK_CHARS = 32 << 20

# Lower-case letters and digits stay, A-Z are lowered, other ASCII separates words.
_NORMAL = bytes(
    b if b >= 0x80 else ord(chr(b).lower()) if chr(b).isalnum() else 0x20 for b in range(256)
)
_WORD = re.compile(rb"[^ ]+")


def normal_words(text: bytes) -> list[bytes]:
    return text.translate(_NORMAL).split()


def _windows(words: list[bytes], size: int) -> set[bytes]:
    if not words:
        return set()
    return {b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def benchmark_windows(
    benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", window: int = WINDOW
) -> DataFrame:
    """``key, items``: each distinct window, words joined by spaces, and the items that have it."""

    def make() -> Callable[[bytes], dict]:
        return lambda text: {"keys": list(_windows(normal_words(text), window))}

    items = texts_of(benchmark, item_col, text_col).select(
        F.coalesce(F.col("id").cast("string"), F.lit("")).alias("item"), "text"
    )
    return (
        annotate(items, "text", make, "keys array<string>", ["item"])
        .select(F.explode("keys").alias("key"), "item")
        .groupBy("key")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )


class WindowSet:
    """Windows of a block, by their words' numbers; finds their places in a document."""

    def __init__(self, windows: Iterable[tuple[bytes, list[str]]]):
        self.items = {tuple(key.split(b" ")): items for key, items in windows}
        self.numbers: dict[bytes, int] = {}
        for key in self.items:
            for word in key:
                self.numbers.setdefault(word, len(self.numbers) + 1)
        rng = np.random.default_rng(7)
        self.codes = rng.integers(1, 1 << 63, len(self.numbers) + 1, dtype=np.uint64)
        self.base = np.uint64(0x9E3779B97F4A7C15)
        by_size: dict[int, list[int]] = {}
        for key in self.items:
            row = self.codes[[self.numbers[w] for w in key]]
            by_size.setdefault(len(key), []).append(int(self._rolled(row, len(key))[0]))
        self.hashes = {n: np.unique(np.array(h, np.uint64)) for n, h in by_size.items()}

    def _rolled(self, codes: np.ndarray, size: int) -> np.ndarray:
        n = len(codes) - size + 1
        out = np.zeros(n, np.uint64)
        for j in range(size):
            out = out * self.base + codes[j : j + n]
        return out

    def find(self, words: list[bytes]) -> list[tuple[int, int, list[str]]]:
        """``(start, size, items)`` of every occurrence of a window."""
        known = np.fromiter(map(self.numbers.get, words, repeat(0)), np.int64, len(words))
        codes = None
        found = []
        outside = np.concatenate([[0], np.cumsum(known == 0)])
        for size, hashes in self.hashes.items():
            if size > len(words):
                continue
            # Only windows of nothing but benchmark words can match.
            starts = np.flatnonzero(outside[size:] == outside[:-size])
            if not len(starts):
                continue
            codes = self.codes[known] if codes is None else codes
            rolled = self._rolled(codes, size)[starts]
            place = np.minimum(np.searchsorted(hashes, rolled), len(hashes) - 1)
            for start in starts[hashes[place] == rolled].tolist():
                items = self.items.get(tuple(words[start : start + size]))
                if items is not None:
                    found.append((start, size, items))
        return found


def _hit_words(found: list[tuple[int, int, list[str]]], n: int) -> np.ndarray:
    edges = np.zeros(n + 1, np.int64)
    for start, size, _ in found:
        edges[start] += 1
        edges[start + size] -= 1
    return np.cumsum(edges[:n]) > 0


def _runs(hit: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return [(int(a), int(b)) for a, b in zip(edges[::2], edges[1::2])]


def without_words(text: bytes, hit: np.ndarray) -> bytes:
    """The text without each run of hit words, from its first word's first byte to its
    last word's last."""
    places = [m.span() for m in _WORD.finditer(text.translate(_NORMAL))]
    kept, at = [], 0
    for first, last in _runs(hit):
        kept.append(text[at : places[first][0]])
        at = places[last - 1][1]
    return b"".join([*kept, text[at:]])


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int, block_chars: int):
    """A broadcast set for each block of windows, of a bounded number of characters."""
    windows = benchmark_windows(benchmark, item_col, text_col, window)
    spark = benchmark.sparkSession
    chars = F.length("key") + F.length(F.array_join("items", ","))
    table = written(windows.withColumn("chars", chars), "benchmark-windows")
    total = table.agg(F.sum("chars")).first()[0] or 0
    n = -(-total // block_chars)
    for i in range(n):
        rows = table.where(F.pmod(F.xxhash64("key"), F.lit(n)) == i).select("key", "items")
        found = [(r["key"].encode(), r["items"]) for r in rows.collect()]
        yield spark.sparkContext.broadcast(WindowSet(found))


def scan_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``id, n_words, spans, items`` per document: hit runs of words and the items found."""
    blocks = list(_blocks(benchmark, item_col, item_text_col, window, block_chars))
    added = "n_words long, spans array<struct<start:int,end:int>>, items array<string>"

    def make() -> Callable[[bytes], dict]:
        def scan(text: bytes) -> dict:
            words = normal_words(text)
            found = [f for block in blocks for f in block.value.find(words)]
            runs = _runs(_hit_words(found, len(words))) if found else []
            return {
                "n_words": len(words),
                "spans": [{"start": a, "end": b} for a, b in runs],
                "items": sorted({item for _, _, items in found for item in items}),
            }

        return scan

    return annotate(texts_of(docs, id_col, text_col), "text", make, added, ["id"])


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    mode: str = "documents",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The documents, all columns, without contaminated ones (``mode="documents"``) or
    with the hit words cut out of their texts (``mode="spans"``)."""
    if mode not in ("documents", "spans"):
        raise ValueError("mode must be 'documents' or 'spans'")
    blocks = list(_blocks(benchmark, item_col, item_text_col, window, block_chars))

    def clean() -> Callable[[bytes], bool]:
        def passes(text: bytes) -> bool:
            words = normal_words(text)
            return not any(block.value.find(words) for block in blocks)

        return passes

    if mode == "documents":
        return filter_rows(docs, text_col, clean)

    def cut(texts):
        import pandas as pd

        for series in texts:
            out = []
            for text in series:
                raw = (text or "").encode()
                words = normal_words(raw)
                found = [f for block in blocks for f in block.value.find(words)]
                if found:
                    text = without_words(raw, _hit_words(found, len(words))).decode()
                out.append(text)
            yield pd.Series(out, dtype=object)

    from collections.abc import Iterator

    import pandas as pd

    cut.__annotations__ = {"texts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    name = free_name(docs, "cleaned")
    cleaned = docs.withColumn(name, F.pandas_udf("string")(cut)(F.col(f"`{text_col}`")))
    return cleaned.select(
        *[F.col(f"`{name if c == text_col else c}`").alias(c) for c in docs.columns]
    )


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()
