"""Secret scans: three fixed patterns, and a battery of randomness tests on long tokens.

A token of 20 or more characters of the base64 alphabets is read as the smallest encoding
that holds it (hex, base32, base64). Under that encoding's uniform distribution it is
tested for the frequencies of its letters (chi-squared), the runs above and below the middle
of the alphabet, and serial correlation; Fisher's method combines the three, and a token
that they reject is not random. Against the other null hypothesis, that the token
is ordinary text, stands the likelihood ratio of the uniform letters to the letter
frequencies counted over all documents, whose mean and variance are known for each length.
False discoveries among these p-values are controlled within bands of lengths (Benjamini
and Hochberg), since a short token can never be as sure a find as a long one.

Defined results: a null or empty text has no spans; a repeated row gets its own, equal row;
without any long token no band has a threshold; an empty table gives an empty one; other
columns are not read, and returned unchanged by ``redact``.
"""

from __future__ import annotations

import math
import re
import string
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .common import Batches, annotate, arrow_schema, texts_of

# The patterns of the base kinds.
KINDS = ("assign", "access", "hex", "random")
_ASSIGN = re.compile(
    rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE,
)
_ACCESS = re.compile(rb"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(rb"[0-9a-f]{24,}")
_NAMES = re.compile(rb"pass|secret|token|api", re.IGNORECASE)
_TOKEN = re.compile(rb"[A-Za-z0-9+/_-]{20,}")

#: Rate of false discoveries allowed in each band of lengths.
FALSE_RATE = 0.01
#: A token whose combined p-value under randomness is lower is not random.
NOT_RANDOM = 0.001
MASK = "[SECRET]"

_ALPHABETS = {
    "hex": "0123456789abcdef",
    "upper hex": "0123456789ABCDEF",
    "base32": string.ascii_uppercase + "234567",
    "base64": string.ascii_uppercase + string.ascii_lowercase + string.digits + "+/",
    "base64url": string.ascii_uppercase + string.ascii_lowercase + string.digits + "-_",
}
_LETTERS = {name: frozenset(letters.encode()) for name, letters in _ALPHABETS.items()}
_DIGITS = frozenset(string.digits.encode())
# Natural log-likelihood ratios in units of their standard deviation, by tenths.
_BINS, _STEPS = 400, 10


def base_spans(text: bytes) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` in bytes, by start, then by the order of the kinds."""
    spans = []
    if _NAMES.search(text):
        spans += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    spans += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def encoding_of(token: bytes) -> str | None:
    """The smallest alphabet that holds a token; plain numbers are not encoded."""
    letters = set(token)
    if letters <= _DIGITS:
        return None
    return next((name for name, own in _LETTERS.items() if letters <= own), None)


def normal_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def randomness(codes: np.ndarray, k: int) -> float:
    """Combined p-value of the battery for ``codes`` below ``k``, under uniform randomness."""
    n = len(codes)
    counts = np.bincount(codes, minlength=k)
    chi = k / n * float((counts**2).sum()) - n
    p_chi = normal_tail((chi - (k - 1)) / math.sqrt(2 * (k - 1) * (n - 1) / n))
    high = codes >= k // 2
    n1 = int(high.sum())
    n2 = n - n1
    if not n1 or not n2:
        return 0.0
    runs = 1 + int((high[1:] != high[:-1]).sum())
    mean = 2 * n1 * n2 / n + 1
    variance = (mean - 1) * (mean - 2) / (n - 1)
    p_runs = 2 * normal_tail(abs(runs - mean) / math.sqrt(variance)) if variance > 0 else 0.0
    centred = codes - codes.mean()
    r = float((centred[1:] * centred[:-1]).sum() / (centred**2).sum())
    p_serial = 2 * normal_tail(abs(r + 1 / n) * math.sqrt(n))
    x = -sum(math.log(max(p, 1e-300)) for p in (p_chi, p_runs, p_serial))
    return math.exp(-x) * (1 + x + x * x / 2)  # chi-squared with six degrees, above 2x


@dataclass(frozen=True)
class Letters:
    """For each encoding: the codes of bytes, and the log-likelihood ratio of each code with
    its mean and variance under the letter frequencies of ordinary text."""

    tables: dict[str, tuple[np.ndarray, np.ndarray, float, float]]

    @staticmethod
    def of(counts: np.ndarray) -> Letters:
        tables = {}
        for name, letters in _ALPHABETS.items():
            own = np.frombuffer(letters.encode(), np.uint8)
            codes = np.zeros(256, np.int64)
            codes[own] = np.arange(len(own))
            share = (counts[own] + 1.0) / (counts[own].sum() + len(own))
            ratio = -np.log(share * len(own))
            mean = float((share * ratio).sum())
            variance = float((share * ratio**2).sum()) - mean**2
            tables[name] = (codes, ratio, mean, max(variance, 1e-12))
        return Letters(tables)

    def tests(self, token: bytes) -> tuple[str, float, float] | None:
        """Encoding, p-value under randomness, and z-score against ordinary text."""
        name = encoding_of(token)
        if name is None:
            return None
        codes, ratio, mean, variance = self.tables[name]
        own = codes[np.frombuffer(token, np.uint8)]
        n = len(own)
        z = (float(ratio[own].sum()) - n * mean) / math.sqrt(n * variance)
        return name, randomness(own, len(ratio)), z


def letter_counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """How often each byte occurs in all texts."""
    texts = docs.select(F.col(f"`{text_col}`").cast("binary").alias("text"))
    target = arrow_schema("byte long, n long")

    def run(batches: Batches) -> Batches:
        counts = np.zeros(256, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    counts += np.bincount(np.frombuffer(text, np.uint8), minlength=256)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(256)), pa.array(counts)], schema=target
        )

    total = np.zeros(256, np.int64)
    for row in texts.mapInArrow(run, "byte long, n long").groupBy("byte").agg(F.sum("n")).collect():
        total[row[0]] = row[1]
    return total


def _candidates(text: bytes, base: list[tuple[str, int, int]], letters: Letters) -> list[dict]:
    """Tests of the long tokens that touch no base span; offsets in bytes."""
    found = []
    for m in _TOKEN.finditer(text):
        start, end = m.span()
        if any(start < b and a < end for _, a, b in base):
            continue
        tested = letters.tests(m[0])
        if tested:
            name, p, z = tested
            found.append(
                {"start": start, "end": end, "encoding": name, "p": p, "z": z,
                 "band": (end - start).bit_length()}
            )
    return found


def _points(text: bytes) -> Callable[[int], int]:
    """Code points before a byte offset."""
    if text.isascii():
        return lambda at: at
    return lambda at: len(text[:at].decode("utf-8", "replace"))


SCAN = (
    "base array<struct<kind:string,start:long,end:long>>, candidates array<struct<"
    "start:long,end:long,encoding:string,p:double,z:double,band:int>>"
)


def scan(
    docs: DataFrame, letters: Letters, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id, base, candidates`` of each document, offsets in code points."""

    def make() -> Callable[[bytes], dict]:
        def one(text: bytes) -> dict:
            base = base_spans(text)
            points = _points(text)
            return {
                "base": [{"kind": k, "start": points(a), "end": points(b)} for k, a, b in base],
                "candidates": [
                    {**c, "start": points(c["start"]), "end": points(c["end"])}
                    for c in _candidates(text, base, letters)
                ],
            }

        return one

    return annotate(texts_of(docs, id_col, text_col), "text", make, SCAN, ["id"])


def thresholds(scanned: DataFrame, false_rate: float = FALSE_RATE) -> dict[int, float]:
    """The lowest z-score discovered in each band of lengths.

    From a histogram over all candidates, of at most 400 bins in each of some 30 bands.
    """
    z = F.floor(F.least(F.greatest(F.col("c.z"), F.lit(0.0)) * _STEPS, F.lit(float(_BINS - 1))))
    counts = (
        scanned.select(F.explode("candidates").alias("c"))
        .groupBy(F.col("c.band").alias("band"), z.cast("int").alias("bin"))
        .agg(F.count("*").alias("tested"), F.count_if(F.col("c.p") >= NOT_RANDOM).alias("random"))
        .collect()
    )
    bands: dict[int, np.ndarray] = {}
    for row in counts:
        bands.setdefault(row["band"], np.zeros((2, _BINS), np.int64))[:, row["bin"]] = row[2:]
    found = {}
    for band, (tested, random) in bands.items():
        above = np.cumsum(random[::-1])[::-1]
        expected = tested.sum() * np.array([normal_tail(i / _STEPS) for i in range(_BINS)])
        passing = np.flatnonzero((above > 0) & (expected <= false_rate * above))
        if len(passing):
            found[band] = passing[0] / _STEPS
    return found


def discovered(limits: dict[int, float]) -> Column:
    """The candidates that are found to be secrets, as spans of kind ``random``."""
    if not limits:
        return F.filter(F.col("base"), lambda s: F.lit(False))
    limit = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])
    passing = F.filter(
        "candidates", lambda c: (c["p"] >= NOT_RANDOM) & (c["z"] >= limit[c["band"]])
    )
    return F.transform(
        passing,
        lambda c: F.struct(
            F.lit("random").alias("kind"), c["start"].alias("start"), c["end"].alias("end")
        ),
    )


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, base, extra``: spans of the patterns, and those that the tests discover."""
    letters = Letters.of(letter_counts(docs, text_col))
    scanned = written(scan(docs, letters, id_col, text_col), "secrets")
    return scanned.select("id", "base", discovered(thresholds(scanned)).alias("extra"))


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """The documents, all columns, with every secret in their texts replaced by ``[SECRET]``.

    ``length_col`` names an integer column that is kept equal to the text's code points.
    The texts are read again instead of being written with their spans.
    """
    letters = Letters.of(letter_counts(docs, text_col))
    key = docs.columns[0]
    candidates = scan(docs, letters, key, text_col).select("candidates")
    limits = thresholds(written(candidates.where(F.size("candidates") > 0), "secret-candidates"))
    at = docs.columns.index(text_col)
    length_at = docs.columns.index(length_col) if length_col else None

    def clean(text: bytes) -> bytes:
        base = base_spans(text)
        spans = [(a, b) for _, a, b in base] + [
            (c["start"], c["end"])
            for c in _candidates(text, base, letters)
            if c["p"] >= NOT_RANDOM and c["z"] >= limits.get(c["band"], math.inf)
        ]
        kept, end = [], 0
        for a, b in sorted(spans):
            if a >= end:
                kept += [text[end:a], MASK.encode()]
            end = max(end, b)
        return b"".join([*kept, text[end:]]) if spans else text

    def run(batches: Batches) -> Batches:
        for batch in batches:
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            cleaned = [text and clean(text) for text in texts]
            changed = [i for i, (a, b) in enumerate(zip(texts, cleaned)) if a is not b]
            if changed:
                columns = list(batch.columns)
                columns[at] = pa.array(cleaned, pa.binary()).cast(batch.column(at).type)
                if length_at is not None:
                    lengths = columns[length_at].to_pylist()
                    for i in changed:
                        lengths[i] = len(cleaned[i].decode("utf-8", "replace"))
                    columns[length_at] = pa.array(lengths, columns[length_at].type)
                batch = pa.RecordBatch.from_arrays(columns, schema=batch.schema)
            yield batch

    return docs.mapInArrow(run, docs.schema)
