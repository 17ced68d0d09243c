"""Personal data: fixed patterns, and boosted trees over proposed spans.

Generators of high recall propose overlapping spans: numbers in any grouping, addresses
with a written-out at sign, account numbers. Gradient-boosted trees judge each by its
format and its context. They learn from the spans that the fixed patterns confirm
against those that the patterns or their checks refuse, on all of four fifths of the rows; a
threshold per generator is calibrated on all candidates of the other fifth. Equal candidates,
by generator, class and features, are counted and weigh as many. What passes and touches no
confirmed span is added to the spans.

Defined results: a null or empty text has no spans; a repeated row gets its own, equal row;
where no confirmed or no refused candidate exists nothing is learned and nothing added; an
empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .common import annotate, texts_of

KINDS = ("email", "ip", "card", "phone", "obfuscated_email", "number", "account")

# The patterns of the base kinds.
_LOCAL = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(rb"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(rb"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(rb"[0-9](?:[\x20-]?[0-9]){13,}")
_PHONE = re.compile(rb"\+[0-9][\x20().0-9-]+[0-9]")

# What the generators propose.
_AT = re.compile(
    rb"[A-Za-z0-9._%+-]{1,64}(?:@|\x20?(?:\(at\)|\[at\])\x20?|\x20at\x20)[A-Za-z0-9-]{1,63}"
    rb"(?:(?:\.|\x20?(?:\(dot\)|\[dot\])\x20?|\x20dot\x20)[A-Za-z0-9-]{1,63})+"
)
_NUMBER = re.compile(rb"[+(]?[0-9](?:[\x20().+/-]{0,2}[0-9]){6,}")
_ACCOUNT = re.compile(rb"(?<![A-Z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,4})?")
_DIGITS = re.compile(rb"[0-9]+")
_CONTEXTS = tuple(
    re.compile(words, re.IGNORECASE)
    for words in (
        rb"tel|phone|call|fax|mobile|whatsapp",
        rb"card|visa|credit|payment|amex",
        rb"\bip\b|host|server|address",
        rb"mail|contact|write",
        rb"account|iban|ssn|passport|\bid\b",
    )
)
CONTEXT = 40

#: Precision that the calibrated thresholds ask of candidates they have not seen.
PRECISION = 0.98
TREES, DEPTH = 12, 4
_STEPS = 100


def luhn(digits: bytes) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d -= 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _emails(text: bytes) -> list[tuple[int, int]]:
    """Matches of local part, ``@`` and domain, found from each ``@``, in linear time."""
    found, end, at = [], 0, text.find(b"@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            end = m.end()
            found.append((start, end))
        at = text.find(b"@", max(end, at + 1))
    return found


def base_spans(text: bytes) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` in bytes, by start, then by the order of the kinds."""
    spans = [("email", *s) for s in _emails(text)] if b"@" in text else []
    for m in _IP.finditer(text):
        octets = [p.lstrip(b"0") for p in m[0].split(b".")]
        if all(len(p) <= 3 and int(p or b"0") <= 255 for p in octets):
            spans.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = b"".join(_DIGITS.findall(m[0]))
        if len(digits) <= 19 and luhn(digits):
            spans.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 10 <= sum(map(len, _DIGITS.findall(m[0]))) <= 15:
            spans.append(("phone", *m.span()))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


FEATURES = (
    "chars", "digits", "digit_share", "groups", "longest", "shortest", "spaces", "hyphens", "dots",
    "parens", "slashes", "plus", "at", "letters", "luhn", "octets", "distinct", "zero", "before",
    "after", "phone_near", "card_near", "host_near", "mail_near", "account_near",
)


def features(text: bytes, start: int, end: int) -> list[float]:
    own = text[start:end]
    groups = _DIGITS.findall(own)
    digits = b"".join(groups)
    sizes = [len(g) for g in groups] or [0]
    context = text[max(0, start - CONTEXT) : start]
    return [
        float(x)
        for x in (
            len(own),
            len(digits),
            len(digits) / len(own),
            len(groups),
            max(sizes),
            min(sizes),
            own.count(b" "),
            own.count(b"-"),
            own.count(b"."),
            own.count(b"(") + own.count(b")"),
            own.count(b"/"),
            own[:1] == b"+",
            own.count(b"@"),
            sum(chr(c).isalpha() for c in own),
            bool(digits) and luhn(digits),
            len(groups) == 4 and all(s <= 3 and int(g) <= 255 for s, g in zip(sizes, groups)),
            len(set(digits)) / max(1, len(digits)),
            digits[:1] == b"0",
            start > 0 and text[start - 1 : start].isalnum(),
            text[end : end + 1].isalnum(),
            *(bool(c.search(context)) for c in _CONTEXTS),
        )
    ]


def candidates(text: bytes) -> list[tuple[str, int, int]]:
    """Proposed spans, which may overlap each other and the base spans."""
    found = set()
    if b"@" in text or b"at" in text:
        found |= {("obfuscated_email", *m.span()) for m in _AT.finditer(text)}
    if _DIGITS.search(text):
        for pattern in (_NUMBER, _IP, _CARD, _PHONE):
            found |= {("number", *m.span()) for m in pattern.finditer(text)}
        found |= {("account", *m.span()) for m in _ACCOUNT.finditer(text)}
    return sorted(found, key=lambda s: s[1:])


_SPAN = "kind:string,start:long,end:long"
_ADDED = f"base array<struct<{_SPAN}>>, candidates array<struct<{_SPAN},label:int,features:array<double>>>"


def _scanner() -> Callable[[bytes], dict]:
    def scan(text: bytes) -> dict:
        base = base_spans(text)
        confirmed = {(a, b) for _, a, b in base}
        ascii_only = text.isascii()

        def point(at: int) -> int:
            return at if ascii_only else len(text[:at].decode("utf-8", "replace"))

        rows = []
        for kind, a, b in candidates(text):
            touched = [s for s in confirmed if s[0] < b and a < s[1]]
            if (a, b) in confirmed:
                label = 1
            elif touched:
                continue  # part of a confirmed span, or more than it
            else:
                label = 0
            rows.append(
                {"kind": kind, "start": point(a), "end": point(b), "label": label,
                 "features": features(text, a, b)}
            )
        return {
            "base": [{"kind": k, "start": point(a), "end": point(b)} for k, a, b in base],
            "candidates": rows,
        }

    return scan


def labelled(cases: DataFrame) -> DataFrame:
    """``learned, kind, label, features, n``: how many candidates, of rows to learn from or to
    calibrate on, are equal in all that the trees and thresholds see of them."""
    learned = (F.pmod(F.xxhash64("row"), F.lit(5)) != 0).alias("learned")
    return cases.groupBy(learned, "c.kind", "c.label", "c.features").agg(
        F.count("*").cast("double").alias("n")
    )


def _with_vector(cases: DataFrame, features: str) -> DataFrame:
    from pyspark.ml.functions import array_to_vector

    return cases.select("*", array_to_vector(features).alias("vector"))


def _score(scored: DataFrame) -> Column:
    from pyspark.ml.functions import vector_to_array

    return F.floor(F.get(vector_to_array("probability"), 1) * _STEPS).cast("int")


def _limits(held_out: DataFrame) -> dict[str, int]:
    """The lowest score of each generator above which the precision asked for is reached."""
    hits = F.sum(F.col("label") * F.col("n"))
    rows = held_out.groupBy("kind", "score").agg(hits, F.sum("n")).collect()
    by_kind: dict[str, list] = {}
    for kind, score, hits, n in rows:
        by_kind.setdefault(kind, []).append((score, hits, n))
    limits = {}
    for kind, bins in by_kind.items():
        hits = seen = 0
        for score, h, n in sorted(bins, reverse=True):
            hits, seen = hits + h, seen + n
            if hits < PRECISION * seen:
                break
            limits[kind] = score
    return limits


def find_personal_data(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id, base, extra``: spans of the patterns, and those that the trees add."""
    from pyspark.ml.classification import GBTClassifier

    scanned = annotate(texts_of(docs, id_col, text_col), "text", _scanner, _ADDED, ["id"])
    found = written(scanned.withColumn("row", F.monotonically_increasing_id()), "pii")
    empty = F.expr(f"CAST(array() AS array<struct<{_SPAN}>>)")
    cases = found.select("row", F.explode("candidates").alias("c"))
    rows = _with_vector(written(labelled(cases), "pii-labelled"), "features")
    training = rows.where("learned")
    classes, n = training.agg(F.countDistinct("label"), F.count("*")).first()
    if classes < 2:
        return found.select("id", "base", empty.alias("extra"))
    learner = GBTClassifier(
        featuresCol="vector", labelCol="label", weightCol="n", maxIter=TREES, maxDepth=DEPTH,
        # Spark takes split points from all rows while these are at most the square of the bins.
        maxBins=max(32, math.isqrt(n) + 1), seed=42,
    )
    model = learner.fit(training)
    limits = _limits(model.transform(rows.where("not learned")).withColumn("score", _score(rows)))
    if not limits:
        return found.select("id", "base", empty.alias("extra"))
    limit = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])
    scored = model.transform(_with_vector(cases.where(F.col("c.label") != 1), "c.features"))
    extra = (
        scored.where(_score(scored) >= limit[F.col("c.kind")])
        .groupBy("row")
        .agg(F.collect_list(F.struct("c.kind", "c.start", "c.end")).alias("extra"))
    )
    return found.join(extra, "row", "left").select(
        "id", "base", F.coalesce("extra", empty).alias("extra")
    )
