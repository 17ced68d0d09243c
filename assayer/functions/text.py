"""Text expressions: stripping, prompts, and reading a label out of a completion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .vocabulary import LABELS, PROMPT_HEAD, PROMPT_TAIL, UNSUPPORTED_TOKENS, WHITESPACE


def strip(text: Column) -> Column:
    """Trim all Unicode whitespace, not only blanks as ``F.trim`` does."""
    return F.btrim(text, F.lit(WHITESPACE))


def coalesce_text(*candidates: Column) -> Column:
    """First non-empty candidate, stripped; ``''`` when there is none.

    Null and the empty string fall through to the next candidate. A candidate of
    whitespace only does not: it is chosen and strips to ``''``.
    """
    nonempty = [F.nullif(c.cast("string"), F.lit("")) for c in candidates]
    return strip(F.coalesce(*nonempty, F.lit("")))


def format_prompt(text: Column) -> Column:
    return F.concat(F.lit(PROMPT_HEAD), strip(text), F.lit(PROMPT_TAIL))


def _any_contained(text: Column, needles: tuple[str, ...]) -> Column:
    found = F.contains(text, F.lit(needles[0]))
    for needle in needles[1:]:
        found = found | F.contains(text, F.lit(needle))
    return found


def _single_label(low: Column) -> Column:
    """The label that is the only one among the words of a lower-cased text.

    Mentions the text once: in a filter, or where a text is itself computed, every
    further mention may be evaluated again.
    """
    words = F.split(F.translate(low, WHITESPACE, " " * len(WHITESPACE)), " ")
    present = F.array_intersect(F.array(*map(F.lit, LABELS)), words)
    # Joined, a single label is itself and several are no label.
    labels = F.create_map(*[F.lit(label) for label in LABELS for _ in range(2)])
    return F.try_element_at(labels, F.array_join(present, ""))


def label_words(low: Column) -> Column:
    """First of two steps that parse a lower-cased column: its words between blanks.

    Null for a bare label and for a text without any label, which need no such work.
    """
    words = F.translate(low, WHITESPACE, " " * len(WHITESPACE))
    needed = ~low.isin(*LABELS) & _any_contained(low, LABELS)
    return F.when(needed, F.concat(F.lit(" "), words, F.lit(" ")))


def label_from_words(low: Column, words: Column) -> Column:
    """Second step: the label of a lower-cased text, given its :func:`label_words`.

    With the words in a column of their own this is :func:`parse_prediction` at less
    than half its cost.
    """
    found = [F.contains(words, F.lit(f" {label} ")) for label in LABELS]
    count = sum((hit.cast("int") for hit in found), F.lit(0))
    which = F.when(found[0], LABELS[0]).when(found[1], LABELS[1]).otherwise(LABELS[2])
    return F.when(low.isin(*LABELS), low).when(count == 1, which)


def parse_prediction(raw: Column) -> Column:
    """The one vocabulary label that occurs as a whole word, else null."""
    low = F.lower(raw)
    # Bare labels and texts without any need no splitting.
    return F.when(low.isin(*LABELS), low).when(_any_contained(low, LABELS), _single_label(low))


def parse_or_raw(raw: Column) -> Column:
    """The parsed label, or the stripped completion when none can be parsed."""
    return F.coalesce(parse_prediction(raw), strip(raw))


def has_unsupported_token(low: Column) -> Column:
    """Whether a lower-cased completion contains a token it must not contain."""
    return F.coalesce(_any_contained(low, UNSUPPORTED_TOKENS), F.lit(False))


def unsupported_flag(raw: Column) -> Column:
    """True for completions that are unparseable or carry an unsupported token."""
    # One pattern, to mention the text once; the tokens are plain words.
    token = F.coalesce(F.lower(raw).rlike("|".join(UNSUPPORTED_TOKENS)), F.lit(False))
    return parse_prediction(raw).isNull() | token
