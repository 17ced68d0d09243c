"""Chat formatting: final messages folded from event logs, then rendered with a loss mask.

A log has one row per event: a message starts, a delta adds to its text, an edit replaces
the text, a regeneration empties it for the deltas that follow. Events are dealt out by
conversation, sorted by message and sequence, and folded as a stream, so a task holds one
message at a time, however long the conversation is. Rendered messages keep that order, and
reading them back is a stream as well.

The template marks a turn as ``<turn role>``, a line break, the text, a line break,
``</turn>`` and a line break. Inside roles and texts a backslash, ``<`` and ``#`` become
``\\\\``, ``\\l`` and ``\\h``, and inside roles ``>`` becomes ``\\g``, so no text can imitate a
marker, and reading back restores every character.

Defined results: a null text or role is an empty one; events of a null conversation form one
of their own; null message numbers and sequences come first; events with equal places go by
kind, role and text; two starts of the same message are two messages, so repeated rows are
repeated turns; an event of another kind, or null, is ignored, as is an edit, delta or
regeneration of a message that has not started; an empty log gives no rows; other columns
are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Batches, arrow_schema, in_rows

START, DELTA, EDIT, REGENERATE = "message", "delta", "edit", "regenerate"
ASSISTANT = "assistant"

_ESCAPES = {"\\": "\\\\", "<": "\\l", "#": "\\h", ">": "\\g"}
_BACK = {escaped[1]: plain for plain, escaped in _ESCAPES.items()}
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"<turn ([^>]*)>\n(.*)\n</turn>\n", re.DOTALL)


def escape(text: str, role: bool = False) -> str:
    for plain in "\\<#>" if role else "\\<#":
        text = text.replace(plain, _ESCAPES[plain])
    return text


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: _BACK[m[1]], text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """A turn as formatted, and the part of it that is trained on."""
    head = f"<turn {escape(role, role=True)}>\n"
    body = escape(text)
    trained = len(body) if role == ASSISTANT else 0
    return f"{head}{body}\n</turn>\n", len(head), len(head) + trained


def read_turn(formatted: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    m = _TURN.fullmatch(formatted)
    if not m:
        raise ValueError("not a formatted turn")
    return unescape(m[1]), unescape(m[2])


def message_log(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Whole turns as a log of starts, ``conv_id, message, seq, kind, role, text``."""
    return turns.select(
        F.col(f"`{conv_col}`").cast("long").alias("conv_id"),
        F.col(f"`{turn_col}`").cast("long").alias("message"),
        F.lit(0).cast("long").alias("seq"),
        F.lit(START).alias("kind"),
        F.col(f"`{role_col}`").cast("string").alias("role"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    )


def live_log(log: DataFrame, pieces: int = 8) -> DataFrame:
    """A log of starts as a live chat would have written it, with the same final messages.

    By a hash of the message, its text comes in deltas; or a draft is edited into its first half and
    deltas follow; or a first answer is regenerated. Messages are numbered anew, so that starts
    of the same message stay two; events come in no order.
    """
    own = Window.partitionBy("conv_id").orderBy("message", "seq", "kind", "role", "text")
    text = F.coalesce("text", F.lit(""))
    length = F.length("text")
    each = F.greatest(F.ceil(length / pieces), F.lit(1)).cast("int")

    def event(kind: str, text: Column, role: Column | None = None) -> Column:
        role = F.lit(None).cast("string") if role is None else role
        return F.struct(F.lit(kind).alias("kind"), role.alias("role"), text.alias("text"))

    def deltas(first: int) -> Column:
        places = F.sequence(F.lit(first), F.lit(pieces - 1))
        return F.transform(
            places, lambda i: event(DELTA, F.substring(F.col("text"), i * each + 1, each))
        )

    half = pieces // 2
    nothing, way = F.lit(""), F.pmod(F.xxhash64("conv_id", "message", "text"), F.lit(3))
    streamed = F.concat(F.array(event(START, nothing, F.col("role"))), deltas(0))
    draft = F.concat(F.lit("draft: "), F.reverse("text"))
    edited = F.concat(
        F.array(
            event(START, draft, F.col("role")),
            event(DELTA, F.lit("!")),
            event(EDIT, F.substring(F.col("text"), F.lit(1), half * each)),
        ),
        deltas(half),
    )
    again = F.concat(
        F.array(
            event(START, F.lit("Sorry"), F.col("role")),
            event(DELTA, draft),
            event(REGENERATE, nothing),
        ),
        deltas(0),
    )
    events = F.when(way == 0, streamed).when(way == 1, edited).otherwise(again)
    starts = log.where(F.col("kind") == START).select(
        "conv_id", F.row_number().over(own).cast("long").alias("message"), "role", text.alias("text")
    )
    return starts.select("conv_id", "message", F.posexplode(events).alias("seq", "event")).select(
        "conv_id", "message", F.col("seq").cast("long").alias("seq"), "event.*"
    )


TURNS = "conv_id long, position long, role string, formatted string, loss_start long, loss_end long"


def format_log(events: DataFrame) -> DataFrame:
    """One row per final message, by conversation and in order: ``formatted`` with the part
    of it that is trained on, in code points."""
    target = arrow_schema(TURNS)
    kinds = F.array(*map(F.lit, (START, EDIT, REGENERATE, DELTA)))
    order = F.array_position(kinds, F.col("kind"))
    ordered = (
        events.select("conv_id", "message", "seq", "kind", "role", "text")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "message", "seq", order, "role", "text")
    )

    def messages(batches: Batches) -> Iterator[tuple[int | None, str, list[str]]]:
        now, held = None, None
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for conv, message, _, kind, role, text in zip(*columns):
                if held and (conv, message) != now:
                    yield held
                    held = None
                if kind == START:
                    if held:
                        yield held
                    now, held = (conv, message), (conv, role or "", [text or ""])
                elif held and kind == DELTA:
                    held[2].append(text or "")
                elif held and kind == EDIT:
                    held[2][:] = [text or ""]
                elif held and kind == REGENERATE:
                    held[2].clear()
        if held:
            yield held

    def turns(batches: Batches) -> Iterator[dict]:
        conv, position, begun = None, 0, False
        for own, role, parts in messages(batches):
            position = position + 1 if begun and own == conv else 0
            conv, begun = own, True
            formatted, start, end = render(role, "".join(parts))
            yield {
                "conv_id": conv,
                "position": position,
                "role": role,
                "formatted": formatted,
                "loss_start": start,
                "loss_end": end,
            }

    return ordered.mapInArrow(lambda batches: in_rows(turns(batches), target), TURNS)


DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long"
)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of each conversation, from formatted turns in the order of ``format_log``."""
    target = arrow_schema(DIGESTS)

    def digests(batches: Batches) -> Iterator[dict]:
        row, hashes = None, ()

        def done() -> dict:
            return {
                **row, "turns_sha256": hashes[0].hexdigest(), "loss_sha256": hashes[1].hexdigest()
            }

        for batch in batches:
            table = pa.Table.from_batches([batch])
            names = ("conv_id", "position", "formatted", "loss_start", "loss_end")
            columns = [table[name].to_pylist() for name in names]
            for conv, position, text, start, end in zip(*columns):
                if row is None or position == 0:
                    if row is not None:
                        yield done()
                    row = {"conv_id": conv, "n_turns": 0, "loss_chars": 0, "formatted_chars": 0}
                    hashes = (hashlib.sha256(), hashlib.sha256())
                role, said = read_turn(text)
                trained = unescape(text[start:end])
                hashes[0].update(f"{role}\n{said}\n".encode())
                hashes[1].update(trained.encode())
                row["n_turns"] += 1
                row["loss_chars"] += len(trained)
                row["formatted_chars"] += len(text)
        if row is not None:
            yield done()

    return formatted.mapInArrow(lambda batches: in_rows(digests(batches), target), DIGESTS)
