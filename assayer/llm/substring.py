"""Substring dedup on words: Rabin-Karp hashes of every window of words, counted in Spark.

A word is removed if it lies in a window of ``WINDOW`` words that also starts in a document
with a smaller id. The covered words of all such windows are the maximal removal intervals.

Defined results: a null or wordless text keeps nothing and loses nothing; rows with the same
id do not remove each other's words; a null id counts as greater than any other; an empty table
gives an empty one; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .windows import (
    NO_ID,
    Answers,
    Asked,
    Batch,
    answer,
    ask,
    covered,
    distinct,
    mixed,
    ranges_for,
    results,
    rolled,
    seen_before,
    write_batches,
)

WINDOW = 13
#: Windows per byte of text, for the number of ranges only.
_DENSITY = 1 / 6


def _windows(batch: Batch, size: int) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """The documents' words, and the hash and document of every window."""
    import xxhash

    words = [text.split() for text in batch.texts]
    codes: dict[bytes, int] = {w: xxhash.xxh64_intdigest(w) for w in set().union(*words)}
    keys, docs = [], []
    for doc, own in enumerate(words):
        if len(own) >= size:
            found = rolled(np.fromiter(map(codes.__getitem__, own), np.uint64, len(own)), size)
            keys.append(mixed(found))
            docs.append(np.full(len(found), doc, np.int64))
    if not keys:
        return words, np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return words, np.concatenate(keys), np.concatenate(docs)


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    keep_text: bool = True,
) -> DataFrame:
    """``id, n_words, n_removed, removed, kept_sha256`` and the ``kept`` text if asked for.

    ``removed`` has the intervals of removed words; kept words are joined by one space.
    """
    batches = write_batches(docs, id_col, text_col)
    ranges = ranges_for(batches, _DENSITY)

    def question(batch: Batch, _: Answers) -> list[Asked]:
        _, keys, docs = _windows(batch, window)
        found, first, _ = distinct(keys, docs)
        return [(found, first, 0, ranges)]

    def finish(batch: Batch, answers: Answers) -> list[dict]:
        words, keys, docs = _windows(batch, window)
        found, first, place = distinct(keys, docs)
        before = answers.of(found, 0, ranges)[place] | (batch.ids[docs] > batch.ids[first[place]])
        rows, at = [], 0
        for doc, own in enumerate(words):
            n = max(0, len(own) - window + 1)
            gone = covered(before[at : at + n], window) if n else np.zeros(len(own), bool)
            at += n
            edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
            if gone.any():
                own = [w for w, g in zip(own, gone.tolist()) if not g]
            kept = b" ".join(own)
            rows.append(
                {
                    "id": int(batch.ids[doc]),
                    "n_words": len(gone),
                    "n_removed": int(gone.sum()),
                    "removed": [
                        {"start": int(a), "end": int(b)} for a, b in zip(edges[::2], edges[1::2])
                    ],
                    "kept_sha256": hashlib.sha256(kept).hexdigest(),
                    **({"kept": kept.decode("utf-8", "replace")} if keep_text else {}),
                }
            )
        return rows

    schema = (
        "id long, n_words long, n_removed long, removed array<struct<start:long,end:long>>, "
        "kept_sha256 string" + ", kept string" * keep_text
    )
    answers = answer(ask(batches, None, question), lambda _, keys, ids: seen_before(keys, ids))
    found = results(batches, answers, finish, schema)
    return found.withColumn("id", F.nullif("id", F.lit(NO_ID)))
