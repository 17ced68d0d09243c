import random

import pytest

COLUMNS = "doc_id long, text string, lang string, id string, kept string, batch int, row int, span string"


@pytest.fixture(scope="session")
def docs(spark):
    """Documents of ``(doc_id, text)`` or ``(doc_id, text, lang)``, with columns whose names
    the operators use inside."""

    def make(rows):
        whole = [(r[0], r[1], r[2] if len(r) > 2 else "en", "x", None, 1, None, "y") for r in rows]
        return spark.createDataFrame(whole, COLUMNS)

    return make


@pytest.fixture(scope="session")
def prose():
    """Random texts of invented words."""

    def make(n, words=60, seed=0, alphabet="abcdeo"):
        rng = random.Random(seed)
        lexicon = ["".join(rng.choices(alphabet, k=rng.randint(1, 7))) for _ in range(300)]
        return [" ".join(rng.choices(lexicon, k=rng.randint(words // 2, words))) for _ in range(n)]

    return make


#: Null, empty, blank, no-word and very long texts, repeated rows, null ids.
EDGES = [
    (1, None),
    (2, ""),
    (3, " \t\n"),
    (4, "one"),
    (4, "one"),
    (5, "é" * 200_000),
    (None, "one"),
    (None, None),
    (6, "word " * 20_000),
    (7, "x\x00y\u2028z \U0001f600"),
]


@pytest.fixture(scope="session")
def edges():
    return EDGES
