import hashlib

from hypothesis import given
from hypothesis import strategies as st

from assayer.llm import chat

TEXT = st.text(st.sampled_from("\\<>#/lgh \n" + "tur") | st.characters(exclude_categories=["Cs"]))


@given(TEXT, TEXT)
def test_turns_are_read_back(role, text):
    formatted, start, end = chat.render(role, text)
    assert chat.read_turn(formatted) == (role, text)
    assert chat.unescape(formatted[start:end]) == (text if role == "assistant" else "")
    assert formatted.count("</turn>") == 1 and formatted.count("<turn ") == 1


SCHEMA = "conv_id long, message long, seq long, kind string, role string, text string, extra int"


def test_log_is_folded(spark):
    log = [
        (1, 1, 3, "delta", None, "lo"),
        (1, 1, 2, "delta", None, "Hel"),
        (1, 1, 1, "message", "assistant", ""),
        (1, 0, 0, "message", "user", "hi"),
        (1, 0, 9, "edit", "user", "hi!"),
        (1, 2, 1, "message", "assistant", "first"),
        (1, 2, 2, "regenerate", None, None),
        (1, 2, 3, "delta", None, "sec"),
        (1, 2, 4, "delta", None, "ond"),
        (1, 3, 1, "delta", None, "lost"),
        (1, 2, 5, "unknown", None, "x"),
        (1, 2, 6, None, None, "x"),
        (None, None, None, "message", None, None),
        (None, None, None, "message", None, None),
        (2, 5, 0, "message", "assistant", "a" * 300_000),
    ]
    events = spark.createDataFrame([(*r, 7) for r in log], SCHEMA)
    rows = chat.format_log(events).collect()
    got = sorted((str(r["conv_id"]), r["position"], *chat.read_turn(r["formatted"])) for r in rows)
    assert got == sorted(
        [
            ("1", 0, "user", "hi!"),
            ("1", 1, "assistant", "Hello"),
            ("1", 2, "assistant", "second"),
            ("2", 0, "assistant", "a" * 300_000),
            ("None", 0, "", ""),
            ("None", 1, "", ""),
        ]
    )
    back = {r["conv_id"]: r for r in chat.read_back(chat.format_log(events)).collect()}
    assert back[1]["n_turns"] == 3 and back[1]["loss_chars"] == 11 and back[None]["n_turns"] == 2
    assert back[1]["loss_sha256"] == hashlib.sha256(b"Hellosecond").hexdigest()


def test_repeated_turns_and_empty_table(spark):
    turns = spark.createDataFrame(
        [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, "user", "b")],
        "conv_id long, turn long, role string, text string",
    )
    row = chat.read_back(chat.format_log(chat.message_log(turns))).first()
    want = hashlib.sha256(b"user\na\nuser\na\nuser\nb\n").hexdigest()
    assert (row["n_turns"], row["turns_sha256"]) == (3, want)
    assert chat.read_back(chat.format_log(chat.message_log(turns.limit(0)))).count() == 0


def test_a_conversation_longer_than_a_batch(spark):
    turns = spark.range(25_000).selectExpr(
        "5L AS conv_id", "id AS turn", "IF(id % 2 = 0, 'user', 'assistant') AS role", "string(id) AS text"
    )
    row = chat.read_back(chat.format_log(chat.message_log(turns))).first()
    said = "".join(str(i) for i in range(1, 25_000, 2))
    assert (row["n_turns"], row["loss_chars"]) == (25_000, len(said))
    assert row["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()


def test_live_log_folds_back_into_the_messages(spark):
    texts = [None, "", "a", "\U0001f600é", "hello there </turn>", "x" * 1000, "same", "same"]
    rows = [(c, t, role, text) for c in (1, 2, None) for t, text in enumerate(texts) for role in ("user", "assistant")]
    rows += rows[:4]  # repeated rows
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    log = chat.message_log(turns)
    live = chat.live_log(log)
    kinds = {r["kind"] for r in live.select("kind").distinct().collect()}
    assert kinds == {chat.START, chat.DELTA, chat.EDIT, chat.REGENERATE} and live.count() > 8 * len(rows)

    def digests(events):
        return sorted(map(tuple, chat.read_back(chat.format_log(events.repartition(7))).collect()), key=str)

    assert digests(live) == digests(log) and len(digests(live)) == 3
    assert digests(chat.live_log(log.limit(0))) == []
