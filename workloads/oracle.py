"""The SQL counterpart of each query, for DuckDB over the same tables.

Written from the meaning of the operators, row by row: no cells, no thresholds, no
fixed-point sums. Rounding goes through ``printf``, which rounds exact binary values.
"""

from __future__ import annotations

from assayer.functions.vocabulary import (
    LABELS,
    PROMPT_HEAD,
    PROMPT_TAIL,
    UNSUPPORTED_TOKENS,
    WHITESPACE_CODES,
)

WS = "(" + "||".join(f"chr({code})" for code in WHITESPACE_CODES) + ")"
BLANKS = "'" + " " * len(WHITESPACE_CODES) + "'"
VOCABULARY = "[" + ", ".join(f"'{label}'" for label in LABELS) + "]"


def text_literal(text: str) -> str:
    return "'" + text.replace("\n", "'||chr(10)||'") + "'"


def strip(x: str) -> str:
    return f"trim({x}, {WS})"


def parse(x: str) -> str:
    words = f"string_split(translate(lower({x}), {WS}, {BLANKS}), ' ')"
    hits = f"list_filter({VOCABULARY}, lambda l: list_contains({words}, l))"
    return f"CASE WHEN len({hits}) = 1 THEN {hits}[1] END"


def prompt(x: str) -> str:
    return f"{text_literal(PROMPT_HEAD)}||{strip(x)}||{text_literal(PROMPT_TAIL)}"


def normalize(x: str) -> str:
    low = f"lower({strip(x)})"
    return (
        f"CASE WHEN {low} IN ('negative','bearish') THEN 'negative' "
        f"WHEN {low} IN ('neutral','mixed') THEN 'neutral' "
        f"WHEN {low} IN ('positive','bullish') THEN 'positive' END"
    )


def clamp(x: str) -> str:
    return f"CASE WHEN {x} IS NULL OR NOT isfinite({x}) THEN 0.0e0 ELSE greatest(0.0e0, least(1.0e0, {x})) END"


def flagged(parsed: str, raw: str) -> str:
    tokens = " OR ".join(f"contains(lower({raw}), '{t}')" for t in UNSUPPORTED_TOKENS)
    return f"({parsed} IS NULL OR {tokens})"


def round4(x: str) -> str:
    return f"CAST(printf('%.4f', {x}) AS DOUBLE)"


def round2(x: str) -> str:
    return f"CAST(printf('%.2f', {x}) AS DOUBLE)"


REJECTED = "CASE WHEN label = 'negative' THEN 'neutral' ELSE 'negative' END"
LABEL_OF_CODE = "CASE code WHEN 0 THEN 'negative' WHEN 1 THEN 'neutral' ELSE 'positive' END"

LABELED = f"""labeled AS (
  SELECT doc_id, sentence, code, {LABEL_OF_CODE} AS label, lang
  FROM (SELECT doc_id, text AS sentence, lang, quality - toxic + 1 AS code
        FROM documents JOIN labels USING (doc_id)))"""

DIRTY = f"""{LABELED}, spellings AS (
  SELECT *, length(sentence) < 200 AS short,
    CASE lang WHEN 'fr' THEN ' '||upper(label)||chr(9)
      WHEN 'en' THEN CASE code WHEN 0 THEN 'bearish' WHEN 1 THEN 'mixed' ELSE 'bullish' END
      ELSE label END AS spelling
  FROM labeled), dirty AS (
  SELECT CAST(doc_id AS VARCHAR) AS id,
    CASE WHEN lang = 'de' THEN '' WHEN lang = 'fr' THEN NULL WHEN short THEN '  '||chr(9)
      ELSE sentence END AS headline,
    ' '||sentence||chr(10) AS sentence,
    CASE WHEN short AND lang IN ('en', 'es') THEN 'n/a' ELSE spelling END AS spelled,
    CASE WHEN short THEN 'n/a' WHEN lang = 'es' THEN 'unsure' ELSE spelling END AS label
  FROM spellings), kept AS (
  SELECT * FROM (
    SELECT id, spelled, label,
      {strip("coalesce(nullif(headline,''), nullif(sentence,''), '')")} AS text FROM dirty)
  WHERE text <> '')"""

LINES = """lines AS (
  SELECT *, CASE WHEN l_linestatus = 'F' THEN label ELSE 'neutral' END AS word
  FROM (SELECT *, CASE l_returnflag WHEN 'A' THEN 'negative' WHEN 'N' THEN 'neutral'
                  ELSE 'positive' END AS label FROM lineitem)),
predictions AS (
  SELECT *, CASE l_linenumber WHEN 1 THEN word WHEN 2 THEN 'The label is '||word
      WHEN 3 THEN '  '||upper(word)||' ' WHEN 4 THEN word||'.' WHEN 5 THEN 'buy'
      WHEN 6 THEN 'positive negative'
      ELSE CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE word||' sell' END END AS raw,
    (l_quantity - 5) / 40 AS conf, l_extendedprice AS lat
  FROM lines)"""

BASELINE = """baseline AS (
  SELECT label, 'neutral' AS raw, l_quantity / 50 AS conf, l_extendedprice AS lat FROM lines)"""

RUNS = """runs AS (
  SELECT 'base' AS run, label, 'neutral' AS raw, l_quantity / 50 AS conf, lat FROM predictions
  UNION ALL SELECT 'sft', label, raw, conf, lat FROM predictions
  UNION ALL SELECT 'dpo', label, word, 0.6e0 + l_quantity / 200, lat FROM predictions)"""

EVENTS = """event_rows AS (
  SELECT strftime(ts, '%Y-%m-%d') AS day, ts,
    CASE event_type WHEN 'purchase' THEN 'positive' WHEN 'error' THEN 'negative'
      ELSE 'neutral' END AS label,
    CASE WHEN value < 5 THEN 'positive' WHEN value < 20 THEN 'The label is neutral'
      ELSE event_type END AS raw,
    value / 50 AS conf, value AS lat
  FROM events)"""


def scored(source: str, name: str = "scored", keep: str = "") -> str:
    """Rows with parsed prediction, clamped confidence and flag."""
    return f"""{name} AS (
  SELECT *, {flagged("pred", "raw")} AS flag,
    coalesce(pred = gold, false) AS hit
  FROM (SELECT {keep} lower(label) AS gold, coalesce(raw, '') AS raw,
          {parse("coalesce(raw, '')")} AS pred, {clamp("conf")} AS c, lat
        FROM {source}))"""


def exact(x: str) -> str:
    """An order-independent sum of doubles."""
    return f"CAST(sum(CAST({x} AS DECIMAL(28,14))) AS DOUBLE)"


def bin_of(c: str, bins: int) -> str:
    return "(" + "+".join(f"CAST({c} >= {k}/{bins}.0e0 AS BIGINT)" for k in range(1, bins)) + ")"


BRIER = "(" + " + ".join(
    f"pow(CASE WHEN pred = '{label}' THEN c ELSE (1-c)/2 END"
    f" - CASE WHEN gold = '{label}' THEN 1 ELSE 0 END, 2)"
    for label in LABELS
) + ")"


def f1_of(label: str) -> str:
    tp = f"count(*) FILTER (WHERE gold = '{label}' AND pred = '{label}')"
    said = f"count(*) FILTER (WHERE pred = '{label}')"
    true = f"count(*) FILTER (WHERE gold = '{label}')"
    return f"coalesce(2.0e0 * {tp} / nullif({said} + {true}, 0), 0)"


def bundle(source: str, name: str, by: str = "", bins: int = 10) -> str:
    """Unrounded metrics of scored rows, per ``by``."""
    keys, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    match = f"USING ({by})" if by else "ON true"
    binned = f"SELECT {keys} {bin_of('c', bins)} AS bin, hit, c FROM {source}"
    gaps = (
        f"SELECT {keys} CAST(sum(gap) AS DOUBLE) AS gap FROM (SELECT {keys} bin, "
        f"abs(sum(CAST(hit AS INT)) - sum(CAST(c AS DECIMAL(28,14)))) AS gap "
        f"FROM ({binned}) GROUP BY {keys} bin) {group}"
    )
    return f"""{name} AS (
  SELECT {keys} examples, accuracy, macro_f1, gap / examples AS expected_calibration_error,
    brier / examples AS brier_score, invalid_label_rate, hallucination_proxy_rate,
    lat / examples AS mean_latency_ms, unknown_gold
  FROM (SELECT {keys} count(*) AS examples, count(*) FILTER (WHERE hit) / CAST(count(*) AS DOUBLE) AS accuracy,
      ({" + ".join(f1_of(label) for label in LABELS)}) / 3 AS macro_f1,
      {exact(BRIER)} AS brier,
      count(*) FILTER (WHERE pred IS NULL) / CAST(count(*) AS DOUBLE) AS invalid_label_rate,
      count(*) FILTER (WHERE flag) / CAST(count(*) AS DOUBLE) AS hallucination_proxy_rate,
      {exact("lat")} AS lat,
      count(*) FILTER (WHERE NOT list_contains({VOCABULARY}, gold)) AS unknown_gold
    FROM {source} {group})
  JOIN ({gaps}) {match})"""


METRICS4 = ("accuracy", "macro_f1", "expected_calibration_error", "brier_score",
            "invalid_label_rate", "hallucination_proxy_rate")
ROUNDED = ", ".join(f"{round4(m)} AS {m}" for m in METRICS4) + (
    f", {round2('mean_latency_ms')} AS mean_latency_ms"
)


def lifted(accuracy: str, base: str) -> str:
    a, b = round4(accuracy), round4(base)
    lift = f"CASE WHEN {b} = 0 THEN 0 ELSE ({a} - {b}) / {b} END"
    return (
        f"{b} AS baseline_accuracy, {round4(lift)} AS relative_accuracy_lift, "
        f"round(CASE WHEN {base} = 0 THEN 0 ELSE ({accuracy} - {base}) / {base} END, 9) AS exact_accuracy_lift"
    )


EVALUATED = f"{LINES}, {scored('predictions')}"
COMPARED_RUNS = (
    f"{LINES}, {RUNS}, {scored('runs', keep='run,')}, {bundle('scored', 'm', 'run')}, compared AS ("
    f"SELECT run, examples, {ROUNDED}, unknown_gold, {lifted('accuracy', 'base')} "
    f"FROM m, (SELECT accuracy AS base FROM m WHERE run = 'base') b)"
)


def metric(name: str, bins: int = 10) -> str:
    return (
        f"WITH {EVALUATED}, {bundle('scored', 'm', bins=bins)} "
        f"SELECT round({name}, 9) AS {name} FROM m"
    )


def split(source: str, condition: str, seed: int = 7) -> str:
    return f"""SELECT id, o_orderpriority FROM (
  SELECT id, o_orderpriority, count(*) OVER () AS n,
    row_number() OVER (ORDER BY md5('{seed}:'||id), id) AS k
  FROM (SELECT o_orderkey AS id, o_orderpriority FROM {source})) WHERE {condition}"""


DATASET = f"""WITH {LABELED}, numbered AS (
  SELECT 'fpb-'||(row_number() OVER (ORDER BY doc_id) - 1) AS id, label,
    {strip("CASE WHEN length(sentence) < 200 THEN ' '||chr(9) ELSE sentence END")} AS text
  FROM labeled), ranked AS (
  SELECT id, text, label, count(*) OVER () AS n,
    row_number() OVER (ORDER BY md5('7:'||id), id) AS k
  FROM numbered WHERE text <> '')"""
TRAIN_SIZE = "CAST(floor(n * (1.0e0 - 0.2e0)) AS BIGINT)"

REQUESTS = """requests AS (
  SELECT conv_id, turn AS position,
    CASE WHEN role = 'system' THEN '' ELSE replace(text, 'the', 'profit') END AS text
  FROM conversations)"""
RULE = "CASE WHEN contains(lower(text), 'profit') THEN 'positive' ELSE 'negative' END"
RULE_TEXTS = f"""{LABELED}, rule_texts AS (
  SELECT CAST(doc_id AS VARCHAR) AS id, replace(sentence, 'the', 'profit') AS text, label
  FROM labeled)"""

TURNS = """turns AS (
  SELECT conv_id||'-'||turn AS id, replace(text, 'the', 'profit') AS text,
    CASE WHEN role = 'user' THEN 'positive' ELSE 'neutral' END AS label
  FROM conversations)"""

LINE_BATCHES = """line_batches AS (
  SELECT doc_id, CASE WHEN contains(text, chr(10)) THEN string_split(text, chr(10)) ELSE [] END AS lines
  FROM documents)"""

GRID = """SELECT p_partkey, printf('ablation-%03d', m.i * 36 + l.i * 9 + r.i * 3 + x.i + 1) AS run_id,
  CASE m.i WHEN 0 THEN p_brand ELSE p_type END AS model,
  l.v AS learning_rate, CAST(r.v AS INTEGER) AS lora_rank, x.v AS data_mixture
FROM part, (VALUES (0), (1)) m(i),
  (VALUES (0, 0.00005e0), (1, 0.0001e0), (2, 0.0002e0), (3, 0.0003e0)) l(i, v),
  (VALUES (0, 8), (1, 16), (2, 32)) r(i, v),
  (VALUES (0, 'flue_100'), (1, 'flue_80_openorca_20'), (2, 'flue_60_openorca_40')) x(i, v)"""

PARAMS = """SELECT event_type AS experiment, 'run-'||event_id AS run_id, 'model.props.k' AS key,
  json_extract_string(props, '$.k') AS value FROM events
UNION ALL SELECT event_type, 'run-'||event_id, 'model.kind', event_type FROM events
UNION ALL SELECT event_type, 'run-'||event_id, 'user', CAST(user_id AS VARCHAR) FROM events"""
SCALARS = """SELECT event_type AS experiment, 'run-'||event_id AS run_id, 'value' AS key, value FROM events
UNION ALL SELECT event_type, 'run-'||event_id, 'user_id', CAST(user_id AS DOUBLE) FROM events
UNION ALL SELECT event_type, 'run-'||event_id, 'large', CASE WHEN value > 20 THEN 1.0e0 ELSE 0.0e0 END FROM events"""


# A stream appends the days that ended before its watermark.
CLOSED = "date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)"


def daily(condition: str) -> str:
    rows = f"(SELECT * FROM event_rows WHERE {condition})"
    return (
        f"WITH {EVENTS}, {scored(rows, keep='day,')}, {bundle('scored', 'm', 'day')} "
        f"SELECT day, examples, {ROUNDED} FROM m"
    )


def quantile_ranks(period: str) -> str:
    """What a quantile is: at most its share of the rows lie below it, and its share up to it."""
    names = {0.5: "p50", 0.95: "p95", 0.99: "p99"}
    quantiles = ", ".join(f"quantile_disc(value, {rank}) AS {name}" for rank, name in names.items())
    checks = ", ".join(
        f"count(*) FILTER (value < {name}) <= {rank}e0 * count(*) "
        f"AND {rank}e0 * count(*) <= count(*) FILTER (value <= {name}) AS {name}_latency_ms"
        for rank, name in names.items()
    )
    return f"""WITH e AS (SELECT strftime(date_trunc('{period}', ts), '%Y-%m-%d') AS period, value FROM events),
q AS (SELECT period, {quantiles} FROM e GROUP BY period)
SELECT period, count(*) AS n, {checks} FROM e JOIN q USING (period) GROUP BY period"""


def drift(condition: str) -> str:
    classes = {label: f"pred = '{label}'" for label in LABELS} | {"invalid": "pred IS NULL"}
    events = EVENTS.replace("AS day, ts,", "AS day, ts, user_id % 3 AS segment,")
    rows = f"(SELECT * FROM event_rows WHERE {condition})"
    counts = ", ".join(f"count(*) FILTER ({is_class}) AS n_{c}" for c, is_class in classes.items())
    reference = ", ".join(
        f"sum(CASE WHEN place <= 7 THEN n_{c} END) OVER (PARTITION BY segment) AS r_{c}" for c in classes
    )
    every = " + ".join(f"r_{c}" for c in classes)
    index = " + ".join(
        f"((n_{c} + 0.5e0) / (examples + 2) - (r_{c} + 0.5e0) / ({every} + 2)) * "
        f"ln(((n_{c} + 0.5e0) / (examples + 2)) / ((r_{c} + 0.5e0) / ({every} + 2)))"
        for c in classes
    )
    so_far = "(PARTITION BY segment ORDER BY day ROWS UNBOUNDED PRECEDING)"
    return f"""WITH {events}, {scored(rows, keep="day, segment,")},
days AS (SELECT segment, day, count(*) AS examples, {counts}, avg(c) AS x FROM scored GROUP BY segment, day),
placed AS (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY day) AS place,
  avg(x) OVER {so_far} AS mean FROM days),
summed AS (SELECT *, {reference}, sum(x - mean - 0.005e0) OVER {so_far} AS up,
  sum(x - mean + 0.005e0) OVER {so_far} AS down FROM placed),
measured AS (SELECT *, CASE WHEN place > 7 THEN {index} END AS psi,
  up - min(up) OVER {so_far} AS rise, max(down) OVER {so_far} - down AS fall FROM summed)
SELECT segment, day, examples, {", ".join(f"n_{c}" for c in classes)},
  round(x, 9) AS mean_confidence, round(psi, 9) AS stability_index, round(rise, 9) AS rise,
  round(fall, 9) AS fall, coalesce(psi > 0.2, false) AS shifted,
  greatest(rise, fall) > 0.05 AS drifting, false AS silent FROM measured"""


def lexical(cues: list[str]) -> str:
    listed = ", ".join(f"'{c}'" for c in cues)
    return f"CAST(len(list_filter(words, lambda w: list_contains([{listed}], w))) AS BIGINT)"


def log_units(x: str) -> str:
    return f"CAST(round_even(1e6 * ln({x}), 0) AS BIGINT)"


def _bayes() -> str:
    """Tables of naive Bayes: its training rows, word counts, weights and scored test rows."""
    counts = ", ".join(
        f"count(*) FILTER (label = '{label}') AS n_{i}" for i, label in enumerate(LABELS)
    )
    sums = ", ".join(f"sum(n_{i}) AS t_{i}" for i in range(len(LABELS)))
    weights = ", ".join(
        f"{log_units(f'(n_{i} + 1.0e0) / (t_{i} + v * 1.0e0)')} AS w_{i}" for i in range(len(LABELS))
    )
    priors = ", ".join(
        f"{log_units(f'(n_{i} + 1.0e0) / (n_0 + n_1 + n_2 + 3.0e0)')} AS p_{i}"
        for i in range(len(LABELS))
    )
    scores = ", ".join(
        f"any_value(p_{i}) + coalesce(sum(w_{i}), 0) AS s_{i}" for i in range(len(LABELS))
    )
    total = " + ".join(
        f"exp(CAST(s_{i} - greatest(s_0, s_1, s_2) AS DOUBLE) / 1e6)" for i in range(len(LABELS))
    )
    return f"""{LABELED}, halves AS (
  SELECT id, label, k > {TRAIN_SIZE} AS test,
    list_filter(regexp_split_to_array(lower(sentence), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '') AS ws
  FROM (SELECT CAST(doc_id AS VARCHAR) AS id, sentence, label, count(*) OVER () AS n,
      row_number() OVER (ORDER BY md5('7:'||doc_id)) AS k FROM labeled)),
priors AS (SELECT {priors} FROM (SELECT {counts} FROM halves WHERE NOT test)),
word_counts AS (SELECT word, {counts} FROM (
  SELECT label, unnest(ws) AS word FROM halves WHERE NOT test) GROUP BY word),
totals AS (SELECT count(*) AS v, {sums} FROM word_counts),
weights AS (SELECT word, (n_0 + n_1 + n_2) * 4096 >= t_0 + t_1 + t_2 AS common, {weights}
  FROM word_counts, totals),
classified AS (
  SELECT id, label, CASE WHEN s_0 >= s_1 AND s_0 >= s_2 THEN '{LABELS[0]}'
      WHEN s_1 >= s_2 THEN '{LABELS[1]}' ELSE '{LABELS[2]}' END AS prediction,
    1.0e0 / ({total}) AS confidence
  FROM (SELECT id, any_value(label) AS label, {scores}
    FROM (SELECT id, label, unnest(CASE WHEN len(ws) = 0 THEN [''] ELSE ws END) AS word
      FROM halves WHERE test) LEFT JOIN weights USING (word), priors GROUP BY id))"""


BAYES = _bayes()


ORACLE: dict[str, str] = {
    "classifier_predictions": f"""WITH {BAYES}
SELECT id, label, prediction, round(confidence, 9) AS confidence, 0.0e0 AS latency_ms FROM classified""",
    "classifier_word_weights": f"""WITH {BAYES}
SELECT word, common, w_0 AS {LABELS[0]}, w_1 AS {LABELS[1]}, w_2 AS {LABELS[2]} FROM weights""",
    "classifier_lift": f"""WITH {BAYES}, guesses AS (
  SELECT label, prediction AS raw, confidence AS conf, 0.0e0 AS lat FROM classified),
constant AS (SELECT label, 'neutral' AS raw, conf, lat FROM guesses),
{scored("guesses")}, {scored("constant", "scored_base")},
{bundle("scored", "m")}, {bundle("scored_base", "b")}
SELECT examples, {ROUNDED}, {lifted("accuracy", "base")}, unknown_gold
FROM m, (SELECT accuracy AS base FROM b) b""",
    "parse_predictions": f"""WITH {LINES}
SELECT l_orderkey, l_linenumber, raw, {parse("raw")} AS parsed FROM predictions""",
    "parse_or_raw": f"""WITH {LINES}
SELECT l_orderkey, l_linenumber, coalesce({parse("raw")}, {strip("raw")}) AS stored FROM predictions""",
    "parse_long_texts": f"""SELECT doc_id, {parse("text||' NEUTRAL'||chr(10)")} AS parsed,
  length({strip("chr(12288)||text||chr(28)")}) AS kept FROM documents""",
    "unsupported_flags": f"""WITH {LINES}
SELECT prediction, flagged, count(*) AS n FROM (
  SELECT raw AS prediction, {flagged(f"({parse('raw')})", "coalesce(raw, '')")} AS flagged
  FROM predictions) GROUP BY ALL""",
    "coalesced_texts": f"WITH {DIRTY} SELECT id, text FROM kept",
    "normalized_labels": f"WITH {DIRTY} SELECT id, label, {normalize('label')} AS normalized FROM dirty",
    "label_codes": """SELECT doc_id,
  CASE quality - toxic + 1 WHEN 0 THEN 'negative' WHEN 1 THEN 'neutral' WHEN 2 THEN 'positive' END AS label,
  CASE quality * 4 - toxic WHEN 0 THEN 'negative' WHEN 1 THEN 'neutral' WHEN 2 THEN 'positive' END AS wild
FROM labels""",
    "accepted_labels": f"""WITH {DIRTY} SELECT id, text, label FROM (
  SELECT id, text, {normalize("label")} AS label FROM kept) WHERE label IS NOT NULL""",
    "quarantined_labels": f"""WITH {DIRTY}
SELECT id, text, label FROM kept WHERE ({normalize("label")}) IS NULL""",
    "prompts": f"SELECT CAST(doc_id AS VARCHAR) AS id, {prompt('text')} AS prompt FROM documents",
    "rejected_labels": f"WITH {LABELED} SELECT doc_id, label, {REJECTED} AS rejected FROM labeled",
    "sft_records": f"""WITH {DIRTY} SELECT id, prompt, label AS response, prompt||' '||label AS text, label
FROM (SELECT id, {prompt("text")} AS prompt, {normalize("spelled")} AS label FROM kept)""",
    "preference_pairs": f"""WITH {DIRTY} SELECT id, prompt, label AS chosen, {REJECTED} AS rejected
FROM (SELECT id, {prompt("text")} AS prompt, {normalize("spelled")} AS label FROM kept)""",
    "numbered_records": """SELECT o_orderkey, o_totalprice,
  'fpb-'||(row_number() OVER (ORDER BY o_orderkey) - 1) AS id FROM orders""",
    "numbered_source_rows": """SELECT 'fpb-'||(row_number() OVER (ORDER BY doc_id) - 1) AS id,
  text, lang FROM documents""",
    "filled_ids": """SELECT conv_id, turn, CASE WHEN role = 'user' THEN 'u-'||conv_id||'-'||turn
  ELSE 'ex-'||(row_number() OVER (ORDER BY conv_id, turn) - 1) END AS id FROM conversations""",
    "clamped_confidences": f"""WITH {LINES} SELECT round(conf, 9) AS confidence,
  round({clamp("conf")}, 9) AS clamped, count(*) AS n FROM predictions GROUP BY ALL""",
    "evaluation_inputs": f"""WITH {LINES}, {scored("predictions", keep="l_orderkey, l_linenumber,")}
SELECT l_orderkey, l_linenumber, gold AS label, pred AS prediction, round(c, 9) AS confidence,
  lat AS latency_ms, flag AS flagged FROM scored""",
    "token_sequence_confidence": """WITH steps AS (
  SELECT vec_id // 5 AS seq_id, label, embedding,
    CAST(list_max(embedding) AS DOUBLE) AS top FROM embeddings), p AS (
  SELECT seq_id, exp(CAST(embedding[label + 1] AS DOUBLE) - top)
    / list_sum(list_transform(embedding, lambda s: exp(CAST(s AS DOUBLE) - top))) AS p FROM steps)
SELECT seq_id, round(avg(p), 9) AS confidence, count(*) AS steps FROM p GROUP BY seq_id""",
    "nested_sequence_confidence": f"""WITH steps AS (
  SELECT vec_id, label, embedding[i * 16 + 1 : i * 16 + 16] AS s FROM embeddings, range(4) r(i)), p AS (
  SELECT vec_id, CASE WHEN label < 16 THEN exp(CAST(s[label + 1] AS DOUBLE) - CAST(list_max(s) AS DOUBLE))
    / list_sum(list_transform(s, lambda v: exp(CAST(v AS DOUBLE) - CAST(list_max(s) AS DOUBLE)))) END AS p
  FROM steps)
SELECT vec_id, {round4("avg(p)")} AS confidence FROM p GROUP BY vec_id""",
    "brier_terms": f"""WITH {LINES}, {scored("(SELECT *, raw AS original FROM predictions)", keep="original,")}
SELECT gold AS label, original AS prediction, round({BRIER}, 9) AS term, count(*) AS n FROM scored GROUP BY ALL""",
    "rounded_metrics": f"""SELECT l_orderkey, l_linenumber,
  {round4("l_extendedprice * l_discount / 64 / 1024")} AS four,
  {round2("l_extendedprice * l_discount / 64")} AS two FROM lineitem""",
    "valid_requests": f"WITH {REQUESTS} SELECT * FROM requests WHERE length(text) >= 1",
    "invalid_requests": f"WITH {REQUESTS} SELECT * FROM requests WHERE coalesce(length(text), 0) < 1",
    "valid_batches": f"""WITH {LINE_BATCHES}
SELECT doc_id, CAST(len(lines) AS BIGINT) AS size, len(lines) >= 1 AS valid FROM line_batches""",
    "scored_batch_texts": f"""WITH {LINE_BATCHES}, texts AS (
  SELECT doc_id, unnest(lines) AS text FROM line_batches)
SELECT doc_id, {RULE} AS label, count(*) AS n FROM texts GROUP BY ALL""",
    "batch_envelopes": f"""WITH {REQUESTS}, answers AS (
  SELECT conv_id, position, {RULE} AS label FROM requests WHERE length(text) >= 1)
SELECT conv_id, CAST(0 AS BIGINT) AS page, count(*) AS count,
  '['||string_agg('{{"label":"'||label||'","raw":"'||label||'","confidence":0.9,"latency_ms":1.0,'
    ||'"backend":"fake","model":"fake-model"}}', ',' ORDER BY position)||']' AS predictions
FROM answers GROUP BY conv_id""",
    "evaluation_cells": f"""WITH {EVALUATED} SELECT gold AS label, pred AS prediction,
  {bin_of("c", 10)} AS bin, count(*) AS n, count(*) FILTER (WHERE flag) AS flagged,
  round({exact("c")}, 9) AS confidence_sum, round({exact("lat")}, 2) AS latency_sum
FROM scored GROUP BY ALL""",
    # The large values and their opposites leave nothing, in an exact sum.
    "exact_price_sums": """SELECT l_returnflag,
  round(CAST(sum(CAST(l_tax AS DECIMAL(28,14))) AS DOUBLE), 6) AS total FROM lineitem GROUP BY ALL""",
    "example_count": f"WITH {EVALUATED} SELECT count(*) AS examples FROM scored",
    "accuracy": metric("accuracy"),
    "macro_f1": metric("macro_f1"),
    "class_scores": f"""WITH {EVALUATED}, counts AS (
  SELECT label, count(*) FILTER (WHERE gold = label AND pred = label) AS tp,
    count(*) FILTER (WHERE pred = label) AS said, count(*) FILTER (WHERE gold = label) AS truth
  FROM scored, (SELECT unnest({VOCABULARY}) AS label) GROUP BY label)
SELECT label, tp AS true_positive, said - tp AS false_positive, truth - tp AS false_negative,
  round(coalesce(tp / CAST(nullif(said, 0) AS DOUBLE), 0), 9) AS precision,
  round(coalesce(tp / CAST(nullif(truth, 0) AS DOUBLE), 0), 9) AS recall,
  round(coalesce(2.0e0 * tp / nullif(said + truth, 0), 0), 9) AS f1 FROM counts""",
    "expected_calibration_error": metric("expected_calibration_error"),
    "calibration_error_fifteen_bins": metric("expected_calibration_error", 15),
    "calibration_bins": f"""WITH {EVALUATED} SELECT {bin_of("c", 10)} AS bin, count(*) AS n,
  round(avg(CAST(hit AS INT)), 9) AS accuracy, round({exact("c")} / count(*), 9) AS confidence
FROM scored GROUP BY bin""",
    "brier_score": metric("brier_score"),
    "confusion_matrix": f"""WITH {EVALUATED}, v AS (SELECT unnest({VOCABULARY}) AS l)
SELECT g.l AS label, p.l AS prediction, count(gold) AS n FROM v g CROSS JOIN v p
LEFT JOIN scored ON gold = g.l AND pred = p.l GROUP BY ALL""",
    "label_distribution": f"""WITH {DIRTY}
SELECT lower(spelled) AS label, count(*) AS n FROM dirty GROUP BY ALL""",
    "report_of_spellings": f"""WITH {DIRTY} SELECT count(*) AS examples,
  count(*) FILTER (WHERE coalesce(lower(spelled), 'none') NOT IN ({", ".join(f"'{g}'" for g in LABELS)})) AS unknown_gold,
  {", ".join(f"count(*) FILTER (WHERE lower(spelled) = '{g}') AS gold_{g}" for g in LABELS)} FROM dirty""",
    "rates_and_latency": f"""WITH {EVALUATED}, {bundle("scored", "m")}
SELECT round(invalid_label_rate, 9) AS invalid_label_rate,
  round(hallucination_proxy_rate, 9) AS hallucination_proxy_rate,
  round(mean_latency_ms, 9) AS mean_latency_ms FROM m""",
    "evaluation_bundle": f"""WITH {EVALUATED}, {bundle("scored", "m")}
SELECT examples, {ROUNDED}, unknown_gold FROM m""",
    "baseline_comparison": f"""WITH {EVALUATED}, {BASELINE}, {scored("baseline", "scored_base")},
{bundle("scored", "m")}, {bundle("scored_base", "b")}
SELECT examples, {ROUNDED}, unknown_gold, {lifted("accuracy", "base")}
FROM m, (SELECT accuracy AS base FROM b) b""",
    "run_comparison": f"WITH {COMPARED_RUNS} SELECT * FROM compared",
    "supplier_comparison": f"""WITH {LINES}, suppliers AS (
  SELECT 'supplier-'||l_suppkey AS run, label, raw, conf, lat FROM predictions),
{scored("suppliers", keep="run,")}, {bundle("scored", "m", "run")}
SELECT * EXCLUDE (exact_accuracy_lift) FROM (
  SELECT run, examples, {ROUNDED}, {lifted("accuracy", "base")}
  FROM m, (SELECT accuracy AS base FROM m WHERE run = 'supplier-1') b)""",
    "run_confusions": f"""WITH {LINES}, {RUNS}, {scored("runs", keep="run,")},
v AS (SELECT unnest({VOCABULARY}) AS l), r AS (SELECT DISTINCT run FROM runs)
SELECT r.run, g.l AS label, p.l AS prediction, count(gold) AS n
FROM r CROSS JOIN v g CROSS JOIN v p
LEFT JOIN scored s ON s.run = r.run AND gold = g.l AND pred = p.l GROUP BY ALL""",
    "acceptance_gates": f"""WITH {COMPARED_RUNS}
SELECT min(relative_accuracy_lift) FILTER (WHERE run IN ('sft', 'dpo')) >= 0.2 AS lift_reached,
  max(invalid_label_rate) FILTER (WHERE run IN ('sft', 'dpo')) = 0 AS format_valid,
  max(expected_calibration_error) FILTER (WHERE run = 'dpo')
    < max(expected_calibration_error) FILTER (WHERE run = 'sft') AS calibration_improved,
  count(*) >= 50 AS enough_runs FROM compared""",
    "failure_examples": f"""WITH {LINES}, {scored(
        "(SELECT *, raw AS original FROM predictions)", keep="l_orderkey, l_linenumber, label, original,")}
SELECT l_orderkey, l_linenumber, label, original AS prediction, pred IS NULL AS invalid
FROM scored WHERE flag""",
    "dominant_confusions": f"""WITH {LINES}, {scored("predictions", keep="l_linenumber,")},
v AS (SELECT unnest({VOCABULARY}) AS l), r AS (SELECT DISTINCT l_linenumber FROM lineitem), counts AS (
SELECT r.l_linenumber, g.l AS label, p.l AS prediction, count(gold) AS n
FROM r CROSS JOIN v g CROSS JOIN v p
LEFT JOIN scored s ON s.l_linenumber = r.l_linenumber AND gold = g.l AND pred = p.l
WHERE g.l <> p.l GROUP BY ALL)
SELECT * FROM (SELECT *, row_number() OVER (
    PARTITION BY l_linenumber ORDER BY n DESC, label, prediction) AS rank FROM counts)
WHERE rank <= 2""",
    "seeded_permutation": """SELECT o_orderkey AS id,
  row_number() OVER (ORDER BY md5('7:'||o_orderkey), o_orderkey) - 1 AS position FROM orders""",
    "train_split": split("orders", f"k <= {TRAIN_SIZE}"),
    "test_split": split("orders", "k > CAST(floor(n * (1.0e0 - 0.37e0)) AS BIGINT)", 11),
    "capped_train_split": split("orders", f"k <= least(2000, {TRAIN_SIZE})"),
    "first_rows": "SELECT o_orderkey AS id, o_orderpriority FROM orders ORDER BY o_orderkey LIMIT 1234",
    "first_sft_records": f"""WITH {LABELED}, firsts AS (
  SELECT * FROM labeled ORDER BY doc_id LIMIT 200)
SELECT CAST(doc_id AS VARCHAR) AS id, {prompt("sentence")} AS prompt, label AS response,
  {prompt("sentence")}||' '||label AS text, label FROM firsts""",
    "dataset_train": f"{DATASET} SELECT id, text, label FROM ranked WHERE k <= {TRAIN_SIZE}",
    "dataset_train_capped": f"{DATASET} SELECT id, text, label FROM ranked WHERE k <= least(250, {TRAIN_SIZE})",
    "dataset_test": f"{DATASET} SELECT id, text, label FROM ranked WHERE k > {TRAIN_SIZE}",
    "dataset_preferences": f"""{DATASET} SELECT id, {prompt("text")} AS prompt, label AS chosen,
  {REJECTED} AS rejected FROM ranked WHERE k <= {TRAIN_SIZE}""",
    "scored_records": f"""WITH {RULE_TEXTS} SELECT id, label, {RULE} AS prediction,
  0.9e0 AS confidence, true AS latency_ms FROM rule_texts""",
    "rule_predictions": f"""WITH rule_texts AS (
  SELECT CAST(doc_id AS VARCHAR) AS id, replace(text, 'the', 'profit') AS text FROM documents) SELECT id, {RULE} AS label, {RULE} AS raw,
  0.9e0 AS confidence, 1.0e0 AS latency_ms, 'fake' AS backend, 'fake-model' AS model FROM rule_texts""",
    "external_baseline": f"""WITH {LINES} SELECT CAST(l_orderkey AS VARCHAR) AS id, upper(label) AS label,
  coalesce({parse("raw")}, {strip("coalesce(raw, '')")}) AS prediction, 1.0e0 AS confidence,
  lat AS latency_ms FROM predictions""",
    "lexical_baseline": f"""WITH {LABELED}, texts AS (
  SELECT doc_id, label, regexp_split_to_array(lower(sentence), '[^\\p{{L}}\\p{{N}}]+') AS words FROM labeled),
cues AS (SELECT doc_id, label, {lexical(["the", "der", "el"])} AS neg, {lexical(["of", "und", "la"])} AS pos
  FROM texts)
SELECT CAST(doc_id AS VARCHAR) AS id, label,
  CASE WHEN neg > pos THEN 'negative' WHEN pos > neg THEN 'positive' ELSE 'neutral' END AS prediction,
  CASE WHEN neg + pos = 0 THEN 1.0e0 ELSE round(greatest(neg, pos) / CAST(neg + pos AS DOUBLE), 9) END
    AS confidence, 0.0e0 AS latency_ms FROM cues""",
    "jsonl_round_trip": """SELECT CAST(doc_id AS VARCHAR) AS id, text,
  CASE WHEN lang <> 'es' THEN CASE quality - toxic + 1 WHEN 0 THEN 'negative' WHEN 1 THEN 'neutral'
    WHEN 2 THEN 'positive' END END AS label FROM documents LEFT JOIN labels USING (doc_id)""",
    "batch_headers": "SELECT conv_id, count(*) AS count FROM conversations GROUP BY conv_id",
    "paged_envelopes": """SELECT conv_id, CAST(turn // 3 AS BIGINT) AS page, any_value(c) AS count,
  count(*) AS size FROM (SELECT conv_id, turn, count(*) OVER (PARTITION BY conv_id) AS c
  FROM conversations) GROUP BY conv_id, turn // 3""",
    "weighted_mixture": """SELECT id, o_orderpriority FROM (SELECT o_orderkey AS id, o_orderpriority,
  row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5('7:'||o_orderkey)) AS k FROM orders)
WHERE k <= CASE o_orderpriority WHEN '1-URGENT' THEN 251 WHEN '2-HIGH' THEN 150 WHEN '5-LOW' THEN 100 ELSE 0 END""",
    "balanced_sample": """SELECT id, o_orderpriority FROM (SELECT o_orderkey AS id, o_orderpriority,
  row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5('7:'||o_orderkey)) AS k FROM orders)
WHERE k <= (SELECT min(c) FROM (SELECT count(*) AS c FROM orders GROUP BY o_orderpriority))""",
    **{name: f"""SELECT key, count(*) AS n FROM (
  SELECT CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey // 5 END AS key FROM orders
  ORDER BY key ASC NULLS FIRST LIMIT {n}) GROUP BY key"""
       for name, n in (("first_rows_with_missing_keys", 1100), ("few_rows_with_missing_keys", 3))},
    "classifier_test_rows": f"""WITH {LABELED}, ranked AS (SELECT CAST(doc_id AS VARCHAR) AS id, label,
  count(*) OVER () AS n, row_number() OVER (ORDER BY md5('7:'||doc_id)) AS k FROM labeled)
SELECT id, label, true AS known, true AS in_range FROM ranked WHERE k > {TRAIN_SIZE}""",
    "flattened_maps": """SELECT p_partkey, unnest(['spec.names.brand', 'spec.names.type', 'spec.in.size', 'deep.a.b'])
  AS key, unnest([p_brand, p_type, CAST(p_size AS VARCHAR), CAST(p_size AS VARCHAR)]) AS value FROM part""",
    "labeled_by_code": f"""WITH {LABELED} SELECT CAST(doc_id AS VARCHAR) AS id, label AS chosen,
  {REJECTED} AS rejected FROM labeled""",
    "scored_by_code": f"""WITH {RULE_TEXTS} SELECT id, label, {RULE} AS prediction, 0.9e0 AS confidence
FROM rule_texts""",
    "rounded_large_metrics": """SELECT l_orderkey, l_linenumber,
  CAST(round_even(CAST(l_orderkey * 1000 + 131072 AS DECIMAL(30,10))
    + CAST(l_quantity AS DECIMAL(30,10)) / 64, 2) AS DOUBLE) AS two FROM lineitem""",
    "numbered_lines": """SELECT doc_id, length(text) AS n_chars,
  row_number() OVER (ORDER BY doc_id) - 1 AS position FROM documents""",
    "evaluation_report": f"""WITH {EVALUATED}, {BASELINE}, {scored("baseline", "scored_base")},
{bundle("scored", "m")}, {bundle("scored_base", "b")}, counts AS (SELECT
  {", ".join(f"count(*) FILTER (WHERE gold = '{g}' AND pred = '{p}') AS {g}_{p}" for g in LABELS for p in LABELS)},
  {", ".join(f"count(*) FILTER (WHERE gold = '{g}') AS gold_{g}" for g in LABELS)} FROM scored)
SELECT * EXCLUDE (exact_accuracy_lift) FROM (
  SELECT examples, {ROUNDED}, {lifted("accuracy", "base")}, counts.*
  FROM m, counts, (SELECT accuracy AS base FROM b) b)""",
    "ablation_grid": GRID,
    "manifest_csv": GRID,
    "mirrored_source": "SELECT text, lang, doc_id FROM documents",
    "verified_source": """SELECT text, lang, row_number() OVER (ORDER BY doc_id) - 1 AS position
FROM documents""",
    "flattened_params": f"""SELECT run_id, key, value FROM ({PARAMS}
UNION ALL SELECT event_type, 'run-'||event_id, 'experiment', event_type FROM events)""",
    "scalar_metrics": SCALARS,
    **dict.fromkeys(("tracked_runs", "compacted_runs"), f"""SELECT experiment, run_id, 'param' AS kind, key, value, CAST(NULL AS DOUBLE) AS number
FROM ({PARAMS}) UNION ALL
SELECT experiment, run_id, 'metric', key, CAST(NULL AS VARCHAR), value FROM ({SCALARS})"""),
    "daily_metrics": daily("true"),
    "daily_latency_quantiles": quantile_ranks("day"),
    "weekly_latency_quantiles": quantile_ranks("week"),
    "daily_drift": drift("true"),
    "streamed_drift": drift(CLOSED),
    "daily_prediction_shares": f"""WITH {EVENTS}, {scored("event_rows", keep="day,")}
SELECT day, pred AS prediction, count(*) AS n,
  round(count(*) / CAST(sum(count(*)) OVER (PARTITION BY day) AS DOUBLE), 9) AS share
FROM scored GROUP BY day, pred""",
    "streamed_scores": f"""WITH {TURNS} SELECT id, label, {RULE} AS prediction,
  0.9e0 AS confidence FROM turns""",
    "streamed_preference_pairs": f"""WITH {TURNS} SELECT id, {prompt("text")} AS prompt,
  label AS chosen, {REJECTED} AS rejected FROM turns WHERE {strip("text")} <> ''""",
    "streamed_daily_metrics": daily("true"),
    "streamed_closed_days": daily(CLOSED),
}
