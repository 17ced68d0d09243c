"""DuckDB SQL for the operators that SQL can express."""

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_NORMAL_WORDS = (
    f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
_TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"

_TURNS = r"""
SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
"""
_ESCAPED = r"replace(replace(replace({}, '\', '\\'), '<', '\l'), '#', '\h')"


def _lloyd(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Plain Lloyd iteration, a row per component; every round one more set of tables."""
    steps = [
        f"""
kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label,
    list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 4096) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cells AS MATERIALIZED (
  SELECT r, j // w AS p, j % w AS j, v[j + 1] AS x
  FROM (SELECT r, v, len(v) // {parts} AS w, unnest(range(0, len(v))) AS j FROM kept)),
book0 AS MATERIALIZED (SELECT p, r - 1 AS e, j, x AS c FROM cells WHERE r <= {entries})"""
    ]
    for n in range(rounds + 1):
        steps.append(
            f"""
near{n} AS MATERIALIZED (
  SELECT r, p, e, d FROM (
    SELECT r, p, e, d, row_number() OVER (PARTITION BY r, p ORDER BY d, e) AS place FROM (
      SELECT r, p, e, sum((x - c) * (x - c)) AS d
      FROM cells JOIN book{n} USING (p, j) GROUP BY r, p, e))
  WHERE place = 1)"""
        )
        if n < rounds:
            steps.append(
                f"""
sums{n} AS (
  SELECT p, e, j, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
  FROM near{n} JOIN cells USING (r, p) GROUP BY p, e, j),
book{n + 1} AS MATERIALIZED (
  SELECT p, e, j, CASE WHEN n IS NULL THEN c ELSE (s - ((s % n) + n) % n) // n END AS c
  FROM book{n} LEFT JOIN sums{n} USING (p, e, j))"""
            )
    return f"""
WITH {",".join(steps)},
coded AS (
  SELECT r, string_agg(format('{{:02x}}', e), '' ORDER BY p) AS code,
    CAST(sum(d) AS BIGINT) AS error
  FROM near{rounds} GROUP BY r),
book AS (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY p, e, j)) AS h FROM book{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  h AS codebooks_sha256
FROM kept JOIN coded USING (r), book
"""


ORACLE = {
    "op13_vector_codes": _lloyd(),
    "op5_chat": f"""
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
    AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), ''))
    AS loss_sha256,
  CAST(sum(length({_ESCAPED.format("text")}) + length(replace({_ESCAPED.format("role")}, '>', '\\g'))
    + 17) AS BIGINT) AS formatted_chars
FROM ({_TURNS}) GROUP BY conv_id
""",
    "op7_substrings": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i:i+12], ' ') AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
firsts AS (SELECT k, min(doc_id) AS least FROM win GROUP BY k),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p
  FROM win JOIN firsts USING (k) WHERE doc_id > least),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS text
  FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed,
  sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
""",
    "op4_decontaminate": f"""
WITH dw AS (SELECT doc_id, {_NORMAL_WORDS} AS w FROM documents),
bw AS (SELECT item_id, {_NORMAL_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, len(x) AS n, array_to_string(x, ' ') AS k
  FROM (SELECT item_id, unnest(CASE WHEN len(w) < 10 THEN [w]
          ELSE list_transform(range(1, len(w) - 8), lambda i: w[i:i+9]) END) AS x
        FROM bw WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM win),
places AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, lens),
hits AS (
  SELECT doc_id, i, n, item_id
  FROM (SELECT doc_id, n, i, array_to_string(w[i:i+n-1], ' ') AS k FROM places) JOIN win USING (n, k)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
""",
    "op12_divergence": f"""
WITH d AS (
  SELECT row_number() OVER () AS n, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'),
      '{_TERM}') AS w
  FROM documents),
tf AS (
  SELECT lang, source, t, count(*) AS c, count(DISTINCT n) AS docs
  FROM (SELECT n, lang, source, unnest(w) AS t FROM d) GROUP BY lang, source, t),
kept AS (SELECT lang, t, sum(c) AS lc FROM tf GROUP BY lang, t HAVING sum(docs) >= 3),
langs AS (SELECT lang, count(*) AS v, sum(lc) AS ln FROM kept GROUP BY lang),
grp AS (SELECT DISTINCT lang, source FROM d),
raw AS (
  SELECT lang, source, t, coalesce(c, 0) AS c, lc, v, ln,
    sum(coalesce(c, 0)) OVER (PARTITION BY lang, source) AS n
  FROM grp JOIN kept USING (lang) JOIN langs USING (lang) LEFT JOIN tf USING (lang, source, t)),
prof AS (
  SELECT lang, source, t, c, 1 + (CAST(1000000000 AS HUGEINT) * (c + 1)) // (n + v) AS p,
    1 + (CAST(1000000000 AS HUGEINT) * (lc + 1)) // (ln + v) AS q
  FROM raw),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM prof a JOIN prof b ON a.lang = b.lang AND a.t = b.t AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
both_parts AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL
  SELECT lang, source, 'term', t, ((p - q) * (p - q)) // q FROM prof WHERE c > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS r
  FROM both_parts)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(r AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR r <= 200
""",
}
