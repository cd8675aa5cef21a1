"""SQL of the queries that SQL can express, written from the rules and not from the operators' plans."""

from __future__ import annotations

from daybook.llm import licenses, quality_rules

_PHRASES = ", ".join(f"('{phrase}', '{label}')" for phrase, label in licenses.PHRASES.items())
_TEMPLATES = ", ".join(f"('{label}', '{must}', '{text}')" for label, must, text in licenses.TEMPLATES)
_LICENSE_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

LICENSES = f"""
WITH docs AS (
  SELECT row_number() OVER () AS row_id, doc_id,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
  FROM documents),
lists AS (SELECT *, regexp_extract_all(low, '{_LICENSE_WORD}') AS words FROM docs),
phrases(phrase, label) AS (VALUES {_PHRASES}),
places AS (
  SELECT row_id, label, unnest(list_filter(range(len(words)),
           lambda i: array_to_string(words[i + 1 : i + len(string_split(phrase, ' '))], ' ') = phrase)) AS place
  FROM lists, phrases
  WHERE contains(low, 'license') OR contains(low, 'cc')),
base AS (
  SELECT row_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, list(label) AS labels
  FROM places GROUP BY row_id),
templates AS (
  SELECT label, string_split(must, ' ') AS must, list_distinct(string_split(text, ' ')) AS t,
         CASE WHEN len(string_split(text, ' ')) <= 16 THEN 16 ELSE 32 END AS step
  FROM (VALUES {_TEMPLATES}) AS v(label, must, text)),
blocks AS (
  SELECT row_id, step, list_distinct(words[begun + 1 : begun + 2 * step]) AS b
  FROM (SELECT row_id, words, step, unnest(range(0, len(words), step)) AS begun FROM lists, (VALUES (16), (32)) AS v(step))),
held AS (
  SELECT row_id, list(label) AS labels, max(share) AS share FROM (
    SELECT row_id, label, len(list_intersect(t, b))::DOUBLE / len(t) AS share
    FROM blocks JOIN templates USING (step) WHERE list_has_all(b, must))
  WHERE share >= {licenses.CONTAINMENT} GROUP BY row_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base,
       first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       array_to_string(list_sort(list_distinct(coalesce(base.labels, []))), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(held.labels, [])))), ',')
         AS labels,
       CASE WHEN coalesce(n_base, 0) > 0 THEN 1.0::DOUBLE ELSE coalesce(held.share, 0.0)::DOUBLE END AS score
FROM lists LEFT JOIN base USING (row_id) LEFT JOIN held USING (row_id)
"""

_RATES = list(quality_rules.UPPER)
_BUCKET = "{0} - {0} % (1::BIGINT << greatest(length(bin({0})) - 10, 0))"
_STACKED = " UNION ALL ".join(
    f"SELECT lang, source, '{r}' AS rate, {_BUCKET.format(r)} AS bucket FROM rates WHERE NOT base_failed" for r in _RATES
)
_TAILS = ", ".join(f"('{r}', {quality_rules.UPPER[r]}, {quality_rules.LOWER.get(r, 'NULL')})" for r in _RATES)
_DRAWN = ", ".join(
    f"(g.total * g.{x} + {quality_rules.PRIOR} * ((l.total * l.{x} + {quality_rules.PRIOR} * a.{x}) // (l.total + {quality_rules.PRIOR})))"
    f" // (g.total + {quality_rules.PRIOR}) AS {x}"
    for x in ("high", "low")
)
_INSIDE = " AND ".join(
    [f"{r} <= max(CASE WHEN rate = '{r}' THEN high END)" for r in _RATES]
    + [f"{r} >= max(CASE WHEN rate = '{r}' THEN low END)" for r in quality_rules.LOWER]
)

QUALITY_RULES = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS row_id, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT row_id, unnest(w) AS word, unnest(range(len(w))) AS pos
  FROM (SELECT row_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM docs)),
windows AS (
  SELECT row_id, pos, lead(pos, 2) OVER p AS last_pos, word AS a, lead(word) OVER p AS b, lead(word, 2) OVER p AS c
  FROM words WINDOW p AS (PARTITION BY row_id ORDER BY pos)),
repeats AS (
  SELECT row_id, pos FROM (
    SELECT row_id, pos, count(*) OVER (PARTITION BY row_id, a, b, c) AS n FROM windows WHERE last_pos IS NOT NULL)
  WHERE n > 1),
covered AS (
  SELECT row_id, count(DISTINCT pos + k) AS n FROM repeats, (VALUES (0), (1), (2)) AS v(k) GROUP BY row_id),
lines AS (
  SELECT row_id, count(*) AS n, count(*) - count(DISTINCT line) AS dup
  FROM (SELECT row_id, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY row_id),
counted AS (SELECT row_id, count(*) AS n, sum(length(word)) AS chars FROM words GROUP BY row_id),
measures AS (
  SELECT doc_id, lang, source, row_id, coalesce(counted.n, 0)::BIGINT AS n_words, coalesce(chars, 0)::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(lines.dup, 0)::BIGINT AS n_dup_lines,
         coalesce(covered.n, 0)::BIGINT AS n_repeat_words, coalesce(lines.n, 0)::BIGINT AS n_lines
  FROM docs LEFT JOIN counted USING (row_id) LEFT JOIN covered USING (row_id) LEFT JOIN lines USING (row_id)),
rates AS (
  SELECT *, n_symbols * 1000 // nullif(n_words, 0) AS symbol_rate, n_dup_lines * 1000 // nullif(n_lines, 0) AS dup_line_rate,
         n_repeat_words * 1000 // nullif(n_words, 0) AS repeat_rate, word_chars * 100 // nullif(n_words, 0) AS word_length,
         n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PERCENT} * n_words AS base_failed
  FROM measures),
stacked AS ({_STACKED}),
grouped AS (
  SELECT 2 AS level, lang, source, rate, bucket FROM stacked
  UNION ALL SELECT 1, lang, NULL, rate, bucket FROM stacked
  UNION ALL SELECT 0, NULL, NULL, rate, bucket FROM stacked),
counts AS (SELECT level, lang, source, rate, bucket, count(*)::BIGINT AS n FROM grouped GROUP BY ALL),
below AS (
  SELECT *, sum(n) OVER (PARTITION BY level, lang, source, rate ORDER BY bucket) AS below,
         sum(n) OVER (PARTITION BY level, lang, source, rate) AS total FROM counts),
tails(rate, up, down) AS (VALUES {_TAILS}),
quantiles AS (
  SELECT level, lang, source, rate, max(total)::BIGINT AS total,
         min(bucket) FILTER (WHERE below * 100 >= total * 50) AS mid,
         min(bucket) FILTER (WHERE below * 100 >= total * up) AS upper,
         min(bucket) FILTER (WHERE below * 100 >= total * down) AS lower
  FROM below JOIN tails USING (rate) GROUP BY level, lang, source, rate),
limits AS (
  SELECT level, lang, source, rate, total, upper + {quality_rules.SPREAD} * (upper - mid) + {quality_rules.GUARD} AS high,
         CASE WHEN lower IS NOT NULL
           THEN greatest(lower - {quality_rules.SPREAD} * (mid - lower) - {quality_rules.GUARD}, 0) END AS low
  FROM quantiles),
chosen AS (
  SELECT g.lang, g.source, g.rate, {_DRAWN}
  FROM limits AS g JOIN limits AS l ON l.level = 1 AND l.rate = g.rate AND l.lang IS NOT DISTINCT FROM g.lang
    JOIN limits AS a ON a.level = 0 AND a.rate = g.rate
  WHERE g.level = 2),
verdicts AS (
  SELECT r.row_id, {_INSIDE} AS inside
  FROM rates AS r JOIN chosen AS c ON r.lang IS NOT DISTINCT FROM c.lang AND r.source IS NOT DISTINCT FROM c.source
  GROUP BY r.row_id, {", ".join(_RATES)})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(inside, false) AS kept
FROM rates LEFT JOIN verdicts USING (row_id)
"""

EXACT_DEDUP = """
WITH low AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(norm) AS text_sha256
FROM low
"""

HARD_NEGATIVES = """
WITH held AS (
  SELECT row_number() OVER () AS row_id, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.row_id AS anchor, a.vec_id AS anchor_id, b.row_id AS other, b.vec_id, a.label = b.label AS same,
         list_dot_product(a.v, b.v)::BIGINT AS score
  FROM held a JOIN held b ON a.row_id <> b.row_id
  WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT * FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS LAST, other) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
       row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY n.score DESC, n.vec_id NULLS LAST, n.other)::INTEGER AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON p.anchor = n.anchor AND NOT n.same
WHERE 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY rank <= 3
"""
