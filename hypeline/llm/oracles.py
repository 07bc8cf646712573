"""DuckDB SQL for the operators' queries that SQL can express.

The others are learned (op2-op4), need a hash DuckDB lacks (op7: crc32; op8: a
rolling hash), a verified alignment (op10) or a tokenizer (op11, op12); tests compare them with
brute-force versions, and the pipeline stage by stage.
"""

from __future__ import annotations

import corpus_pipeline

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

ORACLES: dict[str, str] = {}

# Capped shares in closed form: in the order of cap per weight, the first source
# whose cap lies above the level of those before it sets the final level.
ORACLES["op1_mixing"] = rf"""
WITH docs AS (SELECT doc_id, source, len({_WORDS}) AS size FROM documents),
sources AS (
  SELECT source, sum(size) AS size, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w
  FROM docs GROUP BY source
),
levels AS (
  SELECT w, 3 * size / w AS ratio,
         sum(size) OVER () - coalesce(sum(3 * size) OVER before, 0) AS rest,
         sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS weight
  FROM sources
  WINDOW before AS (ORDER BY 3 * size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
level AS (SELECT CAST(rest AS DOUBLE) AS rest, CAST(weight AS DOUBLE) AS weight
          FROM levels WHERE ratio > rest / weight ORDER BY ratio LIMIT 1),
targets AS (
  SELECT source AS s, CAST(size AS BIGINT) AS source_size,
         CASE WHEN w * (rest / weight) < 3 * size THEN rest * w / weight ELSE CAST(3 * size AS DOUBLE) END AS target,
         CAST('0x' || substr(md5(coalesce(source, '') || '|mix'), 1, 8) AS BIGINT) / CAST(4294967296 AS DOUBLE) AS start
  FROM sources, level
),
ordered AS (
  SELECT d.*, t.*, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
         row_number() OVER (PARTITION BY source ORDER BY size, doc_id) AS place
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.s
),
trials AS (
  SELECT o.*, j, CAST(floor(rate * place + (start + j) / CAST(32 AS DOUBLE))
                      - floor(rate * (place - 1) + (start + j) / CAST(32 AS DOUBLE)) AS BIGINT) AS copies
  FROM ordered o, range(32) r(j)
),
best AS (
  SELECT s, arg_min(j, (off, j)) AS j
  FROM (SELECT s, j, abs(sum(size * copies) - any_value(target)) AS off FROM trials GROUP BY s, j) GROUP BY s
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(copies * size AS BIGINT) AS taken, source, copies
FROM trials t JOIN best b ON t.j = b.j AND t.s IS NOT DISTINCT FROM b.s
"""

ORACLES["op5_jaccard"] = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'),
                                    '[^\x20\x09-\x0D]+') AS ws
  FROM documents
),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(2, len(ws) - 3))) AS i FROM w WHERE len(ws) > 0)
),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i
  FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2
),
links AS (
  SELECT x, y FROM pairs JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * i >= 75 * (p.n + q.n - i)
),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM w
  UNION
  SELECT r.doc_id, l.y FROM reach r JOIN links l ON r.other = l.x
)
SELECT r.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(r.other) AS component_id
FROM reach r LEFT JOIN n USING (doc_id) GROUP BY r.doc_id
"""

ORACLES["op6_rules"] = rf"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS ws FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)
),
twice AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS c FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY doc_id
),
m AS (
  SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
         coalesce(c, 0) AS n_repeat_words, length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper
  FROM w LEFT JOIN covered USING (doc_id)
),
v AS (
  SELECT *, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 100 * n_symbols > 50 * n_words OR 100 * n_dup_lines > 30 * len(lines)
            OR word_chars < 2.5 * n_words OR word_chars > 12 * n_words OR 100 * n_upper > 50 * word_chars) AS kept
FROM v
"""

_BASE32 = " || ".join(
    f"substr('{_UPPER}234567', 1 + ((v[{i + 1}] >> {5 * (3 - k)}) & 31), 1)" for i in range(8) for k in range(4))

ORACLES["op9_warc"] = rf"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
h AS (
  SELECT page_id, octet_length(body) AS n, sha1(body) AS digest,
         list_transform(range(8), lambda i: CAST('0x' || substr(sha1(body), 1 + 5 * i, 5) AS INTEGER)) AS v
  FROM p
),
f AS (SELECT *, first_value(page_id) OVER same AS first_id, row_number() OVER same AS place
      FROM h WINDOW same AS (PARTITION BY digest, n ORDER BY page_id))
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
       if(place = 1, 'response', 'revisit') AS record_type, if(place = 1, NULL, first_id) AS refers_to
FROM f
"""

# Brute force over all pairs of an anchor and a row.
ORACLES["op13_hard_negatives"] = """
WITH v AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND coalesce(list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))), true)
),
scores AS (
  SELECT a.id AS anchor_id, b.id AS other, a.label = b.label AS same,
         CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.id <> b.id WHERE a.id % 100 = 0
),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM scores WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank,
       other AS negative_id, positive_score, score AS negative_score
FROM p JOIN scores USING (anchor_id)
WHERE NOT same AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score
QUALIFY rank <= 10
"""

if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
