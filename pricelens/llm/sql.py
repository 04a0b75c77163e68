"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

SPACE = r"\x20\x09-\x0D"

# chr(9)..chr(13) and chr(32): the characters stripped from a line's ends
STRIP = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP3 = rf"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^{SPACE}]+'))::BIGINT AS size,
         ('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT AS h
  FROM documents WHERE doc_id IS NOT NULL),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3, 1, 2][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT] AS weight
  FROM sized GROUP BY source),
-- The level of the water: every source that is full at it is full, the rest share by weight.
levels AS (
  SELECT a.source, (1.5 * (SELECT sum(source_size) FROM per)
                    - coalesce(sum(2 * b.source_size) FILTER (b.ratio < a.ratio), 0))
                   / sum(b.weight) FILTER (b.ratio >= a.ratio) AS level
  FROM (SELECT *, 2 * source_size / weight AS ratio FROM per) a,
       (SELECT *, 2 * source_size / weight AS ratio FROM per) b
  GROUP BY a.source, a.ratio),
water AS (
  SELECT max(level) FILTER (2 * source_size >= level * weight) AS level
  FROM per JOIN levels ON per.source IS NOT DISTINCT FROM levels.source),
plan AS (
  SELECT source, source_size, least(2.0 * source_size, coalesce(level * weight, 2.0 * source_size))::DOUBLE AS target
  FROM per, water),
budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS rounds FROM plan),
hashes AS (
  SELECT source, h, sum(size)::BIGINT AS words FROM sized GROUP BY source, h),
running AS (
  SELECT source, h, words, sum(words) OVER (PARTITION BY source ORDER BY h) AS upto FROM hashes),
edges AS (
  SELECT r.source, min(r.h) AS h FROM running r JOIN budgets b ON r.source IS NOT DISTINCT FROM b.source
  WHERE upto > target - rounds * source_size
    AND upto - (target - rounds * source_size) > (target - rounds * source_size) - (upto - words)
  GROUP BY r.source)
SELECT s.doc_id, s.size, b.source_size, b.target,
       (s.size * (b.rounds + CASE WHEN e.h IS NULL OR s.h < e.h THEN 1 ELSE 0 END))::BIGINT AS taken
FROM sized s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source
LEFT JOIN edges e ON s.source IS NOT DISTINCT FROM e.source
"""

OP6 = f"""
WITH lines AS (
  SELECT doc_id, unnest(parts) AS line, unnest(range(1, len(parts) + 1)) AS place
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents WHERE doc_id IS NOT NULL)),
keyed AS (
  SELECT *, {LOWER.format(f"trim(line, {STRIP})")} AS key FROM lines),
shared AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT k.*, s.keeper IS NOT NULL AND s.keeper <> k.doc_id AS dropped FROM keyed k LEFT JOIN shared s USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP13 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS c
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same, list_inner_product(a.c, v.c)::BIGINT AS score
  FROM v a JOIN v ON len(a.c) = len(v.c) AND a.vec_id <> v.vec_id
  WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score
  FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       (row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id))::INTEGER AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scores s ON p.anchor_id = s.anchor_id AND NOT s.same
WHERE 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""

SQL = {"op3_mixing": OP3, "op6_linededup": OP6, "op13_negatives": OP13}
