"""SQL for the operators that it can express, as DuckDB runs it."""

from __future__ import annotations

SUBSTRING_DEDUP = r"""
WITH texts AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words FROM documents),
windows AS (
  SELECT doc_id, place, array_to_string(words[place : place + 12], ' ') AS sequence
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS place FROM texts)
),
firsts AS (SELECT sequence, min(doc_id) AS first_doc FROM windows GROUP BY sequence),
covered AS (
  SELECT DISTINCT doc_id, unnest(range(place, place + 13)) AS place
  FROM windows JOIN firsts USING (sequence) WHERE first_doc < doc_id
),
words AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM texts),
kept AS (
  SELECT doc_id, count(c.place) AS n_removed, string_agg(word, ' ' ORDER BY w.place) FILTER (c.place IS NULL) AS text
  FROM words w LEFT JOIN covered c USING (doc_id, place) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)
"""

MINHASH = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS words
  FROM documents
),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[place : place + 3], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, 2))) AS place FROM texts WHERE len(words) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n_shingles FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * n >= 80 * (x.n_shingles + y.n_shingles - n)
),
reached AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT doc_id, b FROM reached JOIN links ON other = a)
SELECT doc_id, coalesce(n_shingles, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) LEFT JOIN sizes USING (doc_id)
"""

ORACLES = {"op5_substring_dedup": SUBSTRING_DEDUP, "op12_minhash": MINHASH}
