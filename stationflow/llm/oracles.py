"""DuckDB SQL for the queries that SQL can express (views: the test tables)."""

from __future__ import annotations

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_ASCII_LOWER = f"translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}')"
_WORDS = rf"regexp_extract_all({_ASCII_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_SPACE_WORDS = rf"regexp_extract_all({_ASCII_LOWER}, '[^\x20\x09-\x0D]+')"

NEAR_DUPLICATES = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, {_SPACE_WORDS} AS w FROM documents
), sets AS (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[]
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END) AS s
  FROM words
), sizes AS (
  SELECT doc_id, count(*) AS n FROM sets GROUP BY 1
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
  FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * k >= 85 * (p.n + q.n - k)
), reach AS (
  SELECT doc_id AS node, doc_id AS root FROM documents
  UNION
  SELECT y, root FROM reach JOIN links ON x = node
)
SELECT doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles, min(root) AS component_id,
  doc_id = min(root) AS kept
FROM reach JOIN documents ON doc_id = node LEFT JOIN sizes USING (doc_id)
GROUP BY doc_id
"""

DECONTAMINATE = f"""
WITH words AS (
  SELECT doc_id, {_WORDS} AS w FROM documents
), items AS (
  SELECT item_id, {_WORDS} AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS k,
    unnest(list_transform(range(1, len(w) - least(13, len(w)) + 2), lambda i: array_to_string(w[i:i + least(13, len(w)) - 1], ' '))) AS t
  FROM items WHERE len(w) > 0
), lengths AS (
  SELECT DISTINCT k FROM windows
), places AS (
  SELECT doc_id, k, i, array_to_string(w[i + 1:i + k], ' ') AS t
  FROM (SELECT doc_id, w, k, unnest(range(0, len(w) - k + 1)) AS i FROM words, lengths WHERE len(w) >= k)
), found AS (
  SELECT doc_id, i, k, item_id FROM places JOIN windows USING (k, t)
), hits AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM found) GROUP BY 1
), ids AS (
  SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS ids FROM found GROUP BY 1
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(len(coalesce(ids, [])) AS BIGINT) AS n_items,
  sha256(array_to_string(coalesce(ids, []), ',')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words LEFT JOIN hits USING (doc_id) LEFT JOIN ids USING (doc_id)
"""

WARC = """
WITH payloads AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS digest FROM pages
), shared AS (
  SELECT digest, max(page_id) AS target FROM payloads WHERE n >= 1000 GROUP BY 1
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
  CASE WHEN n >= 1000 AND page_id <> target THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id <> target THEN target END AS refers_to
FROM payloads LEFT JOIN shared USING (digest)
"""

_TERMS = rf"regexp_extract_all({_ASCII_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

RANKED_SEARCH = f"""
WITH docs AS (
  SELECT doc_id, row_number() OVER () AS r, {_TERMS} AS w FROM documents
), sizes AS (
  SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n FROM docs WHERE len(w) > 0
), totals AS (
  SELECT CAST(count(*) AS BIGINT) AS cn, CAST(sum(n) AS BIGINT) AS cl FROM sizes
), items AS (
  SELECT row_number() OVER () AS i, item_id, w FROM (SELECT DISTINCT item_id, {_TERMS} AS w, text FROM benchmark)
), asked AS (
  SELECT i, t, CAST(count(*) AS BIGINT) AS times FROM (SELECT i, unnest(w) AS t FROM items) GROUP BY 1, 2
), held AS (
  SELECT r, t, CAST(count(*) AS BIGINT) AS tf FROM (SELECT r, unnest(w) AS t FROM docs)
  WHERE t IN (SELECT t FROM asked) GROUP BY 1, 2
), weights AS (
  SELECT t, CAST(floor(1000 * ln((2 * cn + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM held, totals GROUP BY t, cn
), gains AS (
  SELECT r, t, w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * cn) // cl))) AS gain
  FROM held JOIN weights USING (t) JOIN sizes USING (r), totals
), scores AS (
  SELECT i, r, CAST(sum(times * gain) AS BIGINT) AS score FROM asked JOIN gains USING (t) GROUP BY 1, 2
), ranked AS (
  SELECT i, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank
  FROM scores JOIN sizes USING (r) WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked JOIN items USING (i) WHERE rank <= 20
"""
