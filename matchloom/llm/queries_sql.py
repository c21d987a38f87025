"""The SQL of those corpus operators that SQL can express, over the same tables."""

from __future__ import annotations

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
TERMS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

EMBEDDINGS = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
), good AS (
  SELECT vec_id, v FROM vectors
  WHERE v IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.95
), reached(a, b) AS (
  SELECT vec_id, vec_id FROM vectors
  UNION
  SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
), roots AS (SELECT a AS vec_id, min(b) AS component_id FROM reached GROUP BY a),
counts AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM vectors JOIN roots USING (vec_id) LEFT JOIN counts USING (vec_id)
"""

# Five hex digits are four characters of base 32.
WARC = f"""
WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), named AS (
  SELECT page_id, payload_bytes, max(page_id) OVER (PARTITION BY hex) AS newest,
    array_to_string(list_transform(range(32), lambda i: substr('{BASE32}', CAST(
      (CAST('0x' || substr(hex, CAST(5 * (i // 4) + 1 AS INTEGER), 5) AS INTEGER) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31
    AS INTEGER) + 1, 1)), '') AS payload_digest
  FROM payloads
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = newest THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> newest THEN newest END AS refers_to
FROM named
"""

SEARCH = f"""
WITH words AS (
  SELECT 'document' AS side, doc_id AS id, translate(unnest(regexp_extract_all(text, '{TERMS}')), '{UPPER}', '{LOWER}') AS term FROM documents
  UNION ALL
  SELECT 'item', item_id, translate(unnest(regexp_extract_all(text, '{TERMS}')), '{UPPER}', '{LOWER}') FROM benchmark
), tfs AS (SELECT id AS doc_id, term, count(*) AS tf FROM words WHERE side = 'document' GROUP BY ALL),
sizes AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tfs GROUP BY doc_id),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
dfs AS (SELECT term, count(*) AS df FROM tfs GROUP BY term),
asked AS (SELECT DISTINCT id AS item_id, term FROM words WHERE side = 'item'),
weights AS (
  SELECT item_id, term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM asked JOIN dfs USING (term), total
), scores AS (
  SELECT item_id, doc_id,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * docs) // terms))))) AS BIGINT) AS score
  FROM weights JOIN tfs USING (term) JOIN sizes USING (doc_id), total GROUP BY item_id, doc_id
), ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

LINES = f"""
WITH split AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents
), keyed AS (
  SELECT doc_id, line, place, translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'), '{UPPER}', '{LOWER}') AS key
  FROM split
), shared AS (
  SELECT key, max(doc_id) AS keeps FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), decided AS (
  SELECT doc_id, line, place, coalesce(doc_id <> keeps, FALSE) AS dropped FROM keyed LEFT JOIN shared USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT dropped), '')) AS kept_sha256
FROM decided GROUP BY doc_id
"""

ORACLES = {
    "op1_embedding_near_dedup": EMBEDDINGS,
    "op10_warc": WARC,
    "op12_lexical_search": SEARCH,
    "op13_line_dedup": LINES,
}
