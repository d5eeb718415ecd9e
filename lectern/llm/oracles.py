"""The pair operators in DuckDB's SQL: all pairs, which suits small tables only."""

#: Links of words' shingles of two, on sets of shingles that texts share.
OP3_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT DISTINCT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM docs WHERE len(w) > 1
  UNION SELECT doc_id, w[1] FROM docs WHERE len(w) = 1
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), texts AS (
  SELECT min(doc_id) AS rep, list(doc_id) AS ids, any_value(w) AS w FROM docs WHERE len(w) > 0 GROUP BY hash(w), w
), few AS (
  SELECT doc_id, s FROM shingles WHERE doc_id IN (SELECT rep FROM texts)
), pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM few a JOIN few b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * shared >= 80 * (p.n + q.n - shared)
  UNION SELECT rep, unnest(ids) FROM texts
), ends AS (
  SELECT x, y FROM links WHERE x <> y UNION SELECT y, x FROM links WHERE x <> y
), reach AS (
  SELECT x, y FROM ends UNION SELECT r.x, e.y FROM reach r JOIN ends e ON r.y = e.x
), least_ AS (
  SELECT x, min(y) AS y FROM reach GROUP BY x
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(y, d.doc_id)) AS component_id, d.doc_id = least(d.doc_id, coalesce(y, d.doc_id)) AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN least_ ON x = d.doc_id
"""

_USABLE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0 AND len(list_filter(embedding, lambda e: e <> 0)) > 0"

OP6_SQL = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE label IS NOT NULL AND {_USABLE}
), links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_inner_product(a.e, b.e) / sqrt(list_inner_product(a.e, a.e)) / sqrt(list_inner_product(b.e, b.e)) >= 0.98
), reach AS (
  SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
), least_ AS (
  SELECT x, min(y) AS y FROM reach GROUP BY x
), counts AS (
  SELECT x, count(*) AS n FROM links GROUP BY x
)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(y, vec_id)) AS component_id, vec_id = least(vec_id, coalesce(y, vec_id)) AS kept
FROM embeddings LEFT JOIN counts ON counts.x = vec_id LEFT JOIN least_ ON least_.x = vec_id
"""

OP7_SQL = f"""
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE {_USABLE}
), scores AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.e, b.e) AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""
