"""DuckDB SQL of queries whose whole result SQL can express, each from the contract alone."""

from __future__ import annotations

import string

from tillroll.llm import mean_order_clusters

_LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"

SHINGLE_JOIN = rf"""WITH RECURSIVE words AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
),
sets AS MATERIALIZED (
  SELECT r, doc_id,
         CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[])
              WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
              ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM words
),
shingles AS MATERIALIZED (SELECT r, len(s) AS n, unnest(s) AS x FROM sets),
links AS MATERIALIZED (
  SELECT a.r AS p, b.r AS q
  FROM shingles a JOIN shingles b ON a.x = b.x AND a.r <> b.r
  GROUP BY a.r, b.r, a.n, b.n
  HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
),
reach AS (
  SELECT r AS p, r AS q FROM sets
  UNION
  SELECT reach.p, links.q FROM reach JOIN links ON reach.q = links.p
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, least.component_id
FROM sets s
JOIN (SELECT reach.p, min(o.doc_id) AS component_id FROM reach JOIN sets o ON o.r = reach.q GROUP BY reach.p) least ON least.p = s.r"""

SUFFIX_DEDUP = """WITH texts AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents
),
starts AS (SELECT r, b, unnest(range(1, octet_length(b) - 398)) AS i FROM texts),
windows AS MATERIALIZED (SELECT r, i, md5(b[i:i + 399]) AS m FROM starts),
again AS MATERIALIZED (
  SELECT r, i FROM windows WHERE m IN (SELECT m FROM windows GROUP BY m HAVING count(*) > 1)
),
opened AS (SELECT r, i, coalesce(i - lag(i) OVER (PARTITION BY r ORDER BY i) > 400, true) AS opens FROM again),
numbered AS (SELECT r, i, sum(CAST(opens AS INTEGER)) OVER (PARTITION BY r ORDER BY i) AS run FROM opened),
spans AS MATERIALIZED (SELECT r, run, min(i) AS a, max(i) + 399 AS z FROM numbered GROUP BY r, run),
kept AS (
  SELECT r, lag(z, 1, 0) OVER (PARTITION BY r ORDER BY a) + 1 AS a, a - 1 AS z FROM spans
  UNION ALL
  SELECT r, max(z) + 1, NULL FROM spans GROUP BY r
),
rest AS (
  SELECT t.r, string_agg(hex(t.b[k.a:coalesce(k.z, octet_length(t.b))]), '' ORDER BY k.a) AS h
  FROM kept k JOIN texts t USING (r) GROUP BY t.r
),
removed AS (SELECT r, CAST(sum(z - a + 1) AS BIGINT) AS n_removed, count(*) AS n_spans FROM spans GROUP BY r)
SELECT t.doc_id, CAST(octet_length(t.b) AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed,
       coalesce(n_spans, 0) AS n_spans,
       CASE WHEN rest.h IS NULL THEN sha256(t.b) ELSE sha256(unhex(rest.h)) END AS kept_sha256,
       CASE WHEN rest.h IS NULL THEN decode(t.b) ELSE decode(unhex(rest.h)) END AS text
FROM texts t LEFT JOIN removed USING (r) LEFT JOIN rest USING (r)"""

BLOCK_NEIGHBOURS = """WITH rows_in AS MATERIALIZED (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))
           / (sqrt(list_sum(list_transform(q.v, lambda x: x * x))) * sqrt(list_sum(list_transform(c.v, lambda x: x * x)))) AS score
  FROM rows_in q JOIN rows_in c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 5"""

SQL = {
    "op1_suffix_dedup": SUFFIX_DEDUP,
    "op5_shingle_join": SHINGLE_JOIN,
    "op8_block_neighbours": BLOCK_NEIGHBOURS,
    "op13_mean_order_clusters": mean_order_clusters.ORACLE_SQL,
}
