"""DuckDB SQL of the mixing query."""

ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), p AS (
  SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS n FROM s
), q AS (
  SELECT *, [5, 2, 1][(n - 1) % 3 + 1] AS w, 2 * source_size AS cap FROM p
), l AS (
  SELECT *, row_number() OVER (ORDER BY cap / w, n) AS tight,
    (CAST(sum(source_size) OVER () AS DOUBLE) * 1.5
      - coalesce(CAST(sum(cap) OVER (ORDER BY cap / w, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS DOUBLE), 0))
    / (CAST(sum(w) OVER () AS DOUBLE)
      - coalesce(CAST(sum(w) OVER (ORDER BY cap / w, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS DOUBLE), 0)) AS level
  FROM q
), line AS (
  SELECT arg_min(level, tight) AS line FROM l WHERE level <= cap / w
), t AS (
  SELECT source, source_size,
    CASE WHEN line IS NULL THEN CAST(cap AS DOUBLE) ELSE least(CAST(cap AS DOUBLE), line * w) END AS target
  FROM l, line
), f AS (
  SELECT d.*, source_size, target,
    CAST(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS sent
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), turns AS (
  SELECT f.*, turn, CAST(turn * source_size + sent AS DOUBLE) / target AS finish
  FROM f, (SELECT unnest([0, 1]) AS turn) WHERE target > 0
), cut AS (
  SELECT *, sum(size) OVER (ORDER BY finish, source ASC NULLS LAST, k, turn ROWS UNBOUNDED PRECEDING) AS total
  FROM turns
), got AS (
  SELECT doc_id, source, size, count(*) AS copies FROM cut
  WHERE total <= (SELECT sum(target) FROM t) GROUP BY doc_id, source, size
)
SELECT f.doc_id, f.size, f.source_size, f.target, CAST(f.size * coalesce(copies, 0) AS BIGINT) AS taken
FROM f LEFT JOIN got ON f.doc_id IS NOT DISTINCT FROM got.doc_id
  AND f.source IS NOT DISTINCT FROM got.source AND f.size = got.size
"""
