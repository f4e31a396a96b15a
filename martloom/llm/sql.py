"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

FAIR_MIX = r"""
WITH sizes AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS spot
  FROM documents),
totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         list_extract([5, 2, 1], CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT)) AS weight
  FROM sizes GROUP BY source),
fill AS (
  SELECT *, 2 * source_size AS most, CAST(2 * source_size AS DOUBLE) / weight AS full_at,
         CAST(sum(source_size) OVER () AS DOUBLE) * 1.5 AS budget
  FROM totals),
levels AS (
  SELECT *, (budget - coalesce(sum(most) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
         row_number() OVER w AS place
  FROM fill WINDOW w AS (ORDER BY full_at, source NULLS LAST)),
opened AS (SELECT min(place) AS first_open FROM levels WHERE level < full_at),
goals AS (
  SELECT source, source_size,
         CASE WHEN first_open IS NULL OR place < first_open THEN CAST(most AS DOUBLE)
              ELSE (SELECT level FROM levels, opened WHERE place = first_open) * weight END AS target
  FROM levels, opened),
queue AS (
  SELECT doc_id, source, size,
         coalesce(sum(size) OVER (PARTITION BY source ORDER BY spot, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sizes)
SELECT doc_id, size, source_size, target,
       CAST(least(greatest(CAST(round(target) AS BIGINT) - before, 0), size)
            + least(greatest(CAST(round(target) AS BIGINT) - before - source_size, 0), size) AS BIGINT) AS taken
FROM queue JOIN goals ON queue.source IS NOT DISTINCT FROM goals.source
"""

LINE_DEDUP = r"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS place FROM split),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
holders AS (SELECT key, min(doc_id) AS first_doc FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING min(doc_id) < max(doc_id)),
judged AS (
  SELECT k.doc_id, k.place, k.line, coalesce(k.doc_id <> h.first_doc, FALSE) AS dropped
  FROM keyed k LEFT JOIN holders h ON k.key = h.key)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE dropped) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
