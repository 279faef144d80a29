"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

_FILTER_AUDIT = r"""
WITH letters AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS t(letter, bit)),
orders AS (
    SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
    FROM letters a JOIN letters b ON b.bit <> a.bit JOIN letters c ON c.bit NOT IN (a.bit, b.bit)
    JOIN letters d ON d.bit NOT IN (a.bit, b.bit, c.bit) JOIN letters e ON e.bit NOT IN (a.bit, b.bit, c.bit, d.bit)),
steps AS (
    SELECT filter_order, step, bit, SUM(bit) OVER (PARTITION BY filter_order ORDER BY step) - bit AS earlier
    FROM (SELECT filter_order, UNNEST([1, 2, 3, 4, 5]) AS step FROM orders) JOIN letters ON letter = substr(filter_order, step, 1)),
texts AS (
    SELECT doc_id, COALESCE(source, '') AS part, COALESCE(text, '') AS text,
           regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents),
failures AS (
    SELECT doc_id, part,
           CASE WHEN len(words) < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 2 ELSE 0 END
           + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 4 ELSE 0 END
           + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
           + CASE WHEN doc_id > MIN(doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END AS mask
    FROM texts),
marks AS (
    SELECT doc_id, MAX(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, MAX(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels GROUP BY doc_id),
cells AS (
    SELECT part, mask, COUNT(*) AS docs, SUM(COALESCE(good, 0)) AS good, SUM(COALESCE(toxic, 0)) AS toxic
    FROM failures LEFT JOIN marks USING (doc_id) GROUP BY part, mask),
counts AS (
    SELECT part, filter_order, step, bit,
           COALESCE(SUM(docs) FILTER (mask & (earlier + bit) = 0), 0) AS kept,
           COALESCE(SUM(docs) FILTER (mask & bit > 0 AND mask & earlier = 0), 0) AS removed,
           COALESCE(SUM(docs) FILTER (mask & bit > 0 AND mask & earlier > 0), 0) AS redundant,
           COALESCE(SUM(docs) FILTER (mask = bit), 0) AS unique_fails,
           COALESCE(SUM(good) FILTER (mask & bit > 0 AND mask & earlier = 0), 0) AS good_lost,
           COALESCE(SUM(toxic) FILTER (mask & bit > 0 AND mask & earlier = 0), 0) AS toxic_lost
    FROM cells CROSS JOIN (SELECT filter_order, step, bit, CAST(earlier AS INTEGER) AS earlier FROM steps)
    GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(SUM(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM counts"""


def oracle_sql() -> dict[str, str]:
    return {"op12_filter_audit": _FILTER_AUDIT}
