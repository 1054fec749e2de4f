"""The filter audit in SQL: filters by regular expressions, every document in every order."""

SQL = r"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS part FROM documents
), words AS (
  SELECT doc_id, t, part, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY t) AS first FROM base
), told AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), fails AS (
  SELECT words.doc_id, part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    (len(w) < 100)::INT + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::INT
    + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t))::INT
    + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(words.doc_id > first, false)::INT AS mask
  FROM words LEFT JOIN told ON told.doc_id = words.doc_id
), letters AS (
  SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(letter, own)
), orders AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e WHERE a.own + b.own + c.own + d.own + e.own = 31
    AND a.own <> b.own AND c.own NOT IN (a.own, b.own) AND d.own NOT IN (a.own, b.own, c.own) AND e.own NOT IN (a.own, b.own, c.own, d.own)
), places AS (
  SELECT filter_order, i AS step, own,
    (SELECT coalesce(sum(l.own), 0) FROM letters l WHERE contains(substr(filter_order, 1, i - 1), l.letter))::INT AS earlier
  FROM (SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS i FROM orders) JOIN letters ON letter = substr(filter_order, i, 1)
), counted AS (
  SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM fails GROUP BY part, mask
), stepped AS (
  SELECT part, filter_order, step, own,
    sum(n) FILTER (WHERE mask & (earlier | own) = 0) AS kept,
    sum(n) FILTER (WHERE mask & own > 0 AND mask & earlier = 0) AS removed,
    sum(n) FILTER (WHERE mask & own > 0 AND mask & earlier > 0) AS redundant,
    sum(n) FILTER (WHERE mask = own) AS unique_fails,
    sum(good) FILTER (WHERE mask & own > 0 AND mask & earlier = 0) AS good_lost,
    sum(toxic) FILTER (WHERE mask & own > 0 AND mask & earlier = 0) AS toxic_lost
  FROM counted, places GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step::INT AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
  coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
  coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  (sum(coalesce(removed, 0)) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM stepped
"""
