"""The rule cascade in SQL: the base metrics and every threshold, stated on their own."""

SQL = r"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS t FROM documents
), words AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM base
), lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM base)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), places AS (
  SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS p FROM words WHERE len(w) >= 8
), runs AS (
  SELECT doc_id, p, array_to_string(w[p:p + 7], ' ') AS run FROM places
), twice AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, run) AS n FROM runs) WHERE n > 1
), repeated AS (
  SELECT doc_id, count(DISTINCT place) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(p, p + 8)) AS place FROM twice) GROUP BY doc_id
), metrics AS (
  SELECT words.doc_id, len(w)::BIGINT AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    coalesce(n_lines, 0) AS n_lines,
    length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper,
    length(regexp_replace(t, '[^A-Za-z]', '', 'g')) AS n_letters
  FROM words LEFT JOIN lines USING (doc_id) LEFT JOIN repeated USING (doc_id)
), judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM metrics
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > 3 * n_words OR 10 * n_upper > 6 * n_letters
    OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 10 * n_dup_lines > 3 * n_lines) AS kept
FROM judged
"""
