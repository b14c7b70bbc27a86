"""Query of the quality rules, with its SQL."""

from __future__ import annotations

from zonewright.llm.quality_rules import BASE, quality_rules
from zonewright.llm.registry import query, table

SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, source FROM documents),
w AS (
  SELECT doc_id, t, source, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
    list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls
  FROM d),
win AS (
  SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
  FROM w, unnest(range(1, len(ws) - 1)) AS u(i)),
hit AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
rep AS (
  SELECT doc_id, count(DISTINCT i + k) AS n
  FROM hit, unnest([0, 1, 2]) AS u(k) GROUP BY doc_id),
lines AS (
  SELECT doc_id, source, t, trim(regexp_replace(regexp_replace(lower(l), '[0-9]', '0', 'g'),
    '[\x20\x09-\x0D]+', ' ', 'g')) AS line, l
  FROM (SELECT doc_id, source, t, unnest(string_split(t, chr(10))) AS l FROM d)),
hosts AS (SELECT source, count(DISTINCT t) AS docs FROM d GROUP BY source),
freq AS (
  SELECT x.source, x.line FROM (
    SELECT source, line, count(DISTINCT t) AS n FROM lines WHERE line <> '' GROUP BY 1, 2) x
  JOIN hosts h ON h.source IS NOT DISTINCT FROM x.source
  WHERE x.n > 10 AND x.n > h.docs * 0.05),
cut AS (
  SELECT l.doc_id, sum(len(regexp_extract_all(l.l, '[^\x20\x09-\x0D]+'))) AS n
  FROM lines l JOIN freq f ON f.line = l.line AND f.source IS NOT DISTINCT FROM l.source
  GROUP BY l.doc_id),
base AS (
  SELECT w.doc_id, len(ws)::BIGINT AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
    len(ws) - coalesce(cut.n, 0) AS rest
  FROM w LEFT JOIN rep USING (doc_id) LEFT JOIN cut USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
    AND rest >= 50 AND rest >= 0.5 * n_words AS kept
FROM base
"""


@query("op4_quality_rules", SQL)
def op4_quality_rules(spark, sf_dir):
    return quality_rules(table(spark, sf_dir, "documents")).select("doc_id", *BASE, "kept")
