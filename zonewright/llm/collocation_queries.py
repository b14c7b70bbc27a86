"""Query of the collocations, with its SQL."""

from __future__ import annotations

from zonewright.llm.collocations import collocations
from zonewright.llm.registry import query, table

SQL = r"""
WITH p AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
    regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\f\r]') AS pieces FROM documents),
q AS (SELECT doc, lang, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS no FROM p),
w AS (SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS ws FROM q),
s AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w WHERE len(ws) > 0),
g AS (
  SELECT lang, array_to_string(ws[i:i+k-1], ' ') AS phrase, k, count(*) AS f
  FROM s, (VALUES (1),(2),(3),(4),(5)) AS z(k) WHERE i + k - 1 <= len(ws)
  GROUP BY ALL HAVING count(*) >= 100),
t AS (SELECT lang, count(*) AS n FROM s GROUP BY lang),
c AS (SELECT lang, phrase, string_split(phrase, ' ') AS ws, k, f FROM g WHERE k >= 2),
held AS (
  SELECT DISTINCT c.lang, array_to_string(c.ws[i:i+m-1], ' ') AS phrase, c.f
  FROM c, (VALUES (2),(3),(4)) AS z(m), (VALUES (1),(2),(3),(4)) AS y(i) WHERE m < c.k AND i + m - 1 <= c.k),
kept AS (
  SELECT * FROM c WHERE NOT EXISTS (
    SELECT 1 FROM held h WHERE h.lang = c.lang AND h.phrase = c.phrase AND 100 * h.f >= 100 * c.f)),
cuts AS (
  SELECT kept.lang, kept.phrase, kept.f AS a, x.f AS l, y.f AS r, t.n, z.j,
    (1000::HUGEINT * kept.f * t.n) // (x.f::HUGEINT * y.f) AS score
  FROM kept JOIN (VALUES (1),(2),(3),(4)) AS z(j) ON z.j < kept.k
  JOIN g x ON x.lang = kept.lang AND x.phrase = array_to_string(kept.ws[1:z.j], ' ')
  JOIN g y ON y.lang = kept.lang AND y.phrase = array_to_string(kept.ws[z.j+1:kept.k], ' ')
  JOIN t ON t.lang = kept.lang),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
ranked AS (
  SELECT lang, row_number() OVER (
    PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
    phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM best)
SELECT * FROM ranked WHERE rank <= 2000
"""


@query("op11_collocations", SQL)
def op11_collocations(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents"))
