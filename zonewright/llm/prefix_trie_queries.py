"""Query of the conversation trie, with its SQL."""

from __future__ import annotations

from zonewright.llm.prefix_trie import prefix_trie, rebuilt
from zonewright.llm.registry import query, table

_BIT = "xor(r >> 1, CASE WHEN r & 1 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END)"
#: crc32, byte by byte and bit by bit.
_CRC = f"""xor(list_reduce(list_prepend(4294967295::UBIGINT,
    list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::UBIGINT)),
    lambda s, b: list_reduce(list_prepend(xor(s, b), [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda r, z: {_BIT})),
    4294967295::UBIGINT)"""

SQL = f"""
WITH t AS (
  SELECT conv_id AS c, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST,
    md5(coalesce(role, '')), md5(coalesce(text, ''))) AS ts
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT c, ts, (({_CRC}) % 6)::BIGINT AS h FROM t),
r AS (
  SELECT h.c, list_concat(coalesce(b.ts, [])[1:h.h], h.ts[h.h+1:]) AS ts
  FROM h LEFT JOIN t b ON b.c = h.c - h.c % 100),
m AS (SELECT c, len(ts) AS n, d, ts[1:d] AS p, ts[1:greatest(d-1, 0)] AS q FROM r, unnest(range(0, len(ts) + 1)) AS z(d)),
n AS (
  SELECT p, q, d, min(c) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (n = d), '')) AS ends_sha256,
    CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * length(p[d].t) END AS own
  FROM m GROUP BY p, q, d),
k AS (SELECT q AS p, d - 1 AS d, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
f AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM n LEFT JOIN k ON k.p = n.p AND k.d = n.d),
s AS (
  SELECT a.p, a.d, count(*) FILTER (b.n_children = 0) AS n_leaves, sum(b.own)::BIGINT AS saved_tokens
  FROM f a JOIN f b ON b.d >= a.d AND b.p[1:a.d] = a.p GROUP BY a.p, a.d)
SELECT f.conv_id, f.d::BIGINT AS depth, u.conv_id AS parent_conv_id, f.n_convs::BIGINT AS n_convs,
  f.n_children::BIGINT AS n_children, s.n_leaves, s.saved_tokens, f.ends_sha256
FROM f JOIN s ON s.p = f.p AND s.d = f.d LEFT JOIN n u ON f.d > 0 AND u.d = f.d - 1 AND u.p = f.q
"""


@query("op12_prefix_trie", SQL)
def op12_prefix_trie(spark, sf_dir):
    return prefix_trie(rebuilt(table(spark, sf_dir, "conversations")))
