"""Query of preference formatting, with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from zonewright.llm.preferences import echo_negatives, format_preferences
from zonewright.llm.registry import query, table

SQL = """
WITH t AS (
  SELECT conv_id, role, text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS i,
    lag(text) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before FROM conversations),
l AS (SELECT conv_id, max(i) AS last FROM t WHERE role = 'assistant' GROUP BY conv_id),
s AS (
  SELECT t.conv_id, i, role, text AS c, CASE WHEN i = last THEN before ELSE text END AS r, last
  FROM t JOIN l USING (conv_id) WHERE i <= last),
p AS (
  SELECT conv_id, last, CASE WHEN bool_and(c IS NOT DISTINCT FROM r) THEN last ELSE last - 1 END AS k
  FROM s GROUP BY conv_id, last),
x AS (
  SELECT s.conv_id, i, k, role,
    '<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(c, '') || '<|im_end|>' || chr(10) AS c,
    '<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(r, '') || '<|im_end|>' || chr(10) AS r
  FROM s JOIN p USING (conv_id)),
d AS (
  SELECT conv_id AS pair_id, k::INTEGER AS prompt_turns,
    coalesce(string_agg(c, '' ORDER BY i) FILTER (i <= k), '') AS prompt,
    coalesce(string_agg(c, '' ORDER BY i) FILTER (i > k), '') AS chosen,
    coalesce(string_agg(r, '' ORDER BY i) FILTER (i > k), '') AS rejected
  FROM x GROUP BY conv_id, k)
SELECT *, CASE WHEN chosen = '' THEN '' ELSE '0-' || length(chosen) END AS chosen_mask,
  CASE WHEN rejected = '' THEN '' ELSE '0-' || length(rejected) END AS rejected_mask
FROM d
"""


def _plain(mask: str):
    joined = f"array_join(transform({mask}, s -> concat(s.start, '-', s.end)), ',')"
    return F.expr(joined).alias(mask)


@query("op9_preferences", SQL)
def op9_preferences(spark, sf_dir):
    sides = echo_negatives(table(spark, sf_dir, "conversations"))
    return format_preferences(*sides).select(
        "pair_id", "prompt_turns", "prompt", "chosen", "rejected", _plain("chosen_mask"), _plain("rejected_mask")
    )
