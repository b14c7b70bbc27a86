"""Query of the n-gram Jaccard join."""

from __future__ import annotations

from zonewright.llm.jaccard_join import jaccard_components
from zonewright.llm.registry import query, table


@query("op6_jaccard_join")
def op6_jaccard_join(spark, sf_dir):
    return jaccard_components(table(spark, sf_dir, "documents"))
