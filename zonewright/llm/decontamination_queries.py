"""Query of benchmark decontamination."""

from __future__ import annotations

from zonewright.llm.decontamination import contaminated, split_items
from zonewright.llm.registry import query, table


@query("op1_decontamination")
def op1_decontamination(spark, sf_dir):
    items = split_items(table(spark, sf_dir, "benchmark"))
    return contaminated(table(spark, sf_dir, "documents"), items)
