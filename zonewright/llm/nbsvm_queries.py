"""Query of the quality classifier."""

from __future__ import annotations

from zonewright.llm.nbsvm import quality_scores
from zonewright.llm.registry import query, table


@query("op7_quality_classifier")
def op7_quality_classifier(spark, sf_dir):
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
