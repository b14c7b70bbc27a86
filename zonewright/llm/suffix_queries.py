"""Query of the suffix-array removal of repeats."""

from __future__ import annotations

from pyspark.sql import functions as F

from zonewright.llm.registry import query, table
from zonewright.llm.suffix_dedup import remove_repeats


@query("op8_suffix_dedup")
def op8_suffix_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256")
    )
