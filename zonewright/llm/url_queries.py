"""Query of the URL filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from zonewright.llm.registry import query, table
from zonewright.llm.url_rules import filter_urls

# The rules of the query.
RULES = [
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
]


@query("op2_url_rules")
def op2_url_rules(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    # the number in a page's path names the document that the labels speak of
    number = F.regexp_extract("url", r"^[^?#]*/(\d{1,18})", 1)
    numbered = pages.withColumn("_n", number).select(
        F.col("page_id").alias("_labelled"), F.expr("try_cast(_n AS bigint)").alias("doc_id")
    )
    labels = numbered.join(table(spark, sf_dir, "labels"), "doc_id")
    bad = labels.select("_labelled", (F.col("quality") == 0).alias("bad"))
    return filter_urls(pages, bad, RULES).select("page_id", "host", "path", "rule", "verdict")
