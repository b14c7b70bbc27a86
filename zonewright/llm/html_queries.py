"""Query of the main text of pages."""

from __future__ import annotations

from zonewright.llm.html_wrapper import extract_main_text
from zonewright.llm.registry import query, table


@query("op13_html_extraction")
def op13_html_extraction(spark, sf_dir):
    return extract_main_text(table(spark, sf_dir, "pages"))
