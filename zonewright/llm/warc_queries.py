"""Query of the WARC writer and reader, with its SQL."""

from __future__ import annotations

from zonewright.llm.registry import query, table
from zonewright.llm.warc import read_warc, write_warc

SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
    sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
  CASE WHEN f.first < p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN f.first < p.page_id THEN f.first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""


@query("op10_warc", SQL)
def op10_warc(spark, sf_dir):
    listing = write_warc(table(spark, sf_dir, "pages"))
    return read_warc(listing).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
