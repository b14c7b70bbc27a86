"""Query of a product that is written in several runs, with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from zonewright.operators import joins, products
from zonewright.plans import inputs
from zonewright.plans.inputs import tables_sql
from zonewright.plans.registry import query
from zonewright.session import scratch_path
from zonewright.sources import manifest

YEARS = list(range(1993, 1999))
KEY = "sum-mangrove-area"


@query(
    "resumed_documents",
    tables_sql("product_values")
    + """, w AS (SELECT s_suppkey AS zone_id, CAST(y.year AS INT) AS year FROM supplier
     CROSS JOIN (SELECT UNNEST(generate_series(1993,1998)) AS year) y),
    v AS (SELECT w.zone_id, w.year, COALESCE(p.value,0e0) AS value FROM w LEFT JOIN product_values p
     ON p.zone_id=w.zone_id AND p.year=w.year AND p.indicator='sum-mangrove-area')
    SELECT CAST(zone_id AS VARCHAR) AS zone, year||'-01-01T00:00:00Z' AS time,
     CASE WHEN year=1994 THEN 'run-3' WHEN zone_id%2=0 AND year<1996 THEN 'run-1' ELSE 'run-2' END AS run_id,
     CASE WHEN year=1994 THEN -value ELSE value END AS value,
     'sum-mangrove-area/'||year||'/mangrove-'||zone_id||'.json' AS path FROM v""",
)
def resumed_documents(spark, sf_dir):
    """Run 1 breaks off after some zones and years, run 2 does what is pending, run 3 renews a year."""
    root = scratch_path(spark, "product")
    found = inputs.product_values(spark, sf_dir).filter(F.col("indicator") == KEY)
    work = joins.work_list(inputs.zones(spark, sf_dir), YEARS)

    def documents(rows, run: str, sign: int = 1):
        valued = rows.select("zone_id", "year").join(
            found.select("zone_id", "year", "value"), ["zone_id", "year"], "left"
        )
        value = F.coalesce(F.col("value"), F.lit(0.0)) * F.lit(float(sign))
        results = valued.select("zone_id", "year", F.create_map(F.lit(KEY), value).alias("indicators"))
        return products.product_outputs(results, "mangrove", run, "s3://zones", "s3://data", "process")

    def write(rows, number: int, overwrite: bool = False, sign: int = 1):
        made = documents(rows, f"run-{number}", sign)
        year = F.substring("timePoint", 1, 4)
        manifest.write_documents(made, root, [KEY], number, overwrite, time=year)

    write(work.filter("zone_id % 2 = 0 AND year < 1996"), 1)
    write(manifest.pending_documents(spark, work, root, "mangrove", [KEY]), 2)
    # what exists stays when it is given again without overwriting
    write(work.filter("year = 1995"), 3)
    write(work.filter("year = 1994"), 3, overwrite=True, sign=-1)
    return manifest.read_documents(spark, root).select(
        F.col("geometryOutputId").alias("zone"),
        F.col("timePoint").alias("time"),
        F.col("productRunId").alias("run_id"),
        F.col("indicators")[KEY].alias("value"),
        "path",
    )
