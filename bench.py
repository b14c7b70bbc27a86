"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (local cores), BENCH_RUNS (runs per query).
Each query is written to a no-op sink, so every result row is computed; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from zonewright.plans.catalog import QUERIES
from zonewright.session import local_session

HEADLINE = [
    "sum_area_raster",
    "compute_indicators",
    "zonal_mean",
    "pixels_in_zones",
    "spatial_join_points",
    "spatial_join_points_shuffled",
    "spatial_join_polygons",
    "sum_area_vector",
    "sum_area_vector_clipped",
    "count_in_zones",
    "tile_zones",
    "mosaic",
    "regrid",
    "chunks_to_pixels",
    "polygonize_runs",
    "tile_pyramid",
    "batches",
    "outputs_by_indicator",
    "compare_versions",
    "top_series",
    "sum_area_spans",
    "sum_area_spans_shuffled",
    "spatial_join_polygons_shuffled",
    "meeting_pairs_shuffled",
    "meeting_pairs_detailed",
    "sum_area_overlap",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["with_area_m2"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm up
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "master": spark.sparkContext.master,
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
