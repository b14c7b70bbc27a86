"""All registered queries, gathered from the query modules."""

from __future__ import annotations

from zonewright.plans import (  # noqa: F401
    geometry_queries,
    indicator_queries,
    io_queries,
    manifest_queries,
    overlay_queries,
    product_queries,
    raster_queries,
    span_queries,
    structure_queries,
)
from zonewright.plans.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
