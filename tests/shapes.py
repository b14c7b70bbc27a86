"""Plain Python geometry: what the Spark operators are compared with."""

from __future__ import annotations

from zonewright.functions.geometry import GEOMETRY


def ring(*points):
    return [{"x": float(x), "y": float(y)} for x, y in [*points, points[0]]]


def box(x0, y0, x1, y1):
    return ring((x0, y0), (x1, y0), (x1, y1), (x0, y1))


def zones(spark, shapes: dict, key: str = "zone_id"):
    """shapes: id -> list of polygons, each a list of rings."""
    return spark.createDataFrame(list(shapes.items()), f"{key} bigint, geometry {GEOMETRY}")


def _edges(geometry):
    for polygon in geometry:
        for r in polygon:
            for a, b in zip(r, r[1:]):
                yield a["x"], a["y"], b["x"], b["y"]


def covers(geometry, x, y) -> bool:
    inside = False
    for x1, y1, x2, y2 in _edges(geometry):
        turn = (x2 - x1) * (y - y1) - (x - x1) * (y2 - y1)
        if turn == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
            return True
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            inside = not inside
    return inside


def _meet(a, b) -> bool:
    def turn(e, x, y):
        return (e[2] - e[0]) * (y - e[1]) - (x - e[0]) * (e[3] - e[1])

    if max(a[0], a[2]) < min(b[0], b[2]) or max(b[0], b[2]) < min(a[0], a[2]):
        return False
    if max(a[1], a[3]) < min(b[1], b[3]) or max(b[1], b[3]) < min(a[1], a[3]):
        return False
    return (
        turn(b, a[0], a[1]) * turn(b, a[2], a[3]) <= 0 and turn(a, b[0], b[1]) * turn(a, b[2], b[3]) <= 0
    )


def intersects(a, b) -> bool:
    if any(_meet(e, f) for e in _edges(a) for f in _edges(b)):
        return True
    first_a, first_b = a[0][0][0], b[0][0][0]
    return covers(b, first_a["x"], first_a["y"]) or covers(a, first_b["x"], first_b["y"])
