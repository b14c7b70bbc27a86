"""Polygon expressions over nested columns, as SQL text.

A geometry is array<polygon>, a polygon array<ring> (outer ring first, then
holes), a ring a closed array<struct<x,y>>. Every helper takes SQL expressions
and returns one, for ``F.expr`` or a SQL query alike: ``F.expr(area("geometry"))``.
Lambda bodies are interpreted per element, so a sub-expression needed more than
once is bound to a lambda variable (``bind``) instead of being repeated.
"""

from __future__ import annotations

RING = "array<struct<x:double,y:double>>"
GEOMETRY = f"array<array<{RING}>>"


def record(**fields: str) -> str:
    """A struct with the given field names."""
    return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")"


def vertex(x: str, y: str) -> str:
    return record(x=f"double({x})", y=f"double({y})")


def bind(value: str, name: str, body: str) -> str:
    """``body`` with ``value`` evaluated once and called ``name``."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def segments(ring: str) -> str:
    n = f"greatest(size({ring}) - 1, 0)"
    pair = record(x1="a.x", y1="a.y", x2="b.x", y2="b.y")
    return f"zip_with(slice({ring}, 1, {n}), slice({ring}, 2, {n}), (a, b) -> {pair})"


def map_vertices(geometry: str, x: str, y: str) -> str:
    """New coordinates for every vertex; ``x`` and ``y`` are written over ``v``."""
    return (
        f"transform({geometry}, poly -> transform(poly, ring -> "
        f"transform(ring, v -> {vertex(x, y)})))"
    )


def xs(geometry: str) -> str:
    return f"flatten(flatten({geometry})).x"


def ys(geometry: str) -> str:
    return f"flatten(flatten({geometry})).y"


def bounds(geometry: str) -> str:
    """struct<minx,miny,maxx,maxy>"""
    x, y = xs(geometry), ys(geometry)
    return record(
        minx=f"array_min({x})", miny=f"array_min({y})", maxx=f"array_max({x})", maxy=f"array_max({y})"
    )


def rectangle(minx: str, miny: str, maxx: str, maxy: str) -> str:
    corners = [(minx, miny), (maxx, miny), (maxx, maxy), (minx, maxy), (minx, miny)]
    return f"array(array(array({', '.join(vertex(x, y) for x, y in corners)})))"


_CROSS = "((e.x1 - o.x) * (e.y2 - o.y) - (e.x2 - o.x) * (e.y1 - o.y))"


def ring_area(ring: str) -> str:
    """Shoelace sum relative to the first vertex, which keeps the digits of small rings."""
    twice = f"aggregate({segments(ring)}, 0D, (t, e) -> t + {_CROSS})"
    return bind(f"get({ring}, 0)", "o", f"abs({twice}) / 2")


def area(geometry: str) -> str:
    """Outer rings less holes, in the units of the coordinates."""
    signed = f"if(i = 0, 1D, -1D) * {ring_area('ring')}"
    rings = f"flatten(transform({geometry}, poly -> transform(poly, (ring, i) -> {signed})))"
    return f"aggregate({rings}, 0D, (t, r) -> t + r)"


def centroid(geometry: str) -> str:
    """Area-weighted centroid as struct<x,y>; null for an empty or flat geometry."""
    zero = record(a="0D", mx="0D", my="0D")
    add = record(
        a=f"t.a + {_CROSS}",
        mx=f"t.mx + {_CROSS} * (e.x1 + e.x2 + o.x)",
        my=f"t.my + {_CROSS} * (e.y1 + e.y2 + o.y)",
    )
    # moments about the first vertex's triangles; the sign makes outer rings count up, holes down
    moments = bind("get(ring, 0)", "o", f"aggregate({segments('ring')}, {zero}, (t, e) -> {add})")
    sign = "signum(m.a) * if(i = 0, 1D, -1D)"
    signed = bind(moments, "m", record(a=f"m.a * {sign}", mx=f"m.mx * {sign}", my=f"m.my * {sign}"))
    rings = f"flatten(transform({geometry}, poly -> transform(poly, (ring, i) -> {signed})))"
    plus = record(a="t.a + r.a", mx="t.mx + r.mx", my="t.my + r.my")
    return bind(
        f"aggregate({rings}, {zero}, (t, r) -> {plus})",
        "w",
        f"if(w.a <> 0, {vertex('w.mx / (w.a * 3)', 'w.my / (w.a * 3)')}, null)",
    )


def edges(geometry: str) -> str:
    """All segments of all rings, each turned upward (y1 <= y2)."""
    upward = f"if(e.y1 <= e.y2, e, {record(x1='e.x2', y1='e.y2', x2='e.x1', y2='e.y1')})"
    rings = f"transform(poly, ring -> transform({segments('ring')}, e -> {upward}))"
    return f"flatten(flatten(transform({geometry}, poly -> {rings})))"


def _turn(e: str, x: str, y: str) -> str:
    return f"(({e}.x2 - {e}.x1) * ({y} - {e}.y1) - ({x} - {e}.x1) * ({e}.y2 - {e}.y1))"


def covers(edge_list: str, x: str, y: str) -> str:
    """Point in polygon over upward edges; a point on the boundary is inside.

    ``x`` and ``y`` must not name ``hit`` or ``edge``. The fold keeps 0 (outside so
    far), 1 (inside so far) or 2 (on an edge).
    """
    step = (
        f"CASE WHEN hit = 2 OR {y} < edge.y1 OR {y} > edge.y2 THEN hit"
        f" WHEN {_turn('edge', x, y)} = 0 AND {x} >= least(edge.x1, edge.x2) AND {x} <= greatest(edge.x1, edge.x2) THEN 2"
        f" WHEN {y} < edge.y2 AND {_turn('edge', x, y)} > 0 THEN 1 - hit ELSE hit END"
    )
    return f"(aggregate({edge_list}, 0, (hit, edge) -> {step}) > 0)"


def intersects(geometry_a: str, edges_a: str, geometry_b: str, edges_b: str) -> str:
    """True when the two geometries share at least one point.

    Either two edges meet, or one polygon of a side lies wholly in the other
    side, in which case its first vertex does.
    """
    meet = (
        "p.y1 <= q.y2 AND q.y1 <= p.y2"
        " AND least(p.x1, p.x2) <= greatest(q.x1, q.x2) AND least(q.x1, q.x2) <= greatest(p.x1, p.x2)"
        f" AND {_turn('q', 'p.x1', 'p.y1')} * {_turn('q', 'p.x2', 'p.y2')} <= 0"
        f" AND {_turn('p', 'q.x1', 'q.y1')} * {_turn('p', 'q.x2', 'q.y2')} <= 0"
    )

    def start_inside(geometry: str, edge_list: str) -> str:
        first = "get(get(poly, 0), 0)"
        return f"exists({geometry}, poly -> {covers(edge_list, f'{first}.x', f'{first}.y')})"

    return (
        f"(exists({edges_a}, p -> exists({edges_b}, q -> {meet}))"
        f" OR {start_inside(geometry_a, edges_b)} OR {start_inside(geometry_b, edges_a)})"
    )


def clip(geometry: str, minx: str, miny: str, maxx: str, maxy: str) -> str:
    """Intersection with an axis-parallel box; polygons without a rest are dropped.

    A ring is folded over the four half-planes nx*x + ny*y >= d; each step keeps
    the inner vertices and cuts the edges that cross (Sutherland-Hodgman).
    """

    def plane(nx: int, ny: int, d: str) -> str:
        return record(nx=f"{nx}D", ny=f"{ny}D", d=f"double({d})")

    planes = (
        f"array({plane(1, 0, minx)}, {plane(-1, 0, f'-({maxx})')}, "
        f"{plane(0, 1, miny)}, {plane(0, -1, f'-({maxy})')})"
    )
    n = "greatest(size(r) - 1, 0)"
    sides = record(
        a="a", b="b", da="h.nx * a.x + h.ny * a.y - h.d", db="h.nx * b.x + h.ny * b.y - h.d"
    )
    signed = f"zip_with(slice(r, 1, {n}), slice(r, 2, {n}), (a, b) -> {sides})"
    cut = vertex(
        "if(h.nx <> 0, h.d * h.nx, s.a.x + s.da / (s.da - s.db) * (s.b.x - s.a.x))",
        "if(h.ny <> 0, h.d * h.ny, s.a.y + s.da / (s.da - s.db) * (s.b.y - s.a.y))",
    )
    kept = (
        f"flatten(transform({signed}, s -> CASE WHEN s.da >= 0 AND s.db >= 0 THEN array(s.a)"
        f" WHEN s.da >= 0 THEN array(s.a, {cut}) WHEN s.db >= 0 THEN array({cut})"
        f" ELSE cast(array() AS {RING}) END))"
    )
    closed = bind(kept, "k", "concat(k, slice(k, 1, 1))")
    ring = f"aggregate(planes, ring, (r, h) -> {closed})"
    cut_all = f"transform({geometry}, poly -> transform(poly, ring -> {ring}))"
    whole = f"filter({bind(planes, 'planes', cut_all)}, poly -> size(get(poly, 0)) > 0)"
    return f"transform({whole}, poly -> filter(poly, ring -> size(ring) > 0))"


def box_overlap_area(geometry: str, minx: str, miny: str, maxx: str, maxy: str) -> str:
    """Area of geometry and box without building the intersection.

    The area left of an edge, cut to the box, is an integral over y of the edge's
    x clamped to the box; the clamped mean has a closed form. One pass, no new
    vertices.
    """

    def primitive(x: str) -> str:
        width = "(w.maxx - w.minx)"
        return (
            f"CASE WHEN {x} <= w.minx THEN 0D"
            f" WHEN {x} >= w.maxx THEN {width} * ({x} - w.minx) - {width} * {width} / 2"
            f" ELSE ({x} - w.minx) * ({x} - w.minx) / 2 END"
        )

    low, high = "greatest(least(e.y1, e.y2), w.miny)", "least(greatest(e.y1, e.y2), w.maxy)"
    slope = "(e.x2 - e.x1) / (e.y2 - e.y1)"
    mean = bind(
        record(p=f"e.x1 + ({low} - e.y1) * {slope}", q=f"e.x1 + ({high} - e.y1) * {slope}"),
        "s",
        "if(abs(s.p - s.q) < 1e-9D * greatest(abs(s.p), 1D), greatest(least(s.p, w.maxx), w.minx) - w.minx,"
        f" ({primitive('s.q')} - {primitive('s.p')}) / (s.q - s.p))",
    )
    left = (
        f"if(e.y1 <> e.y2 AND {high} > {low},"
        f" signum(e.y2 - e.y1) * ({high} - {low}) * {mean}, 0D)"
    )
    ring = f"abs(aggregate(transform({segments('ring')}, e -> {left}), 0D, (t, v) -> t + v))"
    rings = (
        f"flatten(transform({geometry}, poly -> "
        f"transform(poly, (ring, i) -> if(i = 0, 1D, -1D) * {ring})))"
    )
    total = f"aggregate({rings}, 0D, (t, v) -> t + v)"
    return bind(record(minx=minx, miny=miny, maxx=maxx, maxy=maxy), "w", total)


def to_wkt(geometry: str) -> str:
    """POLYGON text for one polygon, MULTIPOLYGON otherwise."""
    position = "concat(string(v.x), ' ', string(v.y))"
    ring = f"concat('(', array_join(transform(ring, v -> {position}), ', '), ')')"
    polygon = f"concat('(', array_join(transform(poly, ring -> {ring}), ', '), ')')"
    return bind(
        f"transform({geometry}, poly -> {polygon})",
        "texts",
        "if(size(texts) = 1, concat('POLYGON ', get(texts, 0)),"
        " concat('MULTIPOLYGON (', array_join(texts, ', '), ')'))",
    )


def from_wkt(text: str) -> str:
    """Parse POLYGON / MULTIPOLYGON text; other kinds give null."""
    point = bind("split(trim(pair), ' ')", "c", vertex("c[0]", "c[1]"))
    ring = f"transform(split(one, ','), pair -> {point})"
    rings = f"transform(regexp_extract_all(poly, r'\\(([^()]+)\\)', 1), one -> {ring})"
    polygons = (
        r"if(body LIKE 'MULTIPOLYGON%', regexp_extract_all(body, r'\((?: ?\([^()]+\) ?,?)+ ?\)', 0), array(body))"
    )
    parsed = f"if(body LIKE '%POLYGON%', transform({polygons}, poly -> {rings}), null)"
    return bind(f"regexp_replace(upper({text}), r'\\s+', ' ')", "body", parsed)
