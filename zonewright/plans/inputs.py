"""Zones, points, features, pixels and scenes derived from the given tables.

The given tables hold no geometry, so coordinates are computed from their keys.
Points and features sit half a step off the zone vertices: none lies exactly on
a zone edge. ``tables_sql`` states the same derivation as plain SQL for the check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from zonewright.functions import geometry as g

# Zone outline in steps: an L with a hole, and a triangle. (part, ring, seq, dx, dy)
OUTLINE = [
    (0, 0, [(0, 0), (12, 0), (12, 4), (4, 4), (4, 12), (0, 12), (0, 0)]),
    (0, 1, [(1, 1), (3, 1), (3, 3), (1, 3), (1, 1)]),
    (1, 0, [(14, 14), (18, 14), (16, 18), (14, 14)]),
]
PIXEL_M = 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One two-part zone per supplier; every tenth is full size and above the tiling limit."""
    key = F.col("s_suppkey")
    ox = F.lit(-50.0) + (key * 37 % 400) * 0.25
    oy = F.lit(-50.0) + (key * 151 % 400) * 0.25
    step = F.when(key % 10 == 0, 1.0).otherwise((key % 5 + 1) * 0.05)

    def ring(points: list[tuple[int, int]]) -> str:
        corners = (g.vertex(f"ox + step * {dx}D", f"oy + step * {dy}D") for dx, dy in points)
        return f"array({', '.join(corners)})"

    rings = {(part, r): ring(points) for part, r, points in OUTLINE}
    geometry = F.expr(f"array(array({rings[0, 0]}, {rings[0, 1]}), array({rings[1, 0]}))")
    return (
        table(spark, sf_dir, "supplier")
        .select(
            key.alias("zone_id"),
            F.col("s_name").alias("zone_name"),
            F.col("s_nationkey").alias("nation"),
            F.col("s_acctbal").alias("balance"),
            ox.alias("ox"),
            oy.alias("oy"),
            step.alias("step"),
        )
        .select("zone_id", "zone_name", "nation", "balance", geometry.alias("geometry"))
    )


def _spread(key: Column, factor: int) -> Column:
    return F.lit(-50.0) + ((key * factor) % 100000 + 0.5) / 1000.0


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        key.alias("point_id"),
        F.col("event_type").alias("class"),
        "ts",
        _spread(key, 7919).alias("lon"),
        _spread(key, 104729).alias("lat"),
    )


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One diamond per part, 0.01 to 0.5 degrees half-width."""
    key = F.col("p_partkey")
    tips = [
        ("lon - half", "lat"),
        ("lon", "lat - half"),
        ("lon + half", "lat"),
        ("lon", "lat + half"),
        ("lon - half", "lat"),
    ]
    ring = f"array({', '.join(g.vertex(x, y) for x, y in tips)})"
    return (
        table(spark, sf_dir, "part")
        .select(
            key.alias("feature_id"),
            F.col("p_type").alias("class"),
            _spread(key, 7919).alias("lon"),
            _spread(key, 104729).alias("lat"),
            (F.col("p_size") * 0.01 + 0.0001).alias("half"),
        )
        .select("feature_id", "class", F.expr(f"array(array({ring}))").alias("geometry"))
    )


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One cell of a 200 x 200 grid of 50 km cells per order, value 0..5."""
    key = F.col("o_orderkey")
    return (
        table(spark, sf_dir, "orders")
        .select(
            key.alias("pixel_id"),
            (key % 200).alias("ix"),
            (F.floor(key / 200) * 77 % 200).alias("iy"),
            F.year("o_orderdate").alias("yr"),
            (F.floor(key / 3) % 6).cast("double").alias("value"),
        )
        .withColumns(
            {
                "x": (F.col("ix") - 100 + 0.5) * float(PIXEL_M),
                "y": (F.col("iy") - 100 + 0.5) * float(PIXEL_M),
            }
        )
    )


def scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scene per 40 x 40 block and year, bounds in metres."""
    block = 40 * PIXEL_M
    col, row = F.floor(F.col("ix") / 40), F.floor(F.col("iy") / 40)
    return (
        pixels(spark, sf_dir)
        .groupBy(col.alias("bx"), row.alias("by"), "yr")
        .agg(F.count("*").alias("n_pixels"))
        .select(
            F.concat_ws("_", F.lit("tile"), "bx", "by", F.concat(F.col("yr"), F.lit("_v3.tif"))).alias(
                "scene_id"
            ),
            F.when(F.col("bx") % 2 == 0, "even").otherwise("odd").alias("collection"),
            "yr",
            "n_pixels",
            ((F.col("bx") - 2.5) * float(block)).alias("minx"),
            ((F.col("by") - 2.5) * float(block)).alias("miny"),
            ((F.col("bx") - 1.5) * float(block)).alias("maxx"),
            ((F.col("by") - 1.5) * float(block)).alias("maxy"),
            F.make_timestamp_ntz("yr", F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)).alias(
                "start_datetime"
            ),
            F.make_timestamp_ntz("yr", F.lit(12), F.lit(31), F.lit(0), F.lit(0), F.lit(0)).alias(
                "end_datetime"
            ),
            F.create_map(
                F.lit("asset"), F.struct(F.concat(F.lit("s3://scenes/"), "bx").alias("href"))
            ).alias("assets"),
        )
    )


def product_values(spark: SparkSession, sf_dir: str, discounted: bool = False) -> DataFrame:
    """Finished values per zone, year and indicator: ordered value per supplier.

    The discounted version covers closed lines only, so some zones are missing.
    """
    lines = table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    if discounted:
        lines = lines.filter(F.col("l_linestatus") == "F")
        price = price * (F.lit(1).cast("decimal(18,2)") - F.col("l_discount").cast("decimal(18,2)"))
    indicator = (
        F.when(F.col("l_returnflag") == "A", "sum-mangrove-area")
        .when(F.col("l_returnflag") == "N", "sum-seagrass-area")
        .otherwise("sum-reef-area")
    )
    names = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("zone_id"), F.col("s_name").alias("zone_name")
    )
    return (
        lines.groupBy(
            F.col("l_suppkey").alias("zone_id"),
            F.year("l_shipdate").alias("year"),
            indicator.alias("indicator"),
        )
        .agg(F.sum(price).cast("double").alias("value"))
        .join(names, "zone_id")
    )


_OUTLINE_VALUES = ", ".join(
    f"({part},{r},{seq},{dx}e0,{dy}e0)"
    for part, r, ring in OUTLINE
    for seq, (dx, dy) in enumerate(ring)
)

_SQL = {
    "zone_base": """SELECT s_suppkey AS zone_id, s_name AS zone_name, s_nationkey AS nation,
  -50e0 + (s_suppkey*37%400)*0.25e0 AS ox, -50e0 + (s_suppkey*151%400)*0.25e0 AS oy,
  CASE WHEN s_suppkey%10=0 THEN 1e0 ELSE (s_suppkey%5+1)*0.05e0 END AS step FROM supplier""",
    "zone_vertices": f"""SELECT z.zone_id, z.zone_name, v.part, v.ring, v.seq,
  z.ox+z.step*v.dx AS lon, z.oy+z.step*v.dy AS lat
  FROM zone_base z CROSS JOIN (VALUES {_OUTLINE_VALUES}) AS v(part,ring,seq,dx,dy)""",
    "zone_m": """SELECT *, 6378137e0*0.8667510025721987e0*RADIANS(lon) AS x,
  6378137e0*(1e0-0.0066943799901413165e0)*(s/(1e0-0.0066943799901413165e0*s*s)
   - (1e0/(2e0*0.08181919084262149e0))*LN((1e0-0.08181919084262149e0*s)/(1e0+0.08181919084262149e0*s)))
   /(2e0*0.8667510025721987e0) AS y
  FROM (SELECT *, SIN(RADIANS(lat)) AS s FROM zone_vertices)""",
    "zone_edges": """SELECT a.zone_id, a.part, a.ring, a.seq, a.lon AS lon1, a.lat AS lat1,
  b.lon AS lon2, b.lat AS lat2, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2
  FROM zone_m a JOIN zone_m b ON a.zone_id=b.zone_id AND a.part=b.part AND a.ring=b.ring AND b.seq=a.seq+1""",
    "part_area": """SELECT zone_id, part, SUM(CASE WHEN ring=0 THEN ar ELSE -ar END) AS area_m2 FROM (
  SELECT e.zone_id, e.part, e.ring, ABS(SUM((e.x1-o.x)*(e.y2-o.y)-(e.x2-o.x)*(e.y1-o.y)))/2e0 AS ar
  FROM zone_edges e JOIN zone_m o ON o.zone_id=e.zone_id AND o.part=e.part AND o.ring=0 AND o.seq=0
  GROUP BY 1,2,3) GROUP BY 1,2""",
    "points": """SELECT event_id AS point_id, event_type AS class, ts,
  -50e0+(((event_id*7919)%100000)+0.5e0)/1000e0 AS lon,
  -50e0+(((event_id*104729)%100000)+0.5e0)/1000e0 AS lat FROM events""",
    "point_hits": """SELECT p.point_id, e.zone_id, e.part FROM points p JOIN zone_edges e
  ON (e.lat1>p.lat) <> (e.lat2>p.lat) AND p.lon < (e.lon2-e.lon1)*(p.lat-e.lat1)/(e.lat2-e.lat1)+e.lon1
  GROUP BY 1,2,3 HAVING COUNT(*)%2=1""",
    "feature_base": """SELECT p_partkey AS feature_id, p_type AS class,
  -50e0+(((p_partkey*7919)%100000)+0.5e0)/1000e0 AS lon,
  -50e0+(((p_partkey*104729)%100000)+0.5e0)/1000e0 AS lat, p_size*0.01e0+0.0001e0 AS half FROM part""",
    "feature_vertices": """SELECT f.feature_id, f.class, v.seq, f.lon+v.dx*f.half AS lon, f.lat+v.dy*f.half AS lat
  FROM feature_base f CROSS JOIN (VALUES (0,-1e0,0e0),(1,0e0,-1e0),(2,1e0,0e0),(3,0e0,1e0),(4,-1e0,0e0)) AS v(seq,dx,dy)""",
    "feature_m": """SELECT *, 6378137e0*0.8667510025721987e0*RADIANS(lon) AS x,
  6378137e0*(1e0-0.0066943799901413165e0)*(s/(1e0-0.0066943799901413165e0*s*s)
   - (1e0/(2e0*0.08181919084262149e0))*LN((1e0-0.08181919084262149e0*s)/(1e0+0.08181919084262149e0*s)))
   /(2e0*0.8667510025721987e0) AS y
  FROM (SELECT *, SIN(RADIANS(lat)) AS s FROM feature_vertices)""",
    "feature_edges": """SELECT a.feature_id, a.lon AS lon1, a.lat AS lat1, b.lon AS lon2, b.lat AS lat2,
  a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2
  FROM feature_m a JOIN feature_m b ON a.feature_id=b.feature_id AND b.seq=a.seq+1""",
    "feature_area": """SELECT e.feature_id, ABS(SUM((e.x1-o.x)*(e.y2-o.y)-(e.x2-o.x)*(e.y1-o.y)))/2e0 AS area_m2
  FROM feature_edges e JOIN feature_m o ON o.feature_id=e.feature_id AND o.seq=0 GROUP BY 1""",
    # polygons meet: two edges cross, or one starts inside the other
    "feature_hits": """SELECT f.feature_id, z.zone_id, z.part FROM feature_edges f JOIN zone_edges z
  ON LEAST(f.lon1,f.lon2)<=GREATEST(z.lon1,z.lon2) AND LEAST(z.lon1,z.lon2)<=GREATEST(f.lon1,f.lon2)
  AND LEAST(f.lat1,f.lat2)<=GREATEST(z.lat1,z.lat2) AND LEAST(z.lat1,z.lat2)<=GREATEST(f.lat1,f.lat2)
  WHERE (((f.lon2-f.lon1)*(z.lat1-f.lat1)-(z.lon1-f.lon1)*(f.lat2-f.lat1))
   *((f.lon2-f.lon1)*(z.lat2-f.lat1)-(z.lon2-f.lon1)*(f.lat2-f.lat1)))<0
  AND (((z.lon2-z.lon1)*(f.lat1-z.lat1)-(f.lon1-z.lon1)*(z.lat2-z.lat1))
   *((z.lon2-z.lon1)*(f.lat2-z.lat1)-(f.lon2-z.lon1)*(z.lat2-z.lat1)))<0
  UNION
  SELECT v.feature_id, e.zone_id, e.part FROM (SELECT * FROM feature_vertices WHERE seq=0) v JOIN zone_edges e
  ON (e.lat1>v.lat) <> (e.lat2>v.lat) AND v.lon < (e.lon2-e.lon1)*(v.lat-e.lat1)/(e.lat2-e.lat1)+e.lon1
  GROUP BY 1,2,3 HAVING COUNT(*)%2=1
  UNION
  SELECT e.feature_id, v.zone_id, v.part FROM (SELECT * FROM zone_vertices WHERE seq=0 AND ring=0) v JOIN feature_edges e
  ON (e.lat1>v.lat) <> (e.lat2>v.lat) AND v.lon < (e.lon2-e.lon1)*(v.lat-e.lat1)/(e.lat2-e.lat1)+e.lon1
  GROUP BY 1,2,3 HAVING COUNT(*)%2=1""",
    "pixels": """SELECT *, (ix-100+0.5e0)*50000e0 AS x, (iy-100+0.5e0)*50000e0 AS y FROM (
  SELECT o_orderkey AS pixel_id, o_orderkey%200 AS ix, CAST(FLOOR(o_orderkey/200)*77 AS BIGINT)%200 AS iy,
  YEAR(o_orderdate) AS yr, CAST(CAST(FLOOR(o_orderkey/3) AS BIGINT)%6 AS DOUBLE) AS value FROM orders)""",
    "mosaic": """SELECT * FROM pixels
  QUALIFY ROW_NUMBER() OVER (PARTITION BY ix, iy, yr ORDER BY pixel_id)=1""",
    "pixel_hits": """SELECT p.pixel_id, p.ix, p.iy, p.yr, p.value, e.zone_id, e.part FROM mosaic p JOIN zone_edges e
  ON (e.y1>p.y) <> (e.y2>p.y) AND p.x < (e.x2-e.x1)*(p.y-e.y1)/(e.y2-e.y1)+e.x1
  GROUP BY ALL HAVING COUNT(*)%2=1""",
    "scenes": """SELECT 'tile_' || bx || '_' || "by" || '_' || yr || '_v3.tif' AS scene_id,
  CASE WHEN bx%2=0 THEN 'even' ELSE 'odd' END AS collection, yr, n_pixels,
  (bx-2.5e0)*2000000e0 AS minx, ("by"-2.5e0)*2000000e0 AS miny, (bx-1.5e0)*2000000e0 AS maxx, ("by"-1.5e0)*2000000e0 AS maxy, bx
  FROM (SELECT CAST(FLOOR(ix/40) AS BIGINT) AS bx, CAST(FLOOR(iy/40) AS BIGINT) AS "by", yr, COUNT(*) AS n_pixels
  FROM pixels GROUP BY 1,2,3)""",
    "product_values": """SELECT l.l_suppkey AS zone_id, s.s_name AS zone_name, YEAR(l.l_shipdate) AS year,
  CASE l.l_returnflag WHEN 'A' THEN 'sum-mangrove-area' WHEN 'N' THEN 'sum-seagrass-area' ELSE 'sum-reef-area' END AS indicator,
  CAST(SUM(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS value
  FROM lineitem l JOIN supplier s ON s.s_suppkey=l.l_suppkey GROUP BY 1,2,3,4""",
    "product_values_2": """SELECT l.l_suppkey AS zone_id, s.s_name AS zone_name, YEAR(l.l_shipdate) AS year,
  CASE l.l_returnflag WHEN 'A' THEN 'sum-mangrove-area' WHEN 'N' THEN 'sum-seagrass-area' ELSE 'sum-reef-area' END AS indicator,
  CAST(SUM(CAST(l.l_extendedprice AS DECIMAL(18,2))*(CAST(1 AS DECIMAL(18,2))-CAST(l.l_discount AS DECIMAL(18,2)))) AS DOUBLE) AS value
  FROM lineitem l JOIN supplier s ON s.s_suppkey=l.l_suppkey WHERE l.l_linestatus='F' GROUP BY 1,2,3,4""",
}


def tables_sql(*names: str) -> str:
    """``WITH`` clause holding the named derived tables and what they build on."""
    import re

    needed: set[str] = set()

    def need(name: str) -> None:
        if name in needed:
            return
        for other in _SQL:
            if other != name and re.search(rf"\b{other}\b", _SQL[name]):
                need(other)
        needed.add(name)

    for name in names:
        need(name)
    return "WITH " + ",\n".join(f"{n} AS ({_SQL[n]})" for n in _SQL if n in needed) + "\n"
