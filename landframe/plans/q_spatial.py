"""Registered spatial queries (G*): lineitem rows as points against a small polygon layer.

Points: x = ``l_quantity``, y = ``l_suppkey``.  The layer below has a concave polygon,
an overlapping pair, a polygon with a hole and shared edges/vertices, so boundary,
notch, hole and overlap cases all occur on integer coordinates.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from landframe.operators import spatial as G
from landframe.plans.registry import register
from landframe.plans.tables import table

# The test polygon layer (poly_id, name, rings); rings are closed when loaded.
POLYGONS = [
    (1, "square", [[(0, 0), (20, 0), (20, 40), (0, 40)]]),
    (2, "notched", [[(25, 0), (45, 0), (45, 40), (40, 40), (40, 10), (30, 10), (30, 40), (25, 40)]]),
    (3, "triangle", [[(10, 20), (30, 60), (5, 60)]]),
    (4, "holed", [[(0, 70), (50, 70), (50, 110), (0, 110)], [(20, 80), (30, 80), (30, 100), (20, 100)]]),
    (5, "diamond", [[(35, 45), (50, 55), (35, 65), (20, 55)]]),
]


def polygons(spark):
    return G.polygon_layer(spark, POLYGONS, T.StructType([T.StructField("name", T.StringType())]))


def _edges_sql() -> str:
    rows = []
    for pid, _name, rings in POLYGONS:
        for ri, ring in enumerate(rings):
            closed = list(ring) + [ring[0]]
            for a, b in zip(closed, closed[1:]):
                rows.append(f"({pid}, {ri}, {float(a[0])}, {float(a[1])}, {float(b[0])}, {float(b[1])})")
    return ",\n    ".join(rows)


def _names_sql() -> str:
    return ", ".join(f"({pid}, '{name}')" for pid, name, _ in POLYGONS)


_HITS_SQL = f"""
edges(poly_id, ring_id, x1, y1, x2, y2) AS (VALUES
    {_edges_sql()}),
pts AS (SELECT DISTINCT CAST(l_quantity AS DOUBLE) AS px, CAST(l_suppkey AS DOUBLE) AS py FROM lineitem),
hits AS (
  SELECT px, py, poly_id FROM pts, edges
  GROUP BY px, py, poly_id
  HAVING bool_or((px - x1) * (y2 - y1) - (py - y1) * (x2 - x1) = 0
                 AND px BETWEEN least(x1, x2) AND greatest(x1, x2)
                 AND py BETWEEN least(y1, y2) AND greatest(y1, y2))
      OR sum(CASE WHEN ((y1 > py) <> (y2 > py))
                       AND px < (x2 - x1) * (py - y1) / (y2 - y1) + x1 THEN 1 ELSE 0 END) % 2 = 1)"""


def _points(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("x"),
                     F.col("l_suppkey").cast("double").alias("y"))


@register("g2_clip", sql=f"""
WITH {_HITS_SQL}
SELECT l_orderkey, l_linenumber, CAST(l_quantity AS DOUBLE) AS x, CAST(l_suppkey AS DOUBLE) AS y
FROM lineitem
WHERE (CAST(l_quantity AS DOUBLE), CAST(l_suppkey AS DOUBLE)) IN (SELECT (px, py) FROM hits)
""")
def g2_clip(spark, sf_dir):
    """Lines whose (quantity, supplier) point lies in any polygon (edges count)."""
    return G.clip(_points(spark, sf_dir), polygons(spark), "x", "y")


@register("g3_tag", sql=f"""
WITH {_HITS_SQL},
names(poly_id, name) AS (VALUES {_names_sql()}),
best AS (SELECT px, py, max(poly_id) AS poly_id FROM hits GROUP BY px, py)
SELECT l.l_orderkey, l.l_linenumber, CAST(l.l_quantity AS DOUBLE) AS x, CAST(l.l_suppkey AS DOUBLE) AS y,
       CAST(b.poly_id AS BIGINT) AS poly_id, n.name
FROM lineitem l
LEFT JOIN best b ON CAST(l.l_quantity AS DOUBLE) = b.px AND CAST(l.l_suppkey AS DOUBLE) = b.py
LEFT JOIN names n ON b.poly_id = n.poly_id
""")
def g3_tag(spark, sf_dir):
    """Every line tagged with the last (highest ordinal) polygon containing its point."""
    return G.tag_with_polygon(_points(spark, sf_dir), polygons(spark), "x", "y", ["name"], pick="last")


@register("g3_tag_first", sql=f"""
WITH {_HITS_SQL},
best AS (SELECT px, py, min(poly_id) AS poly_id FROM hits GROUP BY px, py)
SELECT l.l_orderkey, l.l_linenumber, CAST(b.poly_id AS BIGINT) AS poly_id
FROM lineitem l
LEFT JOIN best b ON CAST(l.l_quantity AS DOUBLE) = b.px AND CAST(l.l_suppkey AS DOUBLE) = b.py
""")
def g3_tag_first(spark, sf_dir):
    """G3 with ``pick="first"``: the lowest ordinal wins where polygons overlap."""
    t = G.tag_with_polygon(_points(spark, sf_dir), polygons(spark), "x", "y", [], pick="first")
    return t.select("l_orderkey", "l_linenumber", "poly_id")


@register("g7_bbox", sql="""
SELECT p_partkey,
       CAST(p_size AS DOUBLE) AS minx, CAST(0.0 AS DOUBLE) AS miny,
       CAST(p_size + 5 AS DOUBLE) AS maxx, p_retailprice AS maxy
FROM part
""")
def g7_bbox(spark, sf_dir):
    """Bounding box of an extent polygon given as a GML posList text per part."""
    p = table(spark, sf_dir, "part")
    x0, x1, y1 = F.col("p_size").cast("double"), (F.col("p_size") + 5).cast("double"), F.col("p_retailprice")
    pos = F.concat_ws(" ", *[v.cast("string") for v in (x0, F.lit(0.0), x1, F.lit(0.0), x1, y1, x0, y1, x0, F.lit(0.0))])
    b = p.select("p_partkey", G.ring_bbox(F.array(G.poslist_ring(pos))).alias("b"))
    return b.select("p_partkey", "b.minx", "b.miny", "b.maxx", "b.maxy")


_XTEXT_SQL = "CASE WHEN c_mktsegment = 'BUILDING' THEN 'n/a' ELSE CAST(c_custkey AS VARCHAR) END"


def _coord_text(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    xt = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("n/a")).otherwise(F.col("c_custkey").cast("string"))
    return c.select("c_custkey", "c_mktsegment", xt.alias("xt"), F.col("c_acctbal").cast("string").alias("yt"))


@register("g1_points", sql=f"""
SELECT c_custkey, TRY_CAST({_XTEXT_SQL} AS DOUBLE) AS px, CAST(c_acctbal AS DOUBLE) AS py
FROM customer WHERE TRY_CAST({_XTEXT_SQL} AS DOUBLE) IS NOT NULL
""")
def g1_points(spark, sf_dir):
    """G1: coordinates parsed from text; rows with a non-numeric coordinate set aside."""
    ok, _rejected = G.with_point(_coord_text(spark, sf_dir), "xt", "yt")
    return ok.select("c_custkey", "px", "py")


@register("q4_rejected_points", sql=f"""
SELECT c_custkey, c_mktsegment FROM customer
WHERE TRY_CAST({_XTEXT_SQL} AS DOUBLE) IS NULL
""")
def q4_rejected_points(spark, sf_dir):
    """Q4: the rejected-row side output of G1 (unparsable coordinates)."""
    _ok, rejected = G.with_point(_coord_text(spark, sf_dir), "xt", "yt")
    return rejected.select("c_custkey", "c_mktsegment")


# ---------------------------------------------------------------- G4 reprojection

def _g4_sql() -> str:
    import math

    from landframe.functions import geodesy as GD
    a1, b1, a2, b2 = GD.WGS_A, GD.WGS_B, GD.AIRY_A, GD.AIRY_B
    e21, e22 = (a1 * a1 - b1 * b1) / (a1 * a1), (a2 * a2 - b2 * b2) / (a2 * a2)
    p = GD.HELMERT_TO_OSGB
    sec = math.pi / (180 * 3600)
    tx, ty, tz, s = p["tx"], p["ty"], p["tz"], p["s"] * 1e-6
    rx, ry, rz = p["rx"] * sec, p["ry"] * sec, p["rz"] * sec
    n = (a2 - b2) / (a2 + b2)
    ctes = [
        "s0 AS (SELECT event_id, radians(51.3 + value / 200.0) AS phi, radians(-0.5 + user_id / 500.0) AS lam FROM events)",
        f"s1 AS (SELECT event_id, {a1} / sqrt(1 - {e21} * sin(phi) * sin(phi)) AS nu, phi, lam FROM s0)",
        "s2 AS (SELECT event_id, nu * cos(phi) * cos(lam) AS x1, nu * cos(phi) * sin(lam) AS y1, "
        f"{1 - e21} * nu * sin(phi) AS z1 FROM s1)",
        f"s3 AS (SELECT event_id, {tx} + {1 + s} * x1 - {rz} * y1 + {ry} * z1 AS x2, "
        f"{ty} + {rz} * x1 + {1 + s} * y1 - {rx} * z1 AS y2, {tz} - {ry} * x1 + {rx} * y1 + {1 + s} * z1 AS z2 FROM s2)",
        f"i0 AS (SELECT event_id, x2, y2, z2, sqrt(x2 * x2 + y2 * y2) AS pxy, atan2(z2, sqrt(x2 * x2 + y2 * y2) * {1 - e22}) AS phi FROM s3)",
    ]
    for k in range(1, GD.ITERATIONS + 1):
        ctes.append(f"i{k} AS (SELECT event_id, x2, y2, z2, pxy, atan2(z2 + {e22} * ({a2} / sqrt(1 - {e22} * sin(phi) * sin(phi))) "
                    f"* sin(phi), pxy) AS phi FROM i{k - 1})")
    last = f"i{GD.ITERATIONS}"
    lat0, lon0, f0 = GD.LAT0, GD.LON0, GD.F0
    ctes.append(f"t0 AS (SELECT event_id, phi, atan2(y2, x2) - {lon0} AS dl, sin(phi) AS sp, cos(phi) AS cp, tan(phi) AS tp, "
                f"1 - {e22} * sin(phi) * sin(phi) AS w FROM {last})")
    ctes.append(f"t1 AS (SELECT *, {a2 * f0} / sqrt(w) AS nu, {a2 * f0 * (1 - e22)} * pow(w, -1.5) AS rho, tp * tp AS t2, "
                f"{b2 * f0} * ({1 + n + 1.25 * n ** 2 + 1.25 * n ** 3} * (phi - {lat0}) "
                f"- {3 * n + 3 * n ** 2 + 21 / 8 * n ** 3} * sin(phi - {lat0}) * cos(phi + {lat0}) "
                f"+ {15 / 8 * n ** 2 + 15 / 8 * n ** 3} * sin(2 * (phi - {lat0})) * cos(2 * (phi + {lat0})) "
                f"- {35 / 24 * n ** 3} * sin(3 * (phi - {lat0})) * cos(3 * (phi + {lat0}))) AS m FROM t0)")
    ctes.append("t2 AS (SELECT *, nu / rho - 1 AS eta2 FROM t1)")
    north = (f"m + {GD.N0} + nu / 2 * sp * cp * pow(dl, 2) + nu / 24 * sp * pow(cp, 3) * (5 - t2 + 9 * eta2) * pow(dl, 4) "
             f"+ nu / 720 * sp * pow(cp, 5) * (61 - 58 * t2 + t2 * t2) * pow(dl, 6)")
    east = (f"{GD.E0} + nu * cp * dl + nu / 6 * pow(cp, 3) * (nu / rho - t2) * pow(dl, 3) "
            f"+ nu / 120 * pow(cp, 5) * (5 - 18 * t2 + t2 * t2 + 14 * eta2 - 58 * t2 * eta2) * pow(dl, 5)")
    return ("WITH " + ",\n".join(ctes) +
            f"\nSELECT event_id, round({east}, 2) AS easting, round({north}, 2) AS northing FROM t2")


@register("g4_reproject", sql=_g4_sql())
def g4_reproject(spark, sf_dir):
    """WGS84 points (derived from event value and user) to National Grid metres,
    through the Helmert datum shift and the transverse Mercator projection."""
    e = table(spark, sf_dir, "events")
    pts = e.select("event_id", (F.lit(-0.5) + F.col("user_id") / 500.0).alias("easting"),
                   (F.lit(51.3) + F.col("value") / 200.0).alias("northing"))
    out = G.reproject(pts, "easting", "northing", "EPSG:4326", "EPSG:27700")
    return out.select("event_id", F.round("easting", 2).alias("easting"), F.round("northing", 2).alias("northing"))


# ---------------------------------------------------------------- G4 grid shift, G5

# A generated shift table (the published one is not available): metres at the
# nodes of a grid of 250 m, by column and row.
_SHIFT_SQL = """
node AS (SELECT c.v AS col, r.v AS row, (c.v * 3 + r.v) % 7 / 8.0 + r.v / 16.0 AS se, (r.v * 5 + c.v) % 5 / 4.0 - c.v / 32.0 AS sn
         FROM range(0, 60) c(v), range(0, 60) r(v)),
pts AS (SELECT event_id, sqrt(CAST(user_id % 997 + 2 AS DOUBLE)) * 300 AS x, sqrt(CAST(event_id % 613 + 2 AS DOUBLE)) * 500 AS y FROM events),
placed AS (SELECT *, floor(x / 250) AS c, floor(y / 250) AS r, x / 250 - floor(x / 250) AS t, y / 250 - floor(y / 250) AS u FROM pts),
moved AS (SELECT event_id, x, y,
    x + (1 - t) * (1 - u) * a.se + t * (1 - u) * b.se + (1 - t) * u * d.se + t * u * e.se AS mx,
    y + (1 - t) * (1 - u) * a.sn + t * (1 - u) * b.sn + (1 - t) * u * d.sn + t * u * e.sn AS my
  FROM placed LEFT JOIN node a ON a.col = c AND a.row = r LEFT JOIN node b ON b.col = c + 1 AND b.row = r
  LEFT JOIN node d ON d.col = c AND d.row = r + 1 LEFT JOIN node e ON e.col = c + 1 AND e.row = r + 1)"""


@register("g4_grid_shift", sql=f"""
WITH {_SHIFT_SQL}
SELECT event_id, round(mx, 6) AS x, round(my, 6) AS y, round(x, 4) AS back_x, round(y, 4) AS back_y FROM moved
""")
def g4_grid_shift(spark, sf_dir):
    """Event places moved by a table of shifts, and back again by iteration."""
    from landframe.operators.gridshift import grid_shift
    side = spark.range(60).select(F.col("id").alias("col"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(59).cast("long"))).alias("row"))
    nodes = side.select("col", "row", ((F.col("col") * 3 + F.col("row")) % 7 / 8.0 + F.col("row") / 16.0).alias("se"),
                        ((F.col("row") * 5 + F.col("col")) % 5 / 4.0 - F.col("col") / 32.0).alias("sn"))
    e = table(spark, sf_dir, "events")
    pts = e.select("event_id", (F.sqrt(F.col("user_id") % 997 + 2) * 300).alias("x"), (F.sqrt(F.col("event_id") % 613 + 2) * 500).alias("y"))
    there = grid_shift(pts, "x", "y", nodes, 250.0)
    both = there.select("*", F.col("x").alias("back_x"), F.col("y").alias("back_y"))
    back = grid_shift(both, "back_x", "back_y", nodes, 250.0, inverse=True, iterations=8)
    return back.select("event_id", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"), F.round("back_x", 4).alias("back_x"), F.round("back_y", 4).alias("back_y"))


@register("g5_declared_crs", sql="""
SELECT l_orderkey, l_linenumber, CAST(l_quantity AS DOUBLE) AS x, CAST(l_suppkey AS DOUBLE) AS y, 'EPSG:27700' AS crs_x, 'EPSG:27700' AS crs_y,
       'none' AS crs_key FROM lineitem
""")
def g5_declared_crs(spark, sf_dir):
    """Points with a declared coordinate system; what the columns declare, as values."""
    pts = G.set_crs(_points(spark, sf_dir), ["x", "y"], "EPSG:27700")
    declared = {f.name: f.metadata.get("crs", "none") for f in pts.schema.fields}
    return pts.select("*", F.lit(declared["x"]).alias("crs_x"), F.lit(declared["y"]).alias("crs_y"), F.lit(declared["l_orderkey"]).alias("crs_key"))
