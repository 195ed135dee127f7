"""Registered map-layer queries (S3, L11): tiles written from part rows, loaded with geometry.

Every part is a feature on a sheet of 40 x n places, 4 units apart: an area of 3 x 3 (even
parts with a hole of 1 x 1, written as GML 2; odd ones as GML 3, the ring in two curve members),
its lower edge as a line and a text anchor.  The oracles use the places' arithmetic only.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from landframe.functions._util import let
from landframe.operators.spatial import ring_bbox, tag_with_polygon
from landframe.plans.registry import register
from landframe.plans.tables import table
from landframe.session import checkpoint_dir
from landframe.sources import gml


def _pairs(x, y, corners):
    return F.concat_ws(" ", *[F.concat((x + dx).cast("string"), F.lit(","), (y + dy).cast("string")) for dx, dy in corners])


def _list(x, y, corners):
    return F.concat_ws(" ", *[F.concat((x + dx).cast("string"), F.lit(" "), (y + dy).cast("string")) for dx, dy in corners])


def _tag(name: str, *inner, attrs: str = ""):
    return F.concat(F.lit(f"<{name}{attrs}>"), *inner, F.lit(f"</{name}>"))


def _tiles(spark, sf_dir) -> str:
    """Folder of tiles, 200 parts a file.  The rows are dealt by tile before the texts are made:
    the table's file is small and would be one task.  All files lie in one folder, so reading
    them lists one folder and not one for every tile."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_brand", F.floor(F.col("p_partkey") / 200).alias("sheet"))
    p = p.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "sheet")
    x, y = (F.col("p_partkey") % 40 * 4).cast("double"), (F.floor(F.col("p_partkey") / 40) * 4).cast("double")
    square = [(0.5, 0.5), (0.5, 3.5), (3.5, 3.5), (3.5, 0.5), (0.5, 0.5)]  # clockwise, as written
    hole = [(1.5, 1.5), (2.5, 1.5), (2.5, 2.5), (1.5, 2.5), (1.5, 1.5)]
    two = _tag("gml:Polygon", *[_tag(f"gml:{side}BoundaryIs", _tag("gml:LinearRing", _tag("gml:coordinates", _pairs(x, y, ring))))
                                for side, ring in (("outer", square), ("inner", hole))])
    halves = [_tag("gml:curveMember", _tag("gml:LineString", _tag("gml:posList", _list(x, y, part)))) for part in (square[:3], square[2:])]
    three = _tag("gml:Surface", _tag("gml:exterior", _tag("gml:Ring", *halves)))
    key = F.col("p_partkey").cast("string")

    def feature(name, prefix, *inner):
        return F.concat(F.lit(f'<osgb:topographicMember><osgb:{name} fid="{prefix}'), key, F.lit('">'), _tag("osgb:featureCode", F.col("p_size").cast("string")),
                        *inner, F.lit(f"</osgb:{name}></osgb:topographicMember>\n"))

    body = F.concat(
        feature("TopographicArea", "area", _tag("osgb:polygon", F.when(F.col("p_partkey") % 2 == 0, two).otherwise(three))),
        feature("TopographicLine", "line", _tag("osgb:polyline", _tag("gml:LineString", _tag("gml:coordinates", _pairs(x, y, [(0.5, 0.5), (2.0, 0.5), (3.5, 0.5)]))))),
        feature("CartographicText", "text", _tag("osgb:textString", F.regexp_replace("p_brand", "[<&]", "")),
                _tag("osgb:anchorPoint", _tag("gml:Point", _tag("gml:coordinates", _pairs(x, y, [(2.0, 0.75)]))))))
    tiles = p.groupBy("sheet").agg(F.concat(
        F.lit('<osgb:FeatureCollection xmlns:osgb="urn:osgb" xmlns:gml="urn:gml">\n<osgb:queryExtent><gml:Box><gml:coordinates>0,'),
        F.min("p_partkey").cast("string"), F.lit(" 160,"), (F.max("p_partkey") + 1).cast("string"),
        F.lit("</gml:coordinates></gml:Box></osgb:queryExtent>\n"), F.array_join(F.collect_list(body), ""), F.lit("</osgb:FeatureCollection>")).alias("value"))
    path = f"{checkpoint_dir(spark)}/landframe-io/tiles-{uuid.uuid4().hex}"
    tiles.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return path


@register("l11_geometry", sql="""
WITH p AS (SELECT p_partkey, p_size, p_brand, CAST(p_partkey % 40 * 4 AS DOUBLE) AS x, CAST(p_partkey // 40 * 4 AS DOUBLE) AS y FROM part)
SELECT 'TopographicArea' AS layer, 'area' || p_partkey AS "TOID", CAST(p_size AS SMALLINT) AS "FeatureCode", CAST(NULL AS VARCHAR) AS "TextString",
       CASE WHEN p_partkey % 2 = 0 THEN [5, 5] ELSE [5] END::INTEGER[] AS vertices, CASE WHEN p_partkey % 2 = 0 THEN [9.0, -1.0] ELSE [9.0] END::DOUBLE[] AS areas,
       CAST(NULL AS DOUBLE[]) AS line_x, [x + 0.5, y + 0.5, x + 3.5, y + 3.5]::DOUBLE[] AS box, CAST(NULL AS DOUBLE) AS px FROM p
UNION ALL SELECT 'TopographicLine', 'line' || p_partkey, CAST(p_size AS SMALLINT), NULL, NULL, NULL, [x + 0.5, x + 2.0, x + 3.5], NULL, NULL FROM p
UNION ALL SELECT 'CartographicText', 'text' || p_partkey, CAST(p_size AS SMALLINT), p_brand, NULL, NULL, NULL, NULL, x + 2.0 FROM p
UNION ALL SELECT 'queryExtent', NULL, NULL, NULL, [5], [160.0 * (max(p_partkey) + 1 - min(p_partkey))], NULL,
       [0.0, min(p_partkey), 160.0, max(p_partkey) + 1], NULL FROM p GROUP BY p_partkey // 200
""")
def l11_geometry(spark, sf_dir):
    """All layers of the tiles in one pass, with their geometry: vertices and signed
    area of each ring, bounding box, the lines' places and the anchor."""
    features = gml.read_map_features(spark, _tiles(spark, sf_dir))
    box = let(ring_bbox("rings"), lambda b: F.array(*[b[c] for c in ("minx", "miny", "maxx", "maxy")]))
    return features.select(
        "layer", "TOID", "FeatureCode", "TextString", F.transform("rings", lambda r: F.size(r)).alias("vertices"),
        F.transform("rings", lambda r: gml.signed_area(r) / 2).alias("areas"), F.transform(F.get("lines", F.lit(0)), lambda p: p["x"]).alias("line_x"),
        F.when(F.col("rings").isNotNull(), box).alias("box"), F.col("point.x").alias("px"))


@register("l11_tag_areas", sql="""
WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS DOUBLE) / 16 AS dx, CAST(l_linenumber AS DOUBLE) / 2 AS dy FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey % 40 * 4 + dx AS x, l_partkey // 40 * 4 + dy AS y, 'area' || p_partkey AS "TOID", CAST(p_size AS SMALLINT) AS "FeatureCode"
FROM l LEFT JOIN part ON p_partkey = l_partkey AND dx BETWEEN 0.5 AND 3.5 AND dy BETWEEN 0.5 AND 3.5
  AND NOT (p_partkey % 2 = 0 AND dx > 1.5 AND dx < 2.5 AND dy > 1.5 AND dy < 2.5)
""")
def l11_tag_areas(spark, sf_dir):
    """L11 through G3: the tiles loaded by layer and release in one pass, then every order line
    tagged with the area its place lies in (edges and the holes' edges count)."""
    path = _tiles(spark, sf_dir)
    layers = gml.load_map_layers(spark, path, f"{path}-loaded", "201704")
    areas = gml.polygon_layer_of(layers["TopographicArea"], ["TOID", "FeatureCode"])
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_partkey") % 40 * 4 + F.col("l_quantity").cast("double") / 16).alias("x"),
        (F.floor(F.col("l_partkey") / 40) * 4 + F.col("l_linenumber").cast("double") / 2).alias("y"))
    return tag_with_polygon(li, areas, "x", "y", ["TOID", "FeatureCode"]).drop("poly_id")
