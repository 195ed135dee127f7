"""Map features with their geometry out of folders of GML tiles.

One scan serves all layers: the text reader splits the files just before each feature's id
(so splits work inside large files too), every feature is routed by its own element name and
parsed once.  Geometry is assembled from the text with native expressions: GML 2
(``outerBoundaryIs``, ``coordinates``) and GML 3 (``exterior``, rings of several curve members,
``posList``, ``pos``) alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landframe.functions._util import as_col
from landframe.functions._util import let as _let
from landframe.operators.spatial import RINGS
from landframe.sources.files import with_provenance
from landframe.sources.layouts import MAP_LAYERS

_P = r"(?:[\w.-]+:)?"  # a namespace prefix
_BOUNDARY = rf"(?s)<{_P}(exterior|outerBoundaryIs|interior|innerBoundaryIs)\b[^>]*>.*?</{_P}\1\s*>"
_RING = rf"(?s)<{_P}(LinearRing)\b.*?</{_P}\1\s*>"
_PATH = rf"(?s)<{_P}(LineString|Curve)\b.*?</{_P}\1\s*>"
_POINT = rf"(?s)<{_P}(Point)\b.*?</{_P}\1\s*>"
_BOX = rf"(?s)<{_P}(Box|Envelope)\b.*?</{_P}\1\s*>"
_POSITIONS = rf"(?s)<{_P}(?:coordinates|posList|pos|lowerCorner|upperCorner)\b[^>]*>[^<]*<"
#: on an element around the lists, not on a list itself
_DIMENSION = r"<(?>(?:[\w.-]+:)?)(?!pos\b|posList\b)\w+\b[^>]*?\bsrsDimension\s*=\s*[\"'](\d)"
_BOUNDED_BY = rf"(?s)<{_P}(boundedBy)\b.*?</{_P}\1\s*>"

GEOMETRY = T.StructType([
    T.StructField("rings", RINGS), T.StructField("lines", RINGS), T.StructField("point", RINGS.elementType.elementType),
    T.StructField("error", T.StringType())])


def _all(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _xy(x: Column, y: Column) -> Column:
    return F.struct(x.try_cast("double").alias("x"), y.try_cast("double").alias("y"))


def positions(element: Column, dimension: Column) -> Column:
    """Points of one ``coordinates`` / ``posList`` / ``pos`` element.  A token that is no number
    gives a point with a null; tokens left over of a list give a last point of nulls."""
    body = F.trim(F.regexp_replace(F.regexp_extract(element, ">([^<]*)<", 1), r"\s*,\s*", ","))
    own = F.nullif(F.regexp_extract(element, r"srsDimension\s*=\s*[\"'](\d)", 1), F.lit("")).cast("int")
    one = F.regexp_like(element, F.lit(rf"^<{_P}(?:pos|lowerCorner|upperCorner)\b"))
    is_pairs = F.regexp_like(element, F.lit(rf"^<{_P}coordinates\b"))
    pairs = lambda words: F.transform(words, lambda w: _let(F.split(w, ","), lambda t: _xy(F.get(t, F.lit(0)), F.get(t, F.lit(1)))))

    def listed(words, d):
        at = F.sequence(F.lit(0), F.ceil(F.size(words) / d).cast("int") - 1)
        return F.transform(at, lambda i: F.when((i + 1) * d <= F.size(words), _xy(F.get(words, i * d), F.get(words, i * d + 1)))
                           .otherwise(_xy(F.lit(None), F.lit(None))))

    def points(words):
        d = F.coalesce(F.when(one, F.greatest(F.size(words), F.lit(2))), own, dimension, F.lit(2))
        return F.when(F.size(words) == 0, F.array().cast(RINGS.elementType)).when(is_pairs, pairs(words)).otherwise(_let(d, lambda n: listed(words, n)))

    return _let(F.filter(F.split(body, r"\s+"), lambda w: w != ""), points)


def path_points(fragment: Column, dimension: Column) -> Column:
    """All positions of a fragment as one path: its lists joined, points repeated at the joints once."""
    points = F.flatten(F.transform(_all(fragment, _POSITIONS), lambda e: positions(e, dimension)))
    return _let(points, lambda all_: F.filter(all_, lambda p, i: (i == 0) | ~p.eqNullSafe(F.get(all_, i - 1))))


def signed_area(ring: Column) -> Column:
    """Twice the area of a closed ring, positive when counter-clockwise."""
    at = F.sequence(F.lit(1), F.greatest(F.size(ring) - 1, F.lit(1)))
    return F.aggregate(at, F.lit(0.0), lambda s, i: s + F.coalesce(
        F.get(ring, i - 1)["x"] * F.get(ring, i)["y"] - F.get(ring, i)["x"] * F.get(ring, i - 1)["y"], F.lit(0.0)))


def closed_ring(points: Column, exterior: Column) -> Column:
    """A ring closed and oriented: exteriors counter-clockwise, interiors clockwise."""
    def shut(p):
        return F.when((F.size(p) > 0) & ~F.get(p, F.lit(0)).eqNullSafe(F.element_at(p, -1)), F.concat(p, F.slice(p, 1, 1))).otherwise(p)
    return _let(_let(points, shut), lambda ring: F.when((signed_area(ring) > 0) == exterior, ring).otherwise(F.reverse(ring)))


def gml_geometry(xml) -> Column:
    """The geometry of one feature's XML: ``rings`` (all surfaces; exteriors counter-clockwise,
    interiors clockwise, every ring closed; a box is a ring), ``lines`` (one path per
    ``LineString`` or ``Curve``), ``point`` (the first) and ``error``.  Parts that a feature
    lacks are null.  With a position that is no number, a list cut short or a ring of fewer
    than three places, the error says so and the geometry is null.  ``boundedBy`` is no geometry.
    """
    def rings_of(boundary, dimension):
        exterior = F.regexp_like(boundary, F.lit(rf"^<{_P}(?:exterior|outerBoundaryIs)\b"))
        pieces = _let(_all(boundary, _RING), lambda linear: F.when(F.size(linear) > 0, linear).otherwise(F.array(boundary)))
        return F.transform(pieces, lambda piece: closed_ring(path_points(piece, dimension), exterior))

    def box_ring(p):
        return F.array(*[F.struct(F.get(p, F.lit(i))["x"].alias("x"), F.get(p, F.lit(j))["y"].alias("y")) for i, j in ((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))])

    def made(t):
        text, rest, d = t["text"], t["rest"], t["d"]
        rings = F.flatten(F.transform(_all(text, _BOUNDARY), lambda b: rings_of(b, d)))
        boxes = F.transform(_all(rest, _BOX), lambda b: _let(path_points(b, d), box_ring))
        lines = F.transform(_all(rest, _PATH), lambda p: path_points(p, d))
        point = F.get(path_points(F.coalesce(F.get(_all(F.regexp_replace(rest, _PATH, ""), _POINT), F.lit(0)), F.lit("")), d), F.lit(0))
        return F.struct(F.concat(rings, boxes).alias("rings"), lines.alias("lines"), point.alias("point"))

    def bad(p):
        return p["x"].isNull() | p["y"].isNull()

    def fault(g):
        broken = F.exists(g["rings"], lambda r: F.exists(r, bad)) | F.exists(g["lines"], lambda r: F.exists(r, bad)) | (
            g["point"].isNotNull() & bad(g["point"]))
        short = F.exists(g["rings"], lambda r: F.size(r) < 4) | F.exists(g["lines"], lambda r: F.size(r) < 2)
        return F.when(broken, "position is no number").when(short, "too few positions")

    def judged(g):
        return _let(fault(g), lambda error: F.struct(
            F.when(error.isNull() & (F.size(g["rings"]) > 0), g["rings"]).alias("rings"),
            F.when(error.isNull() & (F.size(g["lines"]) > 0), g["lines"]).alias("lines"),
            F.when(error.isNull(), g["point"]).alias("point"), error.alias("error")))

    texts = _let(F.regexp_replace(as_col(xml), _BOUNDED_BY, ""), lambda text: F.struct(
        text.alias("text"), F.regexp_replace(text, _BOUNDARY, "").alias("rest"),
        F.nullif(F.regexp_extract(text, _DIMENSION, 1), F.lit("")).cast("int").alias("d")))
    return _let(_let(texts, made), judged).cast(GEOMETRY)


def feature_records(spark: SparkSession, paths, layers: Sequence[str], id_attribute: str = "fid") -> DataFrame:
    """``(layer, xml, tile, file)`` for every feature of the named layers in the files, one scan.

    The files are split at the features' id attribute; a piece begins with the id's value and
    holds the feature up to its closing tag.  Elements of the layers that carry no id (the
    query extent) are found inside the pieces.  Pieces without a closing tag of these layers
    (other feature types, features without content) come with a null layer and the first 200
    characters, so what was not routed can be counted; a file's head does not.
    """
    names = "|".join(layers)
    closing = rf"</{_P}(?:{names})\s*>"
    whole = rf"(?s)<{_P}({names})(?:\s[^>]*)?(?<!/)>.*?</{_P}\1\s*>"
    lines = with_provenance(spark.read.option("lineSep", f"{id_attribute}=").text(paths))
    v = F.col("value")
    begun = F.regexp_like(v, F.lit(r"^[\"']"))
    lead = F.regexp_extract(v, rf"(?s)^([\"'].*?){closing}", 1)
    name = F.regexp_extract(v, rf"(?s)^[\"'].*?</{_P}({names})\s*>", 1)
    cut = lines.select("tile", "file", v, begun.alias("begun"), lead.alias("lead"), name.alias("name"))
    # a piece of another type may hold one of the layers' elements without an id
    own = F.col("begun") & (F.col("name") != "") & ~F.regexp_like("lead", F.concat(F.lit(rf"<{_P}(?:"), "name", F.lit(r")[\s>]")))
    first = F.when(own, F.struct(F.col("name").alias("layer"), F.concat(
        F.lit("<"), "name", F.lit(f" {id_attribute}="), "lead", F.lit("</"), "name", F.lit(">")).alias("xml")))
    unknown = F.when(F.col("begun") & ~own, F.struct(F.lit(None).cast("string").alias("layer"), F.left(v, F.lit(200)).alias("xml")))
    others = F.transform(_all(v, whole), lambda e: F.struct(F.regexp_extract(e, rf"^<{_P}(\w+)", 1).alias("layer"), e.alias("xml")))
    rows = cut.select("tile", "file", F.explode(F.filter(F.concat(F.array(first, unknown), others), lambda r: r.isNotNull())).alias("r"))
    return rows.select("r.layer", "r.xml", "tile", "file")


def _raw_schema(layers: Sequence[str]) -> T.StructType:
    """XML form of the layers' attributes, all layers together (children may repeat)."""
    raw = T.StructType([T.StructField("_fid", T.StringType())])
    for layer in layers:
        for f in T._parse_datatype_string(MAP_LAYERS[layer]).fields:
            low = f.name[0].lower() + f.name[1:]
            if f.name == "TOID" or f.name.endswith("Count") or f.name in ("ChangeDate", "ReasonForChange") or low in raw.names:
                continue
            raw.add(low, T.ArrayType(T.StringType()) if f.name in REPEATED else f.dataType)
    return raw.add("changeHistory", T.ArrayType(T.StructType([T.StructField("changeDate", T.StringType()), T.StructField("reasonForChange", T.StringType())])))


# Children of a map feature that may repeat
REPEATED = ("Theme", "DescriptiveGroup", "DescriptiveTerm")


def layer_attributes(layers: Sequence[str]) -> list[T.StructField]:
    """All attributes of the layers, in the order of their tables."""
    out: dict[str, T.StructField] = {}
    for layer in layers:
        for f in T._parse_datatype_string(MAP_LAYERS[layer]).fields:
            out.setdefault(f.name, f)
    return list(out.values())


def read_map_features(spark: SparkSession, paths, layers: Sequence[str] = tuple(MAP_LAYERS)) -> DataFrame:
    """Every feature of the declared layers in one frame: ``layer``, all layers' attributes,
    the geometry (``rings``, ``lines``, ``point``, ``geometry_error``), ``tile``, ``file``.

    Of repeated children the first is the value and their number the ``...Count`` attribute;
    elements a feature lacks, or that its layer does not declare, are null (counts 0)."""
    records = feature_records(spark, paths, layers).filter("layer is not null")
    parsed = records.select("layer", "tile", "file", F.from_xml("xml", _raw_schema(layers).simpleString(), {"ignoreNamespace": "true"}).alias("f"),
                            gml_geometry("xml").alias("g"))
    out = []
    for f in layer_attributes(layers):
        low = f.name[0].lower() + f.name[1:]
        if f.name == "TOID":
            c = F.col("f._fid")
        elif f.name in ("ChangeDate", "ReasonForChange"):
            c = F.get("f.changeHistory", F.lit(0))[low]
        elif f.name.endswith("Count"):
            c = F.coalesce(F.size(F.col(f"f.{low[:-5]}")), F.lit(0)).cast("smallint")
        else:
            c = F.get(f"f.{low}", F.lit(0)) if f.name in REPEATED else F.col(f"f.{low}")
        out.append(c.alias(f.name))
    return parsed.select("layer", *out, "g.rings", "g.lines", "g.point", F.col("g.error").alias("geometry_error"), "tile", "file")


def layer_table(features: DataFrame, layer: str) -> DataFrame:
    """One declared layer in its table form, with its geometry and provenance."""
    names = T._parse_datatype_string(MAP_LAYERS[layer]).names
    return features.filter(F.col("layer") == layer).select(*names, "rings", "lines", "point", "geometry_error", "tile", "file")


def polygon_layer_of(areas: DataFrame, attrs: Sequence[str]) -> DataFrame:
    """A polygon layer (``poly_id``, ``attrs``, ``rings``) for the point-in-polygon joins from an
    area table; features without rings are left out.  ``poly_id`` is a 64-bit hash of the
    feature's id: the same in every run, but no order that means anything where areas overlap."""
    return areas.filter(F.col("rings").isNotNull()).select(F.xxhash64("TOID").alias("poly_id"), *attrs, "rings")


def load_map_layers(spark: SparkSession, paths, root: str, release: str, layers: Sequence[str] = tuple(MAP_LAYERS)) -> dict[str, DataFrame]:
    """All layers out of a folder of tiles, written by layer and release in one pass over
    the files; the tables returned read what was written."""
    features = read_map_features(spark, paths, layers).withColumn("release", F.lit(release))
    (features.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("layer", "release").parquet(root))
    back = spark.read.schema(features.schema).parquet(root).filter(F.col("release") == release)
    return {layer: layer_table(back, layer) for layer in layers}
