"""Spatial operators on plain columns.

Data model: points are ``x, y`` double columns; a polygon layer is a DataFrame with an
ordinal (``poly_id``), attribute columns and ``rings: array<array<struct<x,y>>>``
(every ring closed: first vertex repeated last; holes are further rings, judged by
the even-odd rule).

Point-in-polygon joins (G2/G3) are a multi-level grid equi-join, not a cross join:

1. every polygon is put on the grid level (cell edge = the largest extent over a power of
   four) that suits its extent and its number of edges: a few cells for simple shapes, about a
   cell for every 16 edges for others; cells that still hold many edges are split into 16 x 16;
2. every edge is clipped to the rows of cells it crosses and listed only in the cells it
   crosses there.  A cell keeps an anchor: how often, mod 2, a ray to the right crosses edges
   outside the cell, as a constant and a few heights at which it changes.  Cells fully covered
   have an anchor and no edges.  So a point tests the few edges of its own cell, however many
   the polygon has, with the same arithmetic as a test against all of them;
3. per (level, cell), the candidate polygons are gathered into one array, so the polygon side
   has exactly one row per cell;
4. every point computes its cell on each level in use and is joined to those cells' rows -
   left equi-joins whose right side is unique per key, so each point yields exactly one row
   and is never multiplied;
5. the exact test (boundary counts as inside, then ray-crossing parity) runs as native
   higher-order expressions over the candidate arrays.

The cell table is broadcast only when its size is proven to be within
``broadcast_max_bytes`` (a bound from the layer's vertex and polygon counts, or, for layers
with large polygons, the measured size of the written table); above that the joins are
shuffle joins where AQE splits a cell holding a large share of the points.
"""

from __future__ import annotations


from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landframe.functions._util import as_col, let
from landframe.session import materialize

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
RINGS = T.ArrayType(T.ArrayType(POINT))


def polygon_layer(spark, rows: Sequence[tuple], attr_schema: T.StructType | str) -> DataFrame:
    """Polygon layer from literal rows ``(poly_id, *attrs, rings)`` (rings closed here)."""
    if isinstance(attr_schema, str):
        attr_schema = T._parse_datatype_string(attr_schema)
    schema = T.StructType([T.StructField("poly_id", T.LongType())] + list(attr_schema.fields)
                          + [T.StructField("rings", RINGS)])
    from landframe.sources.files import lookup
    closed = []
    for r in rows:
        rings = [list(ring) + ([ring[0]] if tuple(ring[0]) != tuple(ring[-1]) else []) for ring in r[-1]]
        closed.append((*r[:-1], [[(float(a), float(b)) for a, b in ring] for ring in rings]))
    df = lookup(spark, closed, schema)
    df._landframe_layer_stats = _literal_stats([r[-1] for r in closed])
    return df


def _literal_stats(layers: Sequence[list]) -> dict:
    """``layer_stats`` of literal rings, computed on the driver (exact median)."""
    exts, nv, mv = [], 0, 0
    for rings in layers:
        pts = [p for ring in rings for p in ring]
        nv, mv = nv + len(pts), max(mv, len(pts))
        if pts:
            xs, ys = [p[0] for p in pts], [p[1] for p in pts]
            exts.append(max(max(xs) - min(xs), max(ys) - min(ys)))
    pos = sorted(e for e in exts if e > 0)
    return {"n": len(layers), "med": pos[(len(pos) - 1) // 2] if pos else 0.0,
            "lo": pos[0] if pos else 0.0, "hi": max(exts) if exts else 0.0, "nv": nv, "mv": mv}


def with_point(df: DataFrame, x: str, y: str, out_x: str = "px", out_y: str = "py") -> tuple[DataFrame, DataFrame]:
    """G1/Q4: parse coordinates; returns ``(points, rejected)``.

    Rows whose x or y text does not parse as a number go to ``rejected`` (the job's
    continue-on-error port) instead of failing the load.
    """
    parsed = df.withColumn(out_x, as_col(x).try_cast("double")).withColumn(out_y, as_col(y).try_cast("double"))
    ok = F.col(out_x).isNotNull() & F.col(out_y).isNotNull()
    return parsed.filter(ok), parsed.filter(~ok).drop(out_x, out_y)


def set_crs(df: DataFrame, cols: Sequence[str], crs: str) -> DataFrame:
    """Declare the coordinate reference system as column metadata (no maths)."""
    for c in cols:
        df = df.withMetadata(c, {"crs": crs})
    return df


def ring_bbox(rings) -> Column:
    """``struct(minx, miny, maxx, maxy)`` of all vertices of all rings (computed once)."""
    def box(v):
        return F.struct(F.array_min(v["xs"]).alias("minx"), F.array_min(v["ys"]).alias("miny"),
                        F.array_max(v["xs"]).alias("maxx"), F.array_max(v["ys"]).alias("maxy"))

    def values(pts):
        return F.struct(F.transform(pts, lambda p: p["x"]).alias("xs"), F.transform(pts, lambda p: p["y"]).alias("ys"))
    return let(let(F.flatten(as_col(rings)), values), box)


def poslist_ring(text) -> Column:
    """A GML ``posList`` text (``"x1 y1 x2 y2 ..."``) as one ring of points."""
    def ring(nums):
        n = F.size(nums)
        idx = F.sequence(F.lit(0), F.greatest(n / 2 - 1, F.lit(0)).cast("int"))
        return F.when(n >= 2, F.transform(idx, lambda i: F.struct(F.get(nums, i * 2).alias("x"),
                                                                   F.get(nums, i * 2 + 1).alias("y"))))
    return let(F.transform(F.split(F.trim(as_col(text)), "\\s+"), lambda s: s.try_cast("double")), ring)


def ring_edges(rings) -> Column:
    """All edges of all closed rings as ``array<struct<x1, y1, x2, y2>>``."""
    def ring_to_edges(r):
        idx = F.sequence(F.lit(0), F.greatest(F.size(r) - 2, F.lit(0)))
        edges = F.transform(idx, lambda i: F.struct(
            F.get(r, i)["x"].alias("x1"), F.get(r, i)["y"].alias("y1"),
            F.get(r, i + 1)["x"].alias("x2"), F.get(r, i + 1)["y"].alias("y2")))
        return F.filter(edges, lambda e: e["x2"].isNotNull())
    return F.flatten(F.transform(as_col(rings), ring_to_edges))


def point_in_edges(px, py, edges, boundary_inside: bool = True, anchor=None) -> Column:
    """Exact test over precomputed edges, one pass: a rightward ray crossing an odd
    number of edges means inside (even-odd rule, so holes are handled).  A point on an
    edge or vertex counts as inside when ``boundary_inside`` (the default, as the jobs'
    overlay did), otherwise as outside.

    With ``anchor`` (0 or 1) the edges are those of one cell: what lies outside adds the anchor,
    and changes at the heights ``t1``, ``t2`` of its edges."""
    px, py = as_col(px), as_col(py)
    zero = F.struct((F.lit(0) if anchor is None else anchor).cast("int").alias("n"), F.lit(False).alias("edge"))

    def one(c):
        return F.when(c, F.lit(1)).otherwise(F.lit(0))

    def step(acc, e):
        x1, y1, x2, y2 = e["x1"], e["y1"], e["x2"], e["y2"]
        hit = ((y1 > py) != (y2 > py)) & (px < (x2 - x1) * (py - y1) / (y2 - y1) + x1)
        cross = (px - x1) * (y2 - y1) - (py - y1) * (x2 - x1)
        on = ((cross == 0) & (px >= F.least(x1, x2)) & (px <= F.greatest(x1, x2))
              & (py >= F.least(y1, y2)) & (py <= F.greatest(y1, y2)))
        n = acc["n"] + one(hit)
        if anchor is not None:
            n = n + one(e["t1"] > py) + one(e["t2"] > py)
        return F.struct(n.alias("n"), (acc["edge"] | on).alias("edge"))

    if boundary_inside:
        return F.aggregate(as_col(edges), zero, step, lambda acc: acc["edge"] | (acc["n"] % 2 == 1))
    return F.aggregate(as_col(edges), zero, step, lambda acc: ~acc["edge"] & (acc["n"] % 2 == 1))


def point_in_rings(px, py, rings, boundary_inside: bool = True) -> Column:
    """Exact point-in-polygon test against rings (see ``point_in_edges``)."""
    return point_in_edges(px, py, ring_edges(rings), boundary_inside)


def layer_stats(polygons: DataFrame, rings: str = "rings") -> dict:
    """Polygon count, median / smallest positive / largest extent, vertex count and largest
    vertex count of one polygon of a layer: one small aggregate job, or none for a layer made by ``polygon_layer``, whose
    stats were computed from its literal rows (frames derived from it run the job)."""
    known = getattr(polygons, "_landframe_layer_stats", None)
    if known is not None and rings == "rings":
        return dict(known)
    return _layer_stats(polygons, rings)


def _layer_stats(polygons: DataFrame, rings: str) -> dict:
    b = polygons.select(ring_bbox(rings).alias("b"), F.size(F.flatten(F.col(rings))).alias("nv")).select(
        F.greatest(F.col("b.maxx") - F.col("b.minx"), F.col("b.maxy") - F.col("b.miny")).alias("ext"), "nv")
    pos = F.when(F.col("ext") > 0, F.col("ext"))
    row = b.agg(F.count(F.lit(1)).alias("n"), F.percentile_approx(pos, F.lit(0.5)).alias("med"),
                F.min(pos).alias("lo"), F.max("ext").alias("hi"), F.sum("nv").alias("nv"), F.max("nv").alias("mv")).first()
    return {"n": int(row["n"]), "med": float(row["med"] or 0.0), "lo": float(row["lo"] or 0.0),
            "hi": float(row["hi"] or 0.0), "nv": int(row["nv"] or 0), "mv": int(row["mv"] or 0)}


def _level(ext: Column, base: float, least: float) -> Column:
    """Grid level of a polygon: the largest L with ``base / 4**L >= extent``, so the polygon's
    bounding box touches at most 2 x 2 cells of its level.  Extents below ``least`` (points)
    count as that.  The logarithm only gives a first guess; exact power-of-two comparisons
    settle it."""
    ext = F.greatest(ext, F.lit(least))
    guess = F.floor(F.log2(F.lit(base) / ext) / 2).cast("int")
    size = lambda k: F.lit(base) * F.pow(F.lit(4.0), -k)  # noqa: E731  (exact for powers of two)
    return F.when(size(guess + 1) >= ext, guess + 1).when(size(guess) < ext, guess - 1).otherwise(guess).cast("int")


def _cell(v: Column, size) -> Column:
    return F.floor(v / (size if isinstance(size, Column) else F.lit(size))).cast("long")


#: a polygon with more vertices than this gets finer cells; a cell with more than
#: ``DENSE_EDGES`` is split into ``SPLIT x SPLIT`` (two levels further down)
SIMPLE_VERTICES, DENSE_EDGES, SPLIT = 16, 32, 16


def _polygon_level(ext: Column, vertices: Column, base: float, least: float) -> Column:
    """Level whose cells have one to four times the edge ``extent`` of a simple polygon, or of
    a part with about 16 of a larger one's edges."""
    share = F.least(F.lit(1.0), F.sqrt(F.lit(float(SIMPLE_VERTICES)) / F.greatest(vertices, F.lit(1))))
    return _level(F.greatest(ext, F.lit(least)) * share, base, 0.0)


def _cell_edges(edges: DataFrame, cells: DataFrame, base: float) -> DataFrame:
    """``cells`` (ord, lvl, cx, cy, bb) that polygons touch, with ``anchor`` and ``edges``
    (null where the polygon covers the cell), from ``edges`` (ord, lvl, x1, y1, x2, y2).

    Of a cell, the edges that cross its row to the right of it add to every ray from the cell
    [y1 > py] + [y2 > py] (mod 2).  An end above the row always adds 1: the anchor sums those.
    An end inside the row is shared with another edge; two edges to the right cancel, so only
    those ends count whose other edge is listed in the cell: they are heights ``t1``, ``t2`` of
    the listed edges.  All of this is exact.  Clipping only decides which cells list an edge,
    and is widened a little, so rounding can list an edge too often, never too rarely.
    """
    s = F.lit(base) * F.pow(F.lit(4.0), -F.col("lvl"))
    rows = edges.select("*", s.alias("s"), _cell(F.col("y1"), s).alias("r1"), _cell(F.col("y2"), s).alias("r2"))
    rows = rows.select("*", F.explode(F.sequence(F.least("r1", "r2"), F.greatest("r1", "r2"))).alias("cy"))
    y_gap = F.col("s") * 1e-6 + F.greatest(F.abs("y1"), F.abs("y2")) * 1e-12
    low = F.greatest(F.least("y1", "y2"), F.col("cy") * F.col("s") - y_gap)
    high = F.least(F.greatest("y1", "y2"), (F.col("cy") + 1) * F.col("s") + y_gap)

    def x_at(y):
        return F.when(F.col("y1") == F.col("y2"), F.col("x1")).otherwise(
            F.col("x1") + (y - F.col("y1")) * F.try_divide(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")))

    # what the row holds of the edge: both clipped ends, and real ends that lie in the row
    inside = [F.when((F.col(r) == F.col("cy")) | (F.col("y1") == F.col("y2")), F.col(x)) for r, x in (("r1", "x1"), ("r2", "x2"))]
    x_gap = F.col("s") * 1e-6 + F.greatest(F.abs("x1"), F.abs("x2")) * 1e-12
    rows = rows.select("*", F.greatest(F.least("x1", "x2"), F.least(x_at(low), x_at(high), *inside) - x_gap).alias("lo"),
                       F.least(F.greatest("x1", "x2"), F.greatest(x_at(low), x_at(high), *inside) + x_gap).alias("hi"))
    rows = rows.select("*", _cell(F.col("lo"), F.col("s")).alias("c1"), _cell(F.col("hi"), F.col("s")).alias("c2"))
    leaving = rows.filter(F.greatest("r1", "r2") > F.col("cy")).groupBy("ord", "lvl", "cy", F.col("c1").alias("cx")).agg(
        (F.count(F.lit(1)) % 2).cast("int").alias("odd")).filter("odd = 1")
    listed = rows.select("*", F.explode(F.sequence("c1", "c2")).alias("cx"))

    def height(r, x, y):
        return F.when((F.col(r) == F.col("cy")) & (_cell(F.col(x), F.col("s")) > F.col("cx")), F.col(y))

    listed = listed.groupBy("ord", "lvl", "cx", "cy").agg(F.collect_list(F.struct(
        "x1", "y1", "x2", "y2", height("r1", "x1", "y1").alias("t1"), height("r2", "x2", "y2").alias("t2"))).alias("edges"))
    marked = cells.select("ord", "lvl", "cx", "cy", "bb", F.lit(0).alias("odd"), F.lit(True).alias("cell")).unionByName(
        leaving.select("ord", "lvl", "cx", "cy", F.lit(None).cast(cells.schema["bb"].dataType).alias("bb"), "odd", F.lit(False).alias("cell")))
    to_the_right = Window.partitionBy("ord", "lvl", "cy").orderBy(-F.col("cx")).rangeBetween(Window.unboundedPreceding, -1)
    anchored = marked.withColumn("anchor", (F.coalesce(F.sum("odd").over(to_the_right), F.lit(0)) % 2).cast("int")).filter("cell")
    # merged: the planner counts one edge a cell, so its estimate is no reason to broadcast them
    return anchored.drop("odd", "cell").join(listed.hint("merge"), ["ord", "lvl", "cx", "cy"], "left").filter("edges is not null or anchor = 1")


def _edge_cells(polygons: DataFrame, base: float, least: float, order: str, rings: str, rounds: int) -> DataFrame:
    """All cells of all polygons (``_cell_edges``); dense ones are split ``rounds`` times."""
    bb = polygons.select(F.col(order).alias("ord"), ring_edges(rings).alias("es"), ring_bbox(rings).alias("bb"),
                         F.size(F.flatten(F.col(rings))).alias("nv"))
    bb = bb.select("ord", "es", "bb", _polygon_level(_extent("bb"), F.col("nv"), base, least).alias("lvl"))
    edges = bb.select("ord", "lvl", F.explode("es").alias("e")).select("ord", "lvl", "e.*")
    s = F.lit(base) * F.pow(F.lit(4.0), -F.col("lvl"))
    cells = bb.select("ord", "lvl", "bb", F.explode(F.sequence(_cell(F.col("bb.minx"), s), _cell(F.col("bb.maxx"), s))).alias("cx"))
    cells = cells.select("*", F.explode(F.sequence(_cell(F.col("bb.miny"), s), _cell(F.col("bb.maxy"), s))).alias("cy"))
    out = None
    for left in range(rounds, -1, -1):
        found = _cell_edges(edges, cells, base)
        if not left:
            return found if out is None else out.unionByName(found)
        found = materialize(found)
        done = found.filter(F.coalesce(F.size("edges"), F.lit(0)) <= DENSE_EDGES)
        out = done if out is None else out.unionByName(done)
        dense = found.filter(F.size("edges") > DENSE_EDGES)
        parts = F.sequence(F.lit(0).cast("long"), F.lit(SPLIT - 1).cast("long"))
        cells = dense.select("ord", (F.col("lvl") + 2).alias("lvl"), "bb", "cy", (F.col("cx") * SPLIT).alias("x0"), F.explode(parts).alias("i"))
        cells = cells.select("ord", "lvl", "bb", (F.col("x0") + F.col("i")).alias("cx"), (F.col("cy") * SPLIT).alias("y0"), F.explode(parts).alias("j"))
        cells = cells.select("ord", "lvl", "bb", "cx", (F.col("y0") + F.col("j")).alias("cy"))
        edges = edges.join(dense.select("ord", "lvl").distinct(), ["ord", "lvl"], "left_semi").withColumn("lvl", F.col("lvl") + 2)


def polygon_cells(polygons: DataFrame, base: float, least: float, order: str = "poly_id", rings: str = "rings",
                  rounds: int = 0) -> DataFrame:
    """One row per (level, cell): ``(lvl, cx, cy, cands)`` with ``cands`` = array of
    ``struct(ord, anchor, edges, bb)`` for every polygon that the cell's points may lie in: its
    edges in the cell and the parity of those outside it (edges null where it covers the cell).
    The array's order does not matter, overlaps are resolved by ordinal.

    Multi-level grid: a few huge polygons do not force a coarse grid onto many small ones, and
    a dense town of tiny polygons is spread over as many small cells."""
    cells = _edge_cells(polygons, base, least, order, rings, rounds)
    return cells.groupBy("lvl", "cx", "cy").agg(F.collect_list(F.struct("ord", "anchor", "edges", "bb")).alias("cands"))


def _extent(bb: str) -> Column:
    return F.greatest(F.col(f"{bb}.maxx") - F.col(f"{bb}.minx"), F.col(f"{bb}.maxy") - F.col(f"{bb}.miny"))


def _inside(px: Column, py: Column, boundary_inside: bool = True):
    none = F.array().cast("array<struct<x1:double,y1:double,x2:double,y2:double,t1:double,t2:double>>")

    def test(c):
        bb = c["bb"]
        in_box = (px >= bb["minx"]) & (px <= bb["maxx"]) & (py >= bb["miny"]) & (py <= bb["maxy"])
        return in_box & point_in_edges(px, py, F.coalesce(c["edges"], none), boundary_inside, c["anchor"])
    return test


#: attributes of more polygons than this are never broadcast
BROADCAST_POLYGONS = 10_000

# bytes per edge struct and per candidate, for the broadcast bound
_EDGE_BYTES, _CAND_BYTES = 72, 104


def _plan_grid(polygons: DataFrame, cell_size: float | None, broadcast_max_bytes: int, rings: str = "rings", stats: dict | None = None):
    """Cell edge of level 0, smallest extent, the grid levels in use by a layer of simple
    polygons and whether its cell table may be broadcast.

    Level 0 has cells as wide as the largest polygon (or ``cell_size``); each further level
    quarters them.  The levels in use are one small distinct job (their number is bounded by
    the logarithm of the extents' spread), none when all polygons are of one size class.
    The broadcast decision rests on a proven bound: every simple polygon is listed in at most
    4 cells of its level (9 when division rounding lands a bound exactly on a cell
    edge), and a candidate holds its ordinal, box and edges but no attributes, so the cell
    table holds at most ``9 x (vertices x edge bytes + polygons x candidate bytes)``.
    """
    st = stats or layer_stats(polygons)
    base = cell_size or st["hi"] or 1.0
    least = st["lo"] or base
    if st["hi"] <= base < 4 * least:
        levels = [0]
    else:
        ext = polygons.select(ring_bbox(rings).alias("b")).select(_level(_extent("b"), base, least).alias("lvl"))
        levels = sorted(r["lvl"] for r in ext.distinct().collect() if r["lvl"] is not None)
    bound = 9 * (st["nv"] * _EDGE_BYTES + st["n"] * _CAND_BYTES)
    return base, least, levels, bound <= broadcast_max_bytes


def _cell_table(polygons: DataFrame, cell_size: float | None, broadcast_max_bytes: int, order: str, stats: dict | None = None):
    """The cell table, the cell edge of level 0, the levels in use and whether the table may be
    broadcast.  A layer of simple polygons stays a plan (``_plan_grid``); with larger ones the
    table is written once (checkpoint), so that its levels and its size are measured."""
    st = stats or layer_stats(polygons)
    if st["mv"] <= SIMPLE_VERTICES:
        base, least, levels, broadcast = _plan_grid(polygons, cell_size, broadcast_max_bytes, stats=st)
        return polygon_cells(polygons, base, least, order), base, levels, broadcast
    base = cell_size or st["hi"] or 1.0
    cells = materialize(polygon_cells(polygons, base, st["lo"] or base, order, rounds=1 if st["mv"] <= 16_384 else 2))
    size = F.aggregate("cands", F.lit(0).cast("long"), lambda n, c: n + _CAND_BYTES + F.coalesce(F.size(c["edges"]), F.lit(0)) * _EDGE_BYTES)
    measured = cells.groupBy("lvl").agg(F.sum(size).alias("bytes"), F.count(F.lit(1)).alias("n")).collect()
    total = sum(r["bytes"] + 64 * r["n"] for r in measured)
    return cells, base, sorted(r["lvl"] for r in measured), total <= broadcast_max_bytes


def _with_ordinal(points: DataFrame, polygons: DataFrame, x: str, y: str, pick: str, cell_size: float | None,
                  broadcast_max_bytes: int, order: str, boundary_inside: bool, stats: dict | None = None) -> DataFrame:
    """Each point with ``__ord``: the highest (``pick="last"``) or lowest ordinal of the
    polygons containing it, or null.

    One equi-join per level in use on the point's cell (each cell table has one row per
    cell, so a point is never multiplied).  The exact test follows each join at once, and
    only the best ordinal goes on: no edges travel with the points through a later shuffle.
    The last step explodes a one-element array, which a later filter on the ordinal cannot
    be pushed through, so the test is evaluated once.
    """
    cells, base, levels, broadcast = _cell_table(polygons, cell_size, broadcast_max_bytes, order, stats)
    keep = [F.col(f"`{c}`") for c in points.columns]
    best_of = F.array_max if pick == "last" else F.array_min
    cur = points.select("*", F.lit(None).cast(polygons.schema[order].dataType).alias("__ord"))
    for lvl in levels:
        size = base * 4.0 ** -lvl
        right = cells.filter(F.col("lvl") == lvl).select(
            F.col("cx").alias("__cx"), F.col("cy").alias("__cy"), F.col("cands").alias("__cands"))
        right = F.broadcast(right) if broadcast else right
        # hashes beside the cell: the cells' aggregate partitioning is not reused, so a hot cell can be split
        if not broadcast:
            right = right.withColumn("__ch", F.xxhash64("__cx", "__cy")).hint("merge")
        keyed = cur.select(*keep, "__ord", _cell(F.col(x), size).alias("__cx"), _cell(F.col(y), size).alias("__cy"))
        if not broadcast:
            keyed = keyed.withColumn("__ch", F.xxhash64("__cx", "__cy"))
        on = ["__cx", "__cy"] if broadcast else ["__cx", "__cy", "__ch"]
        hits = F.filter(F.col("__cands"), _inside(F.col(x), F.col(y), boundary_inside))
        best = best_of(F.array_append(F.transform(hits, lambda c: c["ord"]), F.col("__ord")))
        cur = keyed.join(right, on, "left").select(*keep, F.coalesce(best, F.col("__ord")).alias("__ord"))
    return cur.select(*keep, F.explode(F.array("__ord")).alias("__ord"))


def tag_with_polygon(points: DataFrame, polygons: DataFrame, x: str, y: str, attrs: Sequence[str],
                     pick: str = "last", cell_size: float | None = None,
                     broadcast_max_bytes: int = 64 << 20, order: str = "poly_id",
                     boundary_inside: bool = True) -> DataFrame:
    """Every point with the attributes of the polygon containing it (null outside).

    Where polygons overlap, ``pick="last"`` takes the highest ordinal (the overlay the
    jobs used reports the last match), ``pick="first"`` the lowest; points on an edge or
    vertex count as inside unless ``boundary_inside=False``.  Exactly one output row per
    input point; attributes are joined on by the ordinal at the end, merged where the layer has
    many polygons: the planner's estimate of a loaded layer (compressed bytes, shared out over its
    columns) is far too low, and it would broadcast them through the driver.
    """
    st = layer_stats(polygons)
    tagged = _with_ordinal(points, polygons, x, y, pick, cell_size, broadcast_max_bytes, order, boundary_inside, st)
    keep = [F.col(f"`{c}`") for c in points.columns]
    if not attrs:
        return tagged.select(*keep, F.col("__ord").alias(order))
    table = polygons.groupBy(F.col(order).alias("__ord")).agg(F.max(F.struct(*[F.col(a) for a in attrs])).alias("__attrs"))
    # hashed as well, so that the points of one large polygon can be split; points outside all
    # polygons match nothing and are dealt by their place, not gathered under the null key
    table = table.withColumn("__oh", F.xxhash64("__ord"))
    table = table.hint("merge") if st["n"] > BROADCAST_POLYGONS else table
    dealt = F.when(F.col("__ord").isNull(), F.xxhash64(F.col(f"`{x}`"), F.col(f"`{y}`"))).otherwise(F.xxhash64("__ord"))
    joined = tagged.withColumn("__oh", dealt).join(table, ["__ord", "__oh"], "left")
    return joined.select(*keep, F.col("__ord").alias(order), *[F.col(f"__attrs.{a}").alias(a) for a in attrs])


def clip(points: DataFrame, polygons: DataFrame, x: str, y: str, cell_size: float | None = None,
         broadcast_max_bytes: int = 64 << 20, boundary_inside: bool = True, order: str = "poly_id") -> DataFrame:
    """The points inside (or, with ``boundary_inside``, on the boundary of) any
    polygon; point columns only."""
    tagged = _with_ordinal(points, polygons, x, y, "last", cell_size, broadcast_max_bytes, order, boundary_inside)
    return tagged.filter(F.col("__ord").isNotNull()).select(*[F.col(f"`{c}`") for c in points.columns])


# Coordinate systems understood by ``reproject``.
GRID_CRS = {"EPSG:27700"}                 # British National Grid (easting, northing)
OSGB_GEOGRAPHIC = {"EPSG:4277"}           # OSGB36 latitude/longitude
WGS_GEOGRAPHIC = {"EPSG:4326", "EPSG:4258"}  # WGS84 / ETRS89 latitude/longitude


def _crs_kind(crs: str) -> str:
    c = crs.upper()
    if c in GRID_CRS:
        return "grid"
    if c in OSGB_GEOGRAPHIC:
        return "osgb"
    if c in WGS_GEOGRAPHIC:
        return "wgs"
    raise NotImplementedError(f"coordinate system {crs} is not supported")


def reproject(df: DataFrame, x: str, y: str, src: str, dst: str) -> DataFrame:
    """Move points between the National Grid (x = easting, y = northing) and
    OSGB36 or WGS84/ETRS89 latitude/longitude (x = longitude, y = latitude, degrees).

    Equal systems are a no-op (the common case: both layers already in the grid).
    Grid <-> OSGB36 is the transverse Mercator projection (sub-millimetre); OSGB36 <->
    WGS84 is the published 7-parameter Helmert shift (good to a few metres; the
    grid-file transformation is not available here).  Output columns replace ``x``/``y``
    and carry the new CRS as metadata.
    """
    from landframe.functions import geodesy as GD
    a, b = _crs_kind(src), _crs_kind(dst)
    if a == b:
        return set_crs(df, [x, y], dst)
    # each stage writes its own column; the next stage reads plain values
    out = df.withColumn("__p", F.struct(F.col(y).cast("double").alias("lat"), F.col(x).cast("double").alias("lon")))
    if a == "grid":
        out = GD.latlon_from_grid(out, x, y, "__p")
        a = "osgb"
    if a == "wgs" and b != "wgs":
        out = out.withColumns({"__lat": F.col("__p.lat"), "__lon": F.col("__p.lon")})
        out = GD.osgb36_from_wgs84(out, "__lat", "__lon", "__p").drop("__lat", "__lon")
        a = "osgb"
    if a == "osgb" and b == "wgs":
        out = out.withColumns({"__lat": F.col("__p.lat"), "__lon": F.col("__p.lon")})
        out = GD.wgs84_from_osgb36(out, "__lat", "__lon", "__p").drop("__lat", "__lon")
    if b == "grid":
        out = out.withColumn("__p", GD.grid_from_latlon(F.col("__p.lat"), F.col("__p.lon")))
        out = out.withColumns({x: F.col("__p.e"), y: F.col("__p.n")})
    else:
        out = out.withColumns({x: F.col("__p.lon"), y: F.col("__p.lat")})
    return set_crs(out.drop("__p"), [x, y], dst)
