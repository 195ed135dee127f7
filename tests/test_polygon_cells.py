"""Edges clipped to grid cells: equal to the test against all edges, whatever the shape."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from landframe.operators import spatial as G


def star(rng, cx, cy, r, n, jag=0.9):
    """A ring of ``n`` vertices around a centre, with spikes."""
    pts = []
    for i in range(n):
        d = r * (1 - jag * rng.random())
        pts.append((cx + d * math.cos(2 * math.pi * i / n), cy + d * math.sin(2 * math.pi * i / n)))
    return pts


def comb(x, y, teeth, height):
    """Long edges: ``teeth`` spikes of ``height`` on whole coordinates."""
    pts = [(x, y)]
    for i in range(teeth):
        pts += [(x + 2 * i + 1, y + height), (x + 2 * i + 2, y + 1)]
    return [*pts, (x + 2 * teeth, y)]


def steps(x, y, n):
    """A staircase on whole coordinates."""
    pts = [(x, y)]
    for i in range(n):
        pts += [(x + i + 1, y + i), (x + i + 1, y + i + 1)]
    return [*pts, (x, y + n)]


def contains(rings, px, py):
    """Every edge of every ring, as the definition says (NumPy, all points at once)."""
    n, on = np.zeros(len(px), int), np.zeros(len(px), bool)
    for ring in rings:
        ring = [*ring, ring[0]]
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            with np.errstate(divide="ignore", invalid="ignore"):
                n += ((y1 > py) != (y2 > py)) & (px < (x2 - x1) * (py - y1) / (y2 - y1) + x1)
            on |= (((px - x1) * (y2 - y1) - (py - y1) * (x2 - x1)) == 0) & (px >= min(x1, x2)) & (px <= max(x1, x2)) \
                & (py >= min(y1, y2)) & (py <= max(y1, y2))
    return on | (n % 2 == 1)


def layers():
    rng = random.Random(4)
    yield "stars with holes", [
        (i, f"p{i}", [star(rng, 50 * i, 30 * (i % 3), 40, 40 + 300 * i, 0.5), star(rng, 50 * i, 30 * (i % 3), 15, 20 + 9 * i, 0.3)]) for i in range(1, 6)]
    yield "long edges", [(1, "comb", [comb(0, 0, 150, 97)]), (2, "over", [comb(3, 1, 60, 40)]), (3, "box", [[(10, 5), (20, 5), (20, 9), (10, 9)]])]
    yield "whole coordinates", [(1, "steps", [steps(0, 0, 70)]), (2, "more", [steps(-30, 10, 50)]), (3, "big", [[(-40, -5), (90, -5), (90, 80), (-40, 80)]]),
                                (4, "dot", [[(3, 3), (3, 3), (3, 3)]])]
    far = 4_000_000.0  # far from the origin: clipping rounds more
    yield "far away", [(1, "ring", [[(far + x, far + y) for x, y in star(rng, 0, 0, 1, 700, 0.2)], [(far + x, far + y) for x, y in star(rng, 0, 0, 0.3, 90, 0.2)]])]


@pytest.mark.parametrize("name,rows", list(layers()), ids=lambda v: v if isinstance(v, str) else "")
@pytest.mark.parametrize("broadcast", [64 << 20, 0])
def test_equal_to_all_edges(spark, name, rows, broadcast):
    rng = random.Random(9)
    xs = [p[0] for r in rows for ring in r[2] for p in ring]
    ys = [p[1] for r in rows for ring in r[2] for p in ring]
    pts = [(rng.uniform(min(xs) - 1, max(xs) + 1), rng.uniform(min(ys) - 1, max(ys) + 1)) for _ in range(3000)]
    if name in ("long edges", "whole coordinates"):
        pts += [(float(round(x)), float(round(y))) for x, y in pts] + [(x / 2, round(y) / 2) for x, y in pts[:500]]
    some = [p for r in rows for ring in r[2] for p in ring]
    pts += [(float(x), float(y)) for x, y in rng.sample(some, min(600, len(some)))]  # vertices
    px, py = np.array([p[0] for p in pts]), np.array([p[1] for p in pts])
    inside = {r[0]: contains(r[2], px, py) for r in rows}
    want = {i: max((k for k in inside if inside[k][i]), default=None) for i in range(len(pts))}
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(pts)], "id int, x double, y double")
    layer = G.polygon_layer(spark, rows, "name string")
    got = {r["id"]: r["poly_id"] for r in G.tag_with_polygon(df, layer, "x", "y", [], broadcast_max_bytes=broadcast).collect()}
    assert got == want
    assert len({v for v in want.values()}) > 1


def test_cost_of_a_point_does_not_follow_the_vertices(spark):
    """Edges listed per cell stay few, and cells in all about as many as edges."""
    rng = random.Random(2)
    for n in (1_000, 30_000):
        ring = [(math.cos(2 * math.pi * i / n) * (1 + 0.001 * rng.random()), math.sin(2 * math.pi * i / n)) for i in range(n)]
        layer = G.polygon_layer(spark, [(1, "coast", [ring])], "name string")
        cells, _, levels, broadcast = G._cell_table(layer, None, 64 << 20, "poly_id")
        sizes = cells.select(F.explode("cands").alias("c")).select(F.coalesce(F.size("c.edges"), F.lit(0)).alias("n"))
        row = sizes.agg(F.max("n").alias("most"), F.sum("n").alias("listed"), F.count(F.lit(1)).alias("cells"),
                        F.sum((F.col("n") == 0).cast("int")).alias("covered")).first()
        assert row["most"] <= 40 and row["listed"] < 3 * n and row["cells"] < 4 * n and row["covered"] > 0 and len(levels) <= 3 and broadcast
