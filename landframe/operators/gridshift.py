"""G4 by a grid of shifts: the transformation of the desktop tools' grid files.

A shift table gives, at the nodes of a square grid, how far a point moves east and north; in
between, shifts are bilinear.  A point meets the four corners of its square in one equi-join.
The way back has no closed form and is iterated: a place whose shift leads to the point.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landframe.functions._util import qcol

#: bytes of a square in the joined table, for the broadcast bound
_SQUARE_BYTES = 96


def shift_squares(nodes: DataFrame) -> DataFrame:
    """Squares (``__c``, ``__r`` of the south-west node) with the shifts of their four corners from
    nodes ``(col, row, se, sn)``; squares that lack a corner are left out."""
    corners = F.array(*[F.struct((F.col("col") - i).alias("c"), (F.col("row") - j).alias("r"), F.lit(f"{i}{j}").alias("k")) for i in (0, 1) for j in (0, 1)])
    spread = nodes.select("se", "sn", F.explode(corners).alias("q")).select("q.*", "se", "sn")
    out = spread.groupBy(F.col("c").cast("long").alias("__c"), F.col("r").cast("long").alias("__r")).agg(
        F.count(F.lit(1)).alias("n"), *[F.max(F.when(F.col("k") == k, F.struct("se", "sn"))).alias(f"__s{k}") for k in ("00", "10", "01", "11")])
    return out.filter("n = 4").drop("n")


def _bilinear(part: str, t: Column, u: Column) -> Column:
    s = {k: F.col(f"__s{k}")[part] for k in ("00", "10", "01", "11")}
    return (1 - t) * (1 - u) * s["00"] + t * (1 - u) * s["10"] + (1 - t) * u * s["01"] + t * u * s["11"]


def grid_shift(points: DataFrame, x: str, y: str, nodes: DataFrame, cell: float, origin: tuple[float, float] = (0.0, 0.0),
               inverse: bool = False, iterations: int = 4, broadcast_max_bytes: int = 128 << 20) -> DataFrame:
    """``points`` moved by the shift table (``inverse``: back); other columns are kept.

    ``nodes`` is ``(col, row, se, sn)``: node (col, row) lies at ``origin + (col, row) * cell``.
    Points outside the table's squares, or without coordinates, get null coordinates.  The
    inverse takes ``iterations`` steps, each a join, as a step may cross into another square;
    with shifts that change by less than a thousandth over a distance, four steps are exact to
    a tenth of a micrometre.  The table is broadcast if its counted size allows, else both
    sides are shuffled by square and its hash.
    """
    squares = shift_squares(nodes)
    size = squares.agg(F.count(F.lit(1)).alias("n"), F.min("__c"), F.max("__c"), F.min("__r"), F.max("__r")).first()
    broadcast = size["n"] * _SQUARE_BYTES <= broadcast_max_bytes
    squares = F.broadcast(squares) if broadcast else squares.withColumn("__h", F.xxhash64("__c", "__r"))
    on = ["__c", "__r"] if broadcast else ["__c", "__r", "__h"]
    own = points.columns
    cur = points.select("*", qcol(x).cast("double").alias("__x"), qcol(y).cast("double").alias("__y"))
    for _ in range(iterations if inverse else 1):
        fx, fy = (F.col("__x") - origin[0]) / cell, (F.col("__y") - origin[1]) / cell
        if inverse and size["n"]:  # a step may end a hair outside the grid; its rim's shifts then lead on
            fx, fy = (F.least(F.greatest(f, F.lit(float(lo))), F.lit(hi + 1 - 1e-9)) for f, lo, hi in ((fx, *size[1:3]), (fy, *size[3:5])))
        placed = cur.withColumns({"__c": F.floor(fx).cast("long"), "__r": F.floor(fy).cast("long")})
        placed = placed.withColumns({"__t": fx - F.col("__c"), "__u": fy - F.col("__r")})
        if not broadcast:
            placed = placed.withColumn("__h", F.xxhash64("__c", "__r"))
        met = placed.join(squares, on, "left")
        se, sn = _bilinear("se", F.col("__t"), F.col("__u")), _bilinear("sn", F.col("__t"), F.col("__u"))
        start = [qcol(x).cast("double"), qcol(y).cast("double")]
        moved = [start[0] - se, start[1] - sn] if inverse else [start[0] + se, start[1] + sn]
        cur = met.select(*[qcol(c) for c in own], moved[0].alias("__x"), moved[1].alias("__y"))
    if inverse and size["n"]:
        near = 1e-6 * cell
        inside = (F.col("__x").between(origin[0] + size[1] * cell - near, origin[0] + (size[2] + 1) * cell + near)
                  & F.col("__y").between(origin[1] + size[3] * cell - near, origin[1] + (size[4] + 1) * cell + near))
        cur = cur.withColumns({"__x": F.when(inside, F.col("__x")), "__y": F.when(inside, F.col("__y"))})
    return cur.select(*[F.col("__x").alias(c) if c == x else F.col("__y").alias(c) if c == y else qcol(c) for c in own])
