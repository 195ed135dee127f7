"""G4 maths: British National Grid transverse Mercator and the WGS84 <-> OSGB36 datum
shift, as native column expressions (the published National Grid formulas).

Iterations (meridional-arc inversion, geodetic latitude from cartesian coordinates)
run inside ``aggregate`` over a fixed ``sequence``, so the accumulator is one lambda
variable and the expression does not grow with the number of steps.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landframe.functions._util import as_col

# Airy 1830 ellipsoid and the National Grid projection constants.
AIRY_A, AIRY_B = 6377563.396, 6356256.909
F0 = 0.9996012717
LAT0, LON0 = math.radians(49.0), math.radians(-2.0)
E0, N0 = 400000.0, -100000.0
# GRS80 / WGS84 ellipsoid.
WGS_A, WGS_B = 6378137.000, 6356752.3141
# Helmert transformation WGS84 -> OSGB36 (metres, ppm, arc-seconds).
HELMERT_TO_OSGB = {"tx": -446.448, "ty": 125.157, "tz": -542.060, "s": 20.4894,
                   "rx": -0.1502, "ry": -0.2470, "rz": -0.8421}

ITERATIONS = 8


def _e2(a: float, b: float) -> float:
    return (a * a - b * b) / (a * a)


def _meridional_arc(phi: Column, a: float = AIRY_A, b: float = AIRY_B) -> Column:
    n = (a - b) / (a + b)
    d, s = phi - F.lit(LAT0), phi + F.lit(LAT0)
    return F.lit(b * F0) * (
        F.lit(1 + n + 1.25 * n ** 2 + 1.25 * n ** 3) * d
        - F.lit(3 * n + 3 * n ** 2 + 21 / 8 * n ** 3) * F.sin(d) * F.cos(s)
        + F.lit(15 / 8 * n ** 2 + 15 / 8 * n ** 3) * F.sin(2 * d) * F.cos(2 * s)
        - F.lit(35 / 24 * n ** 3) * F.sin(3 * d) * F.cos(3 * s))


def grid_from_latlon(lat_deg, lon_deg) -> Column:
    """OSGB36 latitude/longitude (degrees) -> ``struct(e, n)`` National Grid metres."""
    a, e2 = AIRY_A, _e2(AIRY_A, AIRY_B)
    phi, lam = F.radians(as_col(lat_deg)), F.radians(as_col(lon_deg))
    sp, cp, tp = F.sin(phi), F.cos(phi), F.tan(phi)
    w = F.lit(1.0) - F.lit(e2) * sp * sp
    nu = F.lit(a * F0) / F.sqrt(w)
    rho = F.lit(a * F0 * (1 - e2)) * F.pow(w, -1.5)
    eta2 = nu / rho - 1
    t2 = tp * tp
    dl = lam - F.lit(LON0)
    i = _meridional_arc(phi) + F.lit(N0)
    ii = nu / 2 * sp * cp
    iii = nu / 24 * sp * F.pow(cp, 3) * (5 - t2 + 9 * eta2)
    iiia = nu / 720 * sp * F.pow(cp, 5) * (61 - 58 * t2 + t2 * t2)
    iv = nu * cp
    v = nu / 6 * F.pow(cp, 3) * (nu / rho - t2)
    vi = nu / 120 * F.pow(cp, 5) * (5 - 18 * t2 + t2 * t2 + 14 * eta2 - 58 * t2 * eta2)
    north = i + ii * F.pow(dl, 2) + iii * F.pow(dl, 4) + iiia * F.pow(dl, 6)
    east = F.lit(E0) + iv * dl + v * F.pow(dl, 3) + vi * F.pow(dl, 5)
    return F.struct(east.alias("e"), north.alias("n"))


def _grid_phi(north: Column) -> Column:
    """Latitude (radians) whose meridional arc matches the northing: fixed iterations
    inside ``aggregate`` (one lambda variable; converges far below a millimetre)."""
    a = AIRY_A
    start = (north - F.lit(N0)) / F.lit(a * F0) + F.lit(LAT0)
    return F.aggregate(F.sequence(F.lit(1), F.lit(ITERATIONS)), start,
                       lambda acc, _i: acc + (north - F.lit(N0) - _meridional_arc(acc)) / F.lit(a * F0))


def _latlon_from_phi(phi: Column, east: Column) -> Column:
    a, e2 = AIRY_A, _e2(AIRY_A, AIRY_B)
    sp, cp, tp = F.sin(phi), F.cos(phi), F.tan(phi)
    w = F.lit(1.0) - F.lit(e2) * sp * sp
    nu = F.lit(a * F0) / F.sqrt(w)
    rho = F.lit(a * F0 * (1 - e2)) * F.pow(w, -1.5)
    eta2 = nu / rho - 1
    t2 = tp * tp
    sec = F.lit(1.0) / cp
    de = east - F.lit(E0)
    vii = tp / (2 * rho * nu)
    viii = tp / (24 * rho * F.pow(nu, 3)) * (5 + 3 * t2 + eta2 - 9 * t2 * eta2)
    ix = tp / (720 * rho * F.pow(nu, 5)) * (61 + 90 * t2 + 45 * t2 * t2)
    x = sec / nu
    xi = sec / (6 * F.pow(nu, 3)) * (nu / rho + 2 * t2)
    xii = sec / (120 * F.pow(nu, 5)) * (5 + 28 * t2 + 24 * t2 * t2)
    xiia = sec / (5040 * F.pow(nu, 7)) * (61 + 662 * t2 + 1320 * t2 * t2 + 720 * t2 * t2 * t2)
    lat = phi - vii * F.pow(de, 2) + viii * F.pow(de, 4) - ix * F.pow(de, 6)
    lon = F.lit(LON0) + x * de - xi * F.pow(de, 3) + xii * F.pow(de, 5) - xiia * F.pow(de, 7)
    return F.struct(F.degrees(lat).alias("lat"), F.degrees(lon).alias("lon"))


def latlon_from_grid(df: DataFrame, east: str, north: str, out: str) -> DataFrame:
    """National Grid metres -> ``out: struct(lat, lon)`` OSGB36 degrees.

    Two projections: the iterated latitude is its own column, so the series that uses
    it many times reads a value instead of re-running the iteration."""
    df = df.withColumn("__phi", _grid_phi(F.col(north).cast("double")))
    return df.withColumn(out, _latlon_from_phi(F.col("__phi"), F.col(east).cast("double"))).drop("__phi")


def _helmert(df: DataFrame, lat: str, lon: str, out: str, src: tuple[float, float],
             dst: tuple[float, float], p: dict, sign: float) -> DataFrame:
    """Geodetic (h = 0) on ``src`` ellipsoid -> cartesian -> Helmert -> geodetic on ``dst``.

    The cartesian coordinates are plain columns before the latitude iteration, so the
    iteration (a higher-order function, evaluated per element) only reads them."""
    a1, e21 = src[0], _e2(*src)
    a2, e22 = dst[0], _e2(*dst)
    phi, lam = F.radians(F.col(lat)), F.radians(F.col(lon))
    nu1 = F.lit(a1) / F.sqrt(F.lit(1.0) - F.lit(e21) * F.sin(phi) * F.sin(phi))
    x1 = nu1 * F.cos(phi) * F.cos(lam)
    y1 = nu1 * F.cos(phi) * F.sin(lam)
    z1 = F.lit(1 - e21) * nu1 * F.sin(phi)
    sec = math.pi / (180 * 3600)
    tx, ty, tz = (sign * p[k] for k in ("tx", "ty", "tz"))
    s = sign * p["s"] * 1e-6
    rx, ry, rz = (sign * p[k] * sec for k in ("rx", "ry", "rz"))
    df = df.withColumn("__xyz", F.struct(
        (F.lit(tx) + F.lit(1 + s) * x1 - F.lit(rz) * y1 + F.lit(ry) * z1).alias("x"),
        (F.lit(ty) + F.lit(rz) * x1 + F.lit(1 + s) * y1 - F.lit(rx) * z1).alias("y"),
        (F.lit(tz) - F.lit(ry) * x1 + F.lit(rx) * y1 + F.lit(1 + s) * z1).alias("z")))
    x2, y2, z2 = F.col("__xyz.x"), F.col("__xyz.y"), F.col("__xyz.z")
    df = df.withColumn("__pxy", F.sqrt(x2 * x2 + y2 * y2))
    pxy = F.col("__pxy")

    def step(acc, _i):
        nu = F.lit(a2) / F.sqrt(F.lit(1.0) - F.lit(e22) * F.sin(acc) * F.sin(acc))
        return F.atan2(z2 + F.lit(e22) * nu * F.sin(acc), pxy)

    phi2 = F.aggregate(F.sequence(F.lit(1), F.lit(ITERATIONS)), F.atan2(z2, pxy * F.lit(1 - e22)), step)
    df = df.withColumn(out, F.struct(F.degrees(phi2).alias("lat"), F.degrees(F.atan2(y2, x2)).alias("lon")))
    return df.drop("__xyz", "__pxy")


def osgb36_from_wgs84(df: DataFrame, lat: str, lon: str, out: str) -> DataFrame:
    """WGS84/ETRS89 degrees -> ``out: struct(lat, lon)`` OSGB36 degrees (7-parameter
    Helmert; metre-level)."""
    return _helmert(df, lat, lon, out, (WGS_A, WGS_B), (AIRY_A, AIRY_B), HELMERT_TO_OSGB, 1.0)


def wgs84_from_osgb36(df: DataFrame, lat: str, lon: str, out: str) -> DataFrame:
    """OSGB36 degrees -> ``out: struct(lat, lon)`` WGS84/ETRS89 degrees (the same
    Helmert parameters negated)."""
    return _helmert(df, lat, lon, out, (AIRY_A, AIRY_B), (WGS_A, WGS_B), HELMERT_TO_OSGB, -1.0)
