"""Planar geometry as column expressions. A ring is an array of [x, y]; a polygon an array of rings, holes included."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def edges(ring: Column) -> Column:
    """struct(x1, y1, x2, y2) of each edge of a line or a closed ring."""
    n = F.greatest(F.size(ring) - 1, F.lit(0))
    return F.zip_with(F.slice(ring, 1, n), F.slice(ring, 2, n), lambda p, q: F.struct(p[0].alias("x1"), p[1].alias("y1"), q[0].alias("x2"), q[1].alias("y2")))


def all_edges(rings: Column) -> Column:
    return F.flatten(F.transform(rings, edges))


def inside(x: Column, y: Column, rings: Column) -> Column:
    """Even-odd rule over all rings. Half-open: a point on a lower or left edge is inside, on an upper or right one not."""

    def crosses(e: Column) -> Column:
        return ((e["y1"] > y) != (e["y2"] > y)) & (x < (e["x2"] - e["x1"]) * (y - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"])

    return F.size(F.filter(all_edges(rings), crosses)) % 2 == 1


def ring_area(ring: Column) -> Column:
    """Shoelace area, always positive."""
    return F.abs(F.aggregate(edges(ring), F.lit(0.0), lambda s, e: s + (e["x1"] * e["y2"] - e["x2"] * e["y1"]))) / 2


def valid_ring(ring: Column) -> Column:
    """Closed, of four vertices or more, and not without area."""
    return F.coalesce((F.size(ring) >= 4) & (F.element_at(ring, 1) == F.element_at(ring, -1)) & (ring_area(ring) > 0), F.lit(False))


def box_of(rings: Column) -> Column:
    """struct(xmin, ymin, xmax, ymax) of all vertices."""
    at = lambda i: F.transform(F.flatten(rings), lambda p: p[i])
    return F.struct(F.array_min(at(0)).alias("xmin"), F.array_min(at(1)).alias("ymin"), F.array_max(at(0)).alias("xmax"), F.array_max(at(1)).alias("ymax"))


def meets_box(box: Column, bounds: tuple[float, float, float, float]) -> Column:
    """Boxes overlap: a superset of geometries that meet the bounds."""
    xmin, ymin, xmax, ymax = bounds
    return (box["xmin"] <= xmax) & (box["xmax"] >= xmin) & (box["ymin"] <= ymax) & (box["ymax"] >= ymin)


def segment_distance(x: Column, y: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Distance of a point to a segment; a segment of no length is a point."""
    dx, dy = x2 - x1, y2 - y1
    square = dx * dx + dy * dy
    t = F.when(square == 0, F.lit(0.0)).otherwise(F.least(F.greatest(((x - x1) * dx + (y - y1) * dy) / square, F.lit(0.0)), F.lit(1.0)))
    ex, ey = x - (x1 + t * dx), y - (y1 + t * dy)
    return F.sqrt(ex * ex + ey * ey)


def thinned(ring: Column, tolerance: float) -> Column:
    """Vertices snapped to the lattice of tolerance, with runs of equal ones made one. Snapping is the same for every
    ring, so shared borders stay shared."""
    snap = lambda v: F.round(v / tolerance) * tolerance
    points = F.transform(ring, lambda p: F.array(snap(p[0]), snap(p[1])))
    return F.filter(points, lambda p, i: (i == 0) | (p != F.element_at(points, F.greatest(i, F.lit(1)))))


# Ellipsoids (a, b), the datum shift from WGS 84 to OSGB 36 (metres, parts per million, arc seconds), and
# the National Grid's projection, as the Ordnance Survey publishes them.
WGS84 = (6378137.0, 6356752.3142)
AIRY = (6377563.396, 6356256.909)
SHIFT = {"tx": -446.448, "ty": 125.157, "tz": -542.060, "s": 20.4894, "rx": -0.1502, "ry": -0.2470, "rz": -0.8421}
GRID = {"k0": 0.9996012717, "lat0": 49.0, "lon0": -2.0, "e0": 400000.0, "n0": -100000.0}


def _series():
    a, b = AIRY
    n = (a - b) / (a + b)
    radius = a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = [n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240]
    beta = [n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480]
    delta = [2 * n - 2 * n**2 / 3 - 2 * n**3, 7 * n**2 / 3 - 8 * n**3 / 5, 56 * n**3 / 15]
    return n, radius, alpha, beta, delta


def _meridian0() -> float:
    """Northing of the true origin on the projection's own meridian, from the equator."""
    n, radius, alpha, _, _ = _series()
    phi, c = math.radians(GRID["lat0"]), 2 * math.sqrt(n) / (1 + n)
    t = math.sinh(math.atanh(math.sin(phi)) - c * math.atanh(c * math.sin(phi)))
    xi = math.atan(t)
    return GRID["k0"] * radius * (xi + sum(a * math.sin(2 * (j + 1) * xi) for j, a in enumerate(alpha)))


def _datum(df: DataFrame, lon: str, lat: str, back: bool) -> DataFrame:
    """Degrees on one datum to degrees on the other, at height 0; results in _lon and _lat."""
    (a1, b1), (a2, b2) = (AIRY, WGS84) if back else (WGS84, AIRY)
    sign = -1 if back else 1
    e1, e2 = 1 - b1**2 / a1**2, 1 - b2**2 / a2**2
    phi, lam = F.radians(lat), F.radians(lon)
    df = df.withColumn("_nu", F.lit(a1) / F.sqrt(1 - e1 * F.sin(phi) ** 2))
    df = df.withColumns({"_x": F.col("_nu") * F.cos(phi) * F.cos(lam), "_y": F.col("_nu") * F.cos(phi) * F.sin(lam), "_z": F.col("_nu") * (1 - e1) * F.sin(phi)})
    s = 1 + sign * SHIFT["s"] * 1e-6
    rx, ry, rz = (sign * math.radians(SHIFT[k] / 3600) for k in ("rx", "ry", "rz"))
    tx, ty, tz = (sign * SHIFT[k] for k in ("tx", "ty", "tz"))
    x, y, z = F.col("_x"), F.col("_y"), F.col("_z")
    df = df.withColumns({"_x": tx + s * x - rz * y + ry * z, "_y": ty + rz * x + s * y - rx * z, "_z": tz - ry * x + rx * y + s * z})
    df = df.withColumn("_p", F.sqrt(F.col("_x") ** 2 + F.col("_y") ** 2))
    df = df.withColumn("_u", F.atan(F.col("_z") * a2 / (F.col("_p") * b2)))
    second = (a2**2 - b2**2) / b2**2
    lat2 = F.atan((F.col("_z") + second * b2 * F.sin("_u") ** 3) / (F.col("_p") - e2 * a2 * F.cos("_u") ** 3))
    return df.withColumns({"_lat": F.degrees(lat2), "_lon": F.degrees(F.atan2("_y", "_x"))}).drop("_nu", "_x", "_y", "_z", "_p", "_u")


def _project(df: DataFrame) -> DataFrame:
    n, radius, alpha, _, _ = _series()
    c = 2 * math.sqrt(n) / (1 + n)
    df = df.withColumns({"_s": F.sin(F.radians("_lat")), "_d": F.radians(F.col("_lon") - GRID["lon0"])})
    df = df.withColumn("_t", F.sinh(F.atanh("_s") - c * F.atanh(c * F.col("_s"))))
    df = df.withColumns({"_xi": F.atan2(F.col("_t"), F.cos("_d")), "_eta": F.atanh(F.sin("_d") / F.sqrt(1 + F.col("_t") ** 2))})
    xi, eta = F.col("_xi"), F.col("_eta")
    east = eta + sum(a * F.cos(2 * (j + 1) * xi) * F.sinh(2 * (j + 1) * eta) for j, a in enumerate(alpha))
    north = xi + sum(a * F.sin(2 * (j + 1) * xi) * F.cosh(2 * (j + 1) * eta) for j, a in enumerate(alpha))
    k = GRID["k0"] * radius
    return df.withColumns({"_e": GRID["e0"] + k * east, "_n": GRID["n0"] - _meridian0() + k * north}).drop("_s", "_d", "_t", "_xi", "_eta", "_lat", "_lon")


def _unproject(df: DataFrame, x: str, y: str) -> DataFrame:
    n, radius, _, beta, delta = _series()
    k = GRID["k0"] * radius
    df = df.withColumns({"_xi": (F.col(y) - GRID["n0"] + _meridian0()) / k, "_eta": (F.col(x) - GRID["e0"]) / k})
    xi, eta = F.col("_xi"), F.col("_eta")
    df = df.withColumns({"_xi2": xi - sum(b * F.sin(2 * (j + 1) * xi) * F.cosh(2 * (j + 1) * eta) for j, b in enumerate(beta)), "_eta2": eta - sum(b * F.cos(2 * (j + 1) * xi) * F.sinh(2 * (j + 1) * eta) for j, b in enumerate(beta))})
    df = df.withColumn("_chi", F.asin(F.sin("_xi2") / F.cosh("_eta2")))
    lat = F.col("_chi") + sum(d * F.sin(2 * (j + 1) * F.col("_chi")) for j, d in enumerate(delta))
    return df.withColumns({"_la": F.degrees(lat), "_lo": GRID["lon0"] + F.degrees(F.atan2(F.sinh("_eta2"), F.cos("_xi2")))}).drop("_xi", "_eta", "_xi2", "_eta2", "_chi")


def reproject(points: DataFrame, source: int, target: int, x: str = "x", y: str = "y") -> DataFrame:
    """points with x, y moved between EPSG 4326 (longitude, latitude) and 27700, to a few metres."""
    if source == target:
        return points
    if (source, target) == (4326, 27700):
        out = _project(_datum(points, x, y, back=False))
        return out.withColumns({x: F.col("_e"), y: F.col("_n")}).drop("_e", "_n")
    if (source, target) == (27700, 4326):
        out = _datum(_unproject(points, x, y), "_lo", "_la", back=True)
        return out.withColumns({x: F.col("_lon"), y: F.col("_lat")}).drop("_lo", "_la", "_lon", "_lat")
    raise ValueError(f"no way from EPSG {source} to {target}")


def reproject_shapes(shapes: DataFrame, source: int, target: int) -> DataFrame:
    """shapes with rings moved as reproject moves points, vertex by vertex. (geom_id, part) names a row."""
    if source == target:
        return shapes
    key = ["geom_id", "part"]
    each = shapes.select(*key, F.posexplode("rings").alias("_r", "_ring")).select(*key, "_r", F.posexplode("_ring").alias("_v", "_p"))
    moved = reproject(each.select(*key, "_r", "_v", F.col("_p")[0].alias("x"), F.col("_p")[1].alias("y")), source, target)
    ring = moved.groupBy(*key, "_r").agg(F.sort_array(F.collect_list(F.struct("_v", F.array("x", "y").alias("p")))).alias("_ring"))
    ring = ring.select(*key, "_r", F.transform("_ring", lambda v: v["p"]).alias("_ring"))
    rings = ring.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("_r", "_ring"))).alias("_rings"))
    rings = rings.select(*key, F.transform("_rings", lambda r: r["_ring"]).alias("rings"))
    return shapes.drop("rings").join(rings, key).select(*shapes.columns)
