"""Terrain attributes from a cell table of heights: slope, aspect, curvature, wetness, flow accumulation."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import session as _session
from . import focal
from .raster import KEY


def _edges_as_centre(dem: str) -> dict[str, Column]:
    """The stencil's letters by place; a missing neighbour takes the centre's value."""
    places = {"a": "nw", "b": "north", "c": "ne", "d": "west", "f": "east", "g": "sw", "h": "south", "i": "se"}
    return {k: F.coalesce(F.col(f"n.{p}"), F.col(dem)).cast("double") for k, p in places.items()} | {"e": F.col(dem).cast("double")}


def _slope_aspect(dem: str, res: float) -> tuple[Column, Column]:
    """Slope in radians and aspect in degrees, of a row of focal.neighbours."""
    z = _edges_as_centre(dem)
    dx = ((z["c"] + 2 * z["f"] + z["i"]) - (z["a"] + 2 * z["d"] + z["g"])) / (8 * res)
    dy = ((z["a"] + 2 * z["b"] + z["c"]) - (z["g"] + 2 * z["h"] + z["i"])) / (8 * res)
    # dx grows to the east and dy to the north; water runs against both.
    aspect = F.pmod(F.degrees(F.atan2(-dx, -dy)) + 360.0, F.lit(360.0))
    known = F.col(dem).isNotNull()
    return F.when(known, F.atan(F.sqrt(dx * dx + dy * dy))), F.when(known & ((dx != 0) | (dy != 0)), aspect)


def slope_aspect(cells: DataFrame, dem: str, res: float, units: str = "radians", near: DataFrame | None = None) -> DataFrame:
    """row, col, slope (units), aspect (degrees clockwise from north; null where it is flat), by Horn's 3 x 3 weights."""
    at = near if near is not None else focal.neighbours(cells, dem)
    slope, aspect = _slope_aspect(dem, res)
    return at.select(*KEY, (F.degrees(slope) if units == "degrees" else slope).alias("slope"), aspect.alias("aspect"))


def slope_aspect_strict(cells: DataFrame, dem: str, res: float) -> DataFrame:
    """row, col, slope and aspect in degrees from central differences; null where any of the nine cells is missing.
    Aspect is (atan2(dy, -dx) + 360) mod 360, dy positive to the south."""
    at = focal.neighbours(cells, dem)
    names = ("nw", "north", "ne", "west", "east", "sw", "south", "se")
    full = F.col(dem).isNotNull()
    for p in names:
        full = full & F.col(f"n.{p}").isNotNull()
    dx, dy = (F.col("n.east") - F.col("n.west")) / (2 * res), (F.col("n.south") - F.col("n.north")) / (2 * res)
    slope = F.degrees(F.atan(F.sqrt(dx * dx + dy * dy)))
    aspect = F.pmod(F.degrees(F.atan2(dy, -dx)) + 360.0, F.lit(360.0))
    return at.select(*KEY, F.when(full, slope).alias("slope"), F.when(full, aspect).alias("aspect"))


def aspect_components(cells: DataFrame, aspect: str = "aspect") -> DataFrame:
    """cells with eastness = sin and northness = cos of the aspect in degrees."""
    return cells.withColumns({"eastness": F.sin(F.radians(aspect)), "northness": F.cos(F.radians(aspect))})


def weighted_aspect(cells: DataFrame, slope: str = "slope") -> DataFrame:
    """cells with the aspect's components weighted by the slope."""
    return cells.withColumns({"weighted_eastness": F.col(slope) * F.col("eastness"), "weighted_northness": F.col(slope) * F.col("northness")})


def _curvature(dem: str, res: float, kind: str) -> Column:
    z = _edges_as_centre(dem)
    d = ((z["d"] + z["f"]) / 2 - z["e"]) / (res * res)
    e = ((z["b"] + z["h"]) / 2 - z["e"]) / (res * res)
    f = (z["c"] + z["g"] - z["a"] - z["i"]) / (4 * res * res)
    g = (z["f"] - z["d"]) / (2 * res)
    h = (z["b"] - z["h"]) / (2 * res)
    steep = g * g + h * h
    if kind == "planform":
        value = -2 * (d * h * h + e * g * g - f * g * h) / steep * 100
    elif kind == "profile":
        value = 2 * (d * g * g + e * h * h + f * g * h) / steep * 100
    else:
        raise ValueError(f"no such curvature: {kind}")
    return F.when(F.col(dem).isNotNull(), F.when(steep == 0, F.lit(0.0)).otherwise(value))


def curvature(cells: DataFrame, dem: str, res: float, kind: str = "planform", near: DataFrame | None = None, name: str | None = None) -> DataFrame:
    """Planform or profile curvature of Zevenbergen and Thorne's surface, times 100; 0 where it is flat."""
    at = near if near is not None else focal.neighbours(cells, dem)
    return at.select(*KEY, _curvature(dem, res, kind).alias(name or f"{kind}_curvature"))


def flow_targets(cells: DataFrame, dem: str, near: DataFrame | None = None) -> DataFrame:
    """row, col, to_row, to_col: the neighbour of steepest drop, null at pits and flats; ties go to the first by place."""
    at = near if near is not None else focal.neighbours(cells, dem)
    steps = {"nw": (-1, -1), "north": (-1, 0), "ne": (-1, 1), "west": (0, -1), "east": (0, 1), "sw": (1, -1), "south": (1, 0), "se": (1, 1)}
    drops = F.array(*(F.struct(((F.col(dem) - F.col(f"n.{p}")) / math.hypot(*s)).alias("drop"), (-(F.col("row") + s[0])).alias("r"), (-(F.col("col") + s[1])).alias("c")) for p, s in steps.items()))
    best = F.array_max(F.filter(drops, lambda x: x["drop"] > 0))
    return at.filter(F.col(dem).isNotNull()).select(*KEY, (-best["r"]).alias("to_row"), (-best["c"]).alias("to_col"))


def flow_accumulation(cells: DataFrame, dem: str, near: DataFrame | None = None, rounds: int = 40) -> DataFrame:
    """row, col, flow: cells that drain through each cell along steepest drops, itself included.

    Pointer doubling: in round k a pointer spans 2^k steps and a sum all that arrives within them, so the rounds are the
    logarithm of the longest path. Drops are strict, so there are no cycles. A round has only cells with a pointer left and
    what arrives at others; sums of cells without one are set aside and added up at the end. Each round's table is written to
    the shared folder.
    """
    targets = flow_targets(cells, dem, near)
    state = _session.written(targets.select(*KEY, F.col("to_row").alias("nr"), F.col("to_col").alias("nc"), F.lit(1).cast("long").alias("flow")), "flow")
    aside = []
    for _ in range(rounds):
        aside.append(state.filter("nr is null").select(*KEY, "flow"))
        moving = state.filter("nr is not null")
        if moving.isEmpty():
            return reduce(DataFrame.unionByName, aside).groupBy(*KEY).agg(F.sum("flow").alias("flow"))
        arrived = moving.groupBy(F.col("nr").alias("row"), F.col("nc").alias("col")).agg(F.sum("flow").alias("more"))
        ahead = moving.select(F.col("row").alias("nr"), F.col("col").alias("nc"), F.col("nr").alias("nnr"), F.col("nc").alias("nnc"))
        jumped = moving.join(ahead, ["nr", "nc"], "left").select(*KEY, F.col("nnr").alias("nr"), F.col("nnc").alias("nc"), "flow")
        state = jumped.join(arrived, KEY, "full").select(*KEY, "nr", "nc", (F.coalesce("flow", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("flow"))
        state = _session.written(state, "flow")
    raise RuntimeError("flow paths did not end")


def wetness_index(cells: DataFrame, dem: str, res: float, floor: float = 0.001) -> DataFrame:
    """row, col, twi: ln(flow / max(slope in radians, floor))."""
    near = focal.neighbours(cells, dem)
    flow, slope = flow_accumulation(cells, dem, near), slope_aspect(cells, dem, res, near=near)
    return flow.join(slope, KEY).select(*KEY, F.log(F.col("flow") / F.greatest(F.col("slope"), F.lit(floor))).alias("twi"))


def terrain_attributes(cells: DataFrame, dem: str, res: float, slope_window: int = 3, tpi_window: int = 3, units: str = "radians") -> DataFrame:
    """The whole bundle per cell: slope, aspect components and their weighted forms, roughness, tpi, twi, planform
    curvature. The stencil's table is written once; all that a cell and its eight neighbours tell is one narrow step on it."""
    near = _session.written(focal.neighbours(cells.select(*KEY, dem), dem), "stencil")
    radians, aspect = _slope_aspect(dem, res)
    nine = [F.col(dem), *(F.col(f"n.{p}") for p in ("nw", "north", "ne", "west", "east", "sw", "south", "se"))]
    tpi = F.when(reduce(Column.__and__, (v.isNotNull() for v in nine)), F.col(dem) - reduce(Column.__add__, nine) / 9)
    base = near.select(*KEY, (F.degrees(radians) if units == "degrees" else radians).alias("slope"), aspect.alias("aspect"), radians.alias("_radians"), tpi.alias("tpi"), _curvature(dem, res, "planform").alias("planform_curvature"))
    out = weighted_aspect(aspect_components(base)).join(focal.focal_std(base.select(*KEY, "slope"), "slope", slope_window), KEY, "left")
    if tpi_window != 3:
        out = out.drop("tpi").join(focal.position_index(near.select(*KEY, dem), dem, tpi_window), KEY, "left")
    out = out.join(flow_accumulation(cells, dem, near), KEY, "left")
    twi = F.log(F.col("flow") / F.greatest(F.col("_radians"), F.lit(0.001)))
    return out.select(*KEY, "slope", "eastness", "northness", "weighted_eastness", "weighted_northness", "roughness", "tpi", twi.alias("twi"), "planform_curvature")
