"""Land-cover classes: binary layers, areas, shares, broad habitats."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .grid import GridSpec
from .raster import KEY, bands_of, coarsen_sum

# Codes and labels of the 2023 land-cover map.
CODES = {
    1: "Broadleaved Woodland", 2: "Coniferous Woodland", 3: "Arable and Horticulture", 4: "Improved Grassland",
    5: "Neutral Grassland", 6: "Calcareous Grassland", 7: "Acid Grassland", 8: "Fen, Marsh and Swamp", 9: "Heather",
    10: "Heather Grassland", 11: "Bog", 12: "Inland Rock", 13: "Saltwater", 14: "Freshwater", 15: "Supra-littoral Rock",
    16: "Supra-littoral Sediment", 17: "Littoral Rock", 18: "Littoral Sediment", 19: "Saltmarsh", 20: "Urban",
    21: "Suburban", 22: "Inland Bare Ground", 23: "Coastal Bare Ground", 24: "Marine, Littoral",
}
# Broad habitats and the labels they gather, matched without regard to case or hyphens.
HABITATS = {
    "Grassland": ["Neutral grassland", "Calcareous grassland", "Acid grassland"],
    "Marine, Littoral": ["Saltwater", "Supralittoral rock", "Supralittoral sediment", "Littoral rock", "Littoral sediment", "Saltmarsh"],
    "Upland Heathland": ["Heather and shrub", "Heather grassland"],
    "Wetland": ["Bog", "Fen, Marsh and Swamp"],
}


def binary_layers(cells: DataFrame, band: str, classes: dict[int, str], null_as_zero: bool = False) -> DataFrame:
    """row, col and a layer of 0 and 1 per class; nodata stays null, or is 0 with null_as_zero."""

    def layer(code: int):
        hit = (F.col(band) == code).cast("double")
        return F.coalesce(hit, F.lit(0.0)) if null_as_zero else hit

    return cells.select(*KEY, *(layer(code).alias(name) for code, name in classes.items()))


def as_area(layers: DataFrame, cell_size: float) -> DataFrame:
    """Binary layers as square metres of the cells they come from; null as 0."""
    return layers.select(*KEY, *((F.coalesce(b, F.lit(0.0)) * float(cell_size**2)).alias(b) for b in bands_of(layers)))


def _same(name: str) -> str:
    return name.lower().replace("-", "").replace(" ", "")


def aggregate_layers(layers: DataFrame, groups: dict[str, list[str]], drop: list[str] | None = None) -> DataFrame:
    """Each group's member layers summed, nulls as 0, in place of the members; then layers of drop are left out. A group
    without members here is skipped."""
    for name, wanted in groups.items():
        known = {_same(b): b for b in bands_of(layers)}
        members = [known[_same(w)] for w in wanted if _same(w) in known]
        if members:
            total = sum((F.coalesce(F.col(f"`{m}`"), F.lit(0.0)) for m in members[1:]), F.coalesce(F.col(f"`{members[0]}`"), F.lit(0.0)))
            layers = layers.withColumn("_sum", total).drop(*members).withColumnRenamed("_sum", name)
    return layers.drop(*(drop or []))


def only_groups(layers: DataFrame, groups: dict[str, list[str]], drop: list[str] | None = None) -> DataFrame:
    """Only the groups' sums, null where a member is null; drop acts on group names."""
    known = {_same(b): b for b in bands_of(layers)}
    made = []
    for name, wanted in groups.items():
        members = [F.col(f"`{known[_same(w)]}`") for w in wanted if _same(w) in known]
        if members and name not in (drop or []):
            made.append(sum(members[1:], members[0]).alias(name))
    return layers.select(*KEY, *made)


def cover(cells: DataFrame, spec: GridSpec, band: str, k: int, classes: dict[int, str] = CODES, groups: dict[str, list[str]] = HABITATS, drop: list[str] | None = None) -> DataFrame:
    """The land-cover job: class layers, their area, strict sums over k x k blocks, broad habitats."""
    area = as_area(binary_layers(cells, band, classes), spec.res)
    return aggregate_layers(coarsen_sum(area, spec, k, strict=True), groups, drop)
