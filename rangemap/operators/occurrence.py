"""Occurrence points: filters, annotation with layers, thinning to cells, stacking, counts."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .grid import GridSpec, with_cell
from .raster import KEY, bands_of

# The vocabulary of species, with common names where there is one, of genera, and how sources spell the
# activities.
SPECIES = {
    "Pipistrellus pipistrellus": "Common Pipistrelle",
    "Pipistrellus pygmaeus": "Soprano Pipistrelle",
    "Plecotus auritus": "Brown Long Eared",
    "Myotis mystacinus": "Whiskered",
    "Nyctalus noctula": "Noctule",
    "Myotis daubentonii": "Daubenton's",
    "Myotis nattereri": "Natterer's",
    "Nyctalus leisleri": "Leisler's",
    "Myotis brandtii": "Brandt's",
    "Pipistrellus nathusii": None,
    "Eptesicus serotinus": None,
}
GENERA = ["Pipistrellus", "Plecotus", "Myotis", "Nyctalus", "Eptesicus"]
ACTIVITIES = {"roost": "Roost", "roosting": "Roost", "in flight": "In flight", "foraging": "In flight"}

log = logging.getLogger(__name__)


def accurate(points: DataFrame, threshold: float = 100.0) -> DataFrame:
    """Records whose stated uncertainty is at most threshold, if there is such a column; an unknown one is dropped."""
    for name in ("coordinateUncertaintyInMeters", "accuracy"):
        if name in points.columns:
            return points.filter(F.col(name) <= threshold)
    return points


def with_weight(points: DataFrame, default: float = 1.0) -> DataFrame:
    return points if "weight" in points.columns else points.withColumn("weight", F.lit(default))


def filter_records(points: DataFrame, genus: str | None = None, latin_name: str | None = None, activity_type: str | None = None) -> DataFrame:
    """Rows that match every given value; a column that is absent only warns."""
    for name, value in {"genus": genus, "latin_name": latin_name, "activity_type": activity_type}.items():
        if value is None:
            continue
        if name in points.columns:
            points = points.filter(F.col(name) == value)
        else:
            log.warning("no column %s to filter by", name)
    return points


def among(df: DataFrame, **values: list | None) -> DataFrame:
    """Rows whose columns are in the given lists; None leaves a column alone."""
    for name, wanted in values.items():
        if wanted is not None:
            df = df.filter(F.col(name).isin(list(wanted)))
    return df


def succeeded(models: DataFrame) -> DataFrame:
    return models.filter((F.col("status") == "Success") & F.col("model_path").isNotNull())


def tidy_activity(activity: Column) -> Column:
    """One spelling for each known activity; others stay."""
    pairs = [x for k, v in ACTIVITIES.items() for x in (F.lit(k), F.lit(v))]
    return F.coalesce(F.create_map(*pairs)[F.lower(F.trim(activity))], activity)


def annotate(points: DataFrame, cells: DataFrame, spec: GridSpec, bands: list[str] | None = None, drop_missing: bool = True) -> DataFrame:
    """points with the bands of the cell each lies in. drop_missing: without a value in any band a point is dropped; else
    what is missing is null, and so is all of a point outside the grid. One equi-join."""
    bands = bands or bands_of(cells)
    keyed = with_cell(points, spec, inside=drop_missing)
    out = keyed.join(cells.select(*KEY, *bands), KEY, "inner" if drop_missing else "left")
    return out.na.drop(subset=bands) if drop_missing else out


def thin_to_cells(points: DataFrame, spec: GridSpec, by: list[str], order: str, tolerance: float = 50.0) -> DataFrame:
    """One point for each cell and value of by: of those within tolerance of their nearest cell centre, the first in order.

    A tolerance beyond half the cell size reaches neighbour cells' centres, but the nearest is always that of the cell a
    point lies in, unless it lies outside the grid; then the nearest edge cell counts.
    """
    keyed = with_cell(points, spec, inside=False)
    keyed = keyed.withColumns({"row": F.least(F.greatest("row", F.lit(0)), F.lit(spec.nrows - 1)), "col": F.least(F.greatest("col", F.lit(0)), F.lit(spec.ncols - 1))})
    dx, dy = F.col("x") - spec.x(F.col("col")), F.col("y") - spec.y(F.col("row"))
    near = keyed.filter(F.sqrt(dx * dx + dy * dy) <= tolerance)
    return first_of(near, [*by, *KEY], order)


def first_of(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row with the smallest order for each key. The minimum combines before the shuffle."""
    rest = [c for c in df.columns if c not in {*keys, order}]
    kept = df.groupBy(*keys).agg(F.min(F.struct(order, *rest)).alias("_first"))
    return kept.select(*(F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns))


def drop_in_presence_cells(background: DataFrame, presence: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Background points outside all cells that hold a presence (of the same by)."""
    keys = [*(by or []), *KEY]
    return background.join(presence.select(*keys).distinct(), keys, "left_anti")


def stack(presence: DataFrame, background: DataFrame) -> DataFrame:
    return presence.withColumn("class", F.lit(1)).unionByName(background.withColumn("class", F.lit(0)))


def background_size(n: Column, low: int = 1000, high: int = 10000, factor: int = 10) -> Column:
    """How many background points go with n presences."""
    return F.greatest(F.least(n * factor, F.lit(high)), F.lit(low))


def with_enough(df: DataFrame, by: list[str], least: int = 15) -> DataFrame:
    """Rows of groups of at least `least` rows."""
    return df.join(df.groupBy(*by).count().filter(F.col("count") >= least).select(*by), by, "left_semi")


def densest(background: DataFrame, n: int, by: list[str] | None = None, weight: str = "weight", order: str = "point_id") -> DataFrame:
    """The n points with the largest weight, of all or of each by; ties by order."""
    if not by:
        return background.orderBy(F.desc(weight), order).limit(n)
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(weight), order))
    return background.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def class_counts(training: DataFrame, by: str = "identifier") -> DataFrame:
    return training.groupBy(by).agg(F.count_if(F.col("class") == 1).alias("n_presence"), F.count_if(F.col("class") == 0).alias("n_background"))


def pairs(points: DataFrame) -> DataFrame:
    """Every species with every activity, whether or not they occur together."""
    return points.select("latin_name").distinct().crossJoin(points.select("activity_type").distinct())  # two vocabularies
