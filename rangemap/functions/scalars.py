"""Scalar functions: names, codes, scaling and small arithmetic."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Long names of climate variables.
CLIMATE = {
    "tmin": "TMIN - Minimum temperature",
    "tmax": "TMAX - Maximum temperature",
    "tavg": "TAVG - Average temperature",
    "prec": "Precipitation",
    "wind": "Wind speed",
    "srad": "Solar radiation",
}


# The characters that separate parts of a name.
SEPARATORS = r"[\s\-/\\.:;,()\[\]{}]"


def tidy_name(name: str) -> str:
    """Separators to _, lower case, only letters, digits and _, no runs of _ and none at the ends."""
    return re.sub(r"_+", "_", re.sub(r"[^a-z0-9_]", "", re.sub(SEPARATORS, "_", name).lower())).strip("_")


def tidy(name: Column) -> Column:
    """tidy_name of a column."""
    kept = F.regexp_replace(F.lower(F.regexp_replace(name, SEPARATORS, "_")), r"[^a-z0-9_]", "")
    return F.regexp_replace(F.regexp_replace(kept, r"_+", "_"), r"^_|_$", "")


def climate_name(code: str) -> str:
    """The long name of a climate variable, `bio5` included; other codes stay."""
    found = re.fullmatch(r"bio_?(\d+)", code)
    return f"Bioclimatic variable {found[1]}" if found else CLIMATE.get(code, code)


def identifier(latin_name: Column, activity: Column) -> Column:
    return F.concat_ws("_", latin_name, activity)


def species_code(latin_name: Column) -> Column:
    """`Myotis daubentonii` to `Myo_dau`."""
    words = F.split(latin_name, " ")
    return F.concat_ws("_", F.substring(words[0], 1, 3), F.substring(F.get(words, F.lit(1)), 1, 3))


def rural_roads(minor: Column, buildings: Column) -> Column:
    return F.greatest(minor - buildings, F.lit(0.0))


def woodland_split(height: Column, woodland: Column) -> tuple[Column, Column]:
    """Vegetation height inside and outside woodland, by its share in 0..1."""
    return height * woodland, height * (1 - woodland)


def clamp(value: Column, low: float, high: float) -> Column:
    """Null stays null: least and greatest alone would skip it."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(float(low))), F.lit(float(high))))


def percent(share: Column) -> Column:
    return F.round(share * 100)


def lower_bound(mean: Column, std: Column, z: float = 1.96) -> Column:
    return mean - z * std


def from_percent(value: Column) -> Column:
    """Integer per cent to a share; negatives are nodata."""
    return F.when(value >= 0, value / 100)


def nonzero(value: Column, eps: float = 1e-6) -> Column:
    """A value that may be divided by."""
    return value + F.lit(eps)


def no_nan(value: Column, sentinel: float | None = -9999.0, huge: float = 1e30) -> Column:
    """NaN, the sentinel and anything beyond huge as NULL."""
    value = value.cast("double")
    bad = F.isnan(value) | (F.abs(value) > huge)
    bad = bad | (value == F.lit(float(sentinel))) if sentinel is not None else bad
    return F.when(~bad, value)


def unit_hash(key: Column, seed: int = 42) -> Column:
    """A number in (0, 1) from an integer key by integer arithmetic alone, so that any SQL engine can repeat it."""
    mixed = F.pmod((F.pmod(key, F.lit(2147483647)) + seed) * F.lit(48271).cast("long"), F.lit(2147483647))
    mixed = F.pmod(mixed * F.lit(69621).cast("long") + 11, F.lit(2147483647))
    return (mixed + 1) / F.lit(2147483649.0)
