"""Missing values, statistics with explicit missing-value rules, and scalar conversions.

Missing is NULL everywhere behind a source; NaN is turned into NULL on the way in, since Spark orders NaN above every number.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PERCENTILE = re.compile(r"^p(100(?:\.0*)?|\d{1,2}(?:\.\d+)?)$")
PLAIN = ("mean", "median", "std", "min", "max", "sum")
STATS = (*PLAIN, *(f"nan{s}" for s in PLAIN), "count", "count_valid")


def null_nan(df: DataFrame, *columns: str) -> DataFrame:
    """NaN as NULL in the named columns (all float and double columns if none is named)."""
    names = columns or [f.name for f in df.schema.fields if f.dataType.simpleString() in ("float", "double")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in names})


def flag(predicate: Column) -> Column:
    """A predicate that is false where a value is missing."""
    return F.coalesce(predicate, F.lit(False))


def statistic(stat: str, v: Column, *, rows: Column | None = None) -> Column:
    """An aggregate by name.

    ``mean median std min max sum`` are missing if any value is; their ``nan`` forms skip missing values (``nansum`` of none
    is 0); ``count`` counts all rows, ``count_valid`` those with a value; ``p0``..``p100`` are percentiles of the values by linear
    interpolation. std divides by n. An unknown name raises ValueError.
    """
    rows = F.count(F.lit(1)) if rows is None else rows
    base = {"mean": F.avg, "median": F.median, "std": F.stddev_pop, "min": F.min, "max": F.max, "sum": F.sum}
    if stat in base:
        return F.when(F.count(v) == rows, base[stat](v))
    if stat == "nansum":
        return F.coalesce(F.sum(v), F.lit(0.0))
    if stat.startswith("nan") and stat[3:] in base:
        return base[stat[3:]](v)
    if stat == "count":
        return rows.cast("double")
    if stat == "count_valid":
        return F.count(v).cast("double")
    if m := PERCENTILE.match(stat):
        return F.percentile(v, float(m[1]) / 100)
    raise ValueError(f"unknown statistic {stat!r}; known: {', '.join(STATS)} and p0 to p100")


def to_celsius(v: Column, units: Column) -> Column:
    """Kelvin or Fahrenheit as Celsius; degC as it is; NULL for other units."""
    return F.when(units == "degC", v).when(units == "K", v - 273.15).when(units == "degF", (v - 32) * 5 / 9)


def digital_number(dn: Column, scale: float, offset: float, *, celsius: bool = False) -> Column:
    """A scaled integer as its physical value; 0 is no data."""
    v = F.when(dn != 0, dn * scale + offset)
    return v - 273.15 if celsius else v


def normalised_difference(a: Column, b: Column) -> Column:
    """(a - b) / (a + b); NULL where the sum is 0."""
    return F.try_divide(a - b, a + b)


def any_bit(flags: Column, *bits: int) -> Column:
    """Whether one of the bits is set; NULL for NULL."""
    return flags.bitwiseAND(F.lit(sum(1 << b for b in bits))) != 0


def wind_speed(u: Column, v: Column) -> Column:
    return F.sqrt(u * u + v * v)


def hourly_flux(joules: Column) -> Column:
    """J per square metre and hour as W per square metre."""
    return joules / 3600.0


def water_by_layer(layer: Column, water_is_land: Column) -> Column:
    """Water from a layer of either polarity; 0.5 and missing are not water."""
    return flag(F.when(water_is_land, layer < 0.5).otherwise(layer > 0.5))
