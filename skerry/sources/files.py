"""File sources: points, user observation files, scene and tile catalogues; and a pluggable data source for catalogues."""

from __future__ import annotations

import glob
import math
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skerry.functions.geo import boxes_overlap
from skerry.functions.values import to_celsius

#: Header names taken for each field, in lower case.
POINT_NAMES = {
    "point_id": ("point_id", "id", "station_id", "station", "name", "site"),
    "lat": ("lat", "latitude", "y"),
    "lon": ("lon", "longitude", "x"),
}


def resolve_column(columns: list[str], field: str, override: str | None = None) -> str | None:
    """The column that holds a field: the override, which must exist, or the one known name; several are an error, none gives None."""
    if override is not None:
        if override not in columns:
            raise ValueError(f"no column {override!r} for {field}")
        return override
    hits = [c for c in columns if c.strip().lower() in POINT_NAMES[field]]
    if len(hits) > 1:
        raise ValueError(f"{field} is ambiguous: {', '.join(hits)}")
    return hits[0] if hits else None


def resolve_paths(path: str) -> list[str]:
    """A file, a folder's ``*.csv``, or a pattern; sorted. None found is an error."""
    found = sorted(glob.glob(os.path.join(path, "*.csv")) if os.path.isdir(path) else glob.glob(path))
    if not found:
        raise FileNotFoundError(path)
    return found


def read_points(spark: SparkSession, path: str, columns: dict[str, str] | None = None) -> DataFrame:
    """``point_id, lat, lon`` from a CSV file with a header; rows without numeric coordinates are dropped, missing ids numbered.

    Coordinates out of range and ids given twice are errors."""
    raw = spark.read.option("header", True).csv(path)
    columns = columns or {}
    at = {f: resolve_column(raw.columns, f, columns.get(f)) for f in POINT_NAMES}
    if at["lat"] is None or at["lon"] is None:
        raise ValueError(f"no latitude or longitude among {raw.columns}")
    stem = os.path.splitext(os.path.basename(path))[0]
    p = raw.withColumn("_n", F.monotonically_increasing_id())
    num = lambda c: F.expr(f"try_cast(`{c}` AS double)")
    p = p.select(F.trim(F.col(at["point_id"])).alias("point_id") if at["point_id"] else F.lit(None).cast("string").alias("point_id"), num(at["lat"]).alias("lat"), num(at["lon"]).alias("lon"), "_n")
    p = p.where("lat IS NOT NULL AND lon IS NOT NULL AND NOT isnan(lat) AND NOT isnan(lon)")
    if at["point_id"] is None:
        # a points list is small by nature: one file written by hand
        p = p.withColumn("point_id", F.format_string(f"{stem}_%04d", F.row_number().over(W.partitionBy(F.lit(0)).orderBy("_n"))))
    bad = p.where((F.abs("lat") > 90) | (F.abs("lon") > 180)).limit(3).collect()
    if bad:
        raise ValueError(f"coordinates out of range: {[tuple(r)[:3] for r in bad]}")
    twice = p.groupBy("point_id").count().where("count > 1").limit(3).collect()
    if twice:
        raise ValueError(f"ids given twice: {[r[0] for r in twice]}")
    return p.drop("_n")


def parse_wall_times(text: Column, zone: Column) -> Column:
    """UTC instants of texts: those with an offset as they say, others in the zone; a wall time that a clock change skips or
    that occurs twice is NULL. The session's time zone must be UTC."""
    own = F.regexp_like(text, F.lit(r"(Z|[+-]\d{2}:?\d{2})$"))
    naive = F.try_to_timestamp(F.when(~own, F.regexp_replace(text, "T", " ")))
    day = F.expr("INTERVAL 1 DAY")
    # the zone's offsets a day before and after; the instants that they give are the only ones possible
    tries = [naive - (F.from_utc_timestamp(t, zone) - t) for t in (naive - day, naive + day)]
    real = [F.coalesce(F.from_utc_timestamp(u, zone) == naive, F.lit(False)) for u in tries]
    one = F.when(real[0] & real[1], F.when(tries[0] == tries[1], tries[0])).when(real[0], tries[0]).when(real[1], tries[1])
    return F.when(own, F.try_to_timestamp(F.when(own, text))).otherwise(one)


def observations(raw: DataFrame, *, columns: dict[str, str], units: Column, zone: Column, low: float = -5.0, high: float = 45.0) -> DataFrame:
    """User observations with the named columns as ``station_id, time, value`` in Celsius and UTC; rows that can't be read are dropped,
    ``suspect`` tells values outside the plausible range."""
    for f in ("station_id", "time", "value"):
        if columns.get(f) not in raw.columns:
            raise ValueError(f"no column for {f}")
    v = to_celsius(F.expr(f"try_cast(`{columns['value']}` AS double)"), units)
    o = raw.select(F.col(columns["station_id"]).alias("station_id"), parse_wall_times(F.trim(F.col(columns["time"])), zone).alias("time"), v.alias("value"))
    return o.where("station_id IS NOT NULL AND time IS NOT NULL AND value IS NOT NULL AND NOT isnan(value)").withColumn("suspect", ~F.col("value").between(low, high))


def search_scenes(catalog: DataFrame, *, box: tuple[float, float, float, float], start: str, end: str, platforms: list[str] | None = None, cloud_max: float | None = None) -> DataFrame:
    """Scenes of a catalogue (``west..north, time, platform, cloud_cover``) in a box, from start to the end of the last day. A scene without
    a footprint is kept. All are predicates on columns that reach the scan."""
    c = catalog.where((F.col("time") >= F.lit(start).cast("timestamp")) & (F.col("time") < F.lit(end).cast("timestamp") + F.expr("INTERVAL 1 DAY")))
    known = boxes_overlap((F.col("west"), F.col("south"), F.col("east"), F.col("north")), tuple(F.lit(float(v)) for v in box))
    c = c.where(F.coalesce(known, F.lit(True)))
    if platforms:
        c = c.where(F.col("platform").isin(*platforms))
    return c.where(F.col("cloud_cover") < cloud_max * 100) if cloud_max is not None else c


def tile_bounds(name: Column) -> dict[str, Column]:
    """Bounds of a quarter-degree tile from its name (``..._n41x25_w070x75_...``: north edge and west edge)."""
    num = lambda g: F.regexp_extract(name, r"([ns])(\d{2})x(\d{2})_([ew])(\d{3})x(\d{2})", g)
    lat = (num(2).cast("double") + num(3).cast("double") / 100) * F.when(num(1) == "s", -1).otherwise(1)
    lon = (num(5).cast("double") + num(6).cast("double") / 100) * F.when(num(4) == "w", -1).otherwise(1)
    return {"west": lon, "south": lat - 0.25, "east": lon + 0.25, "north": lat}


def overview_level(native_m: float, wanted_m: float) -> int | None:
    """The overview (0 to 3, each of half the resolution before; 0 is half the native one) nearest to the wanted resolution on a
    scale of powers of two; None, the native resolution, up to one and a half times that."""
    if wanted_m <= 1.5 * native_m:
        return None
    return min(max(round(math.log2(wanted_m / native_m)) - 1, 0), 3)


def days_kept(granules: DataFrame, days: DataFrame) -> DataFrame:
    """Granules whose day is among the days; those of unknown day are kept."""
    known = granules.where("day IS NOT NULL").join(days.select("day").distinct(), "day", "left_semi")
    return known.unionByName(granules.where("day IS NULL").select(*known.columns))


def granule_day(name: Column, start: Column, end: Column) -> Column:
    """The day in a granule's name (8 digits), else that of the middle of its time range, else NULL."""
    s = F.regexp_extract(name, r"(\d{8})", 1)
    named = F.to_date(F.try_to_timestamp(F.when(s != "", s), F.lit("yyyyMMdd")))
    middle = F.to_date(F.timestamp_seconds(((F.unix_timestamp(start) + F.unix_timestamp(end)) / 2).cast("long")))
    return F.coalesce(named, middle)
