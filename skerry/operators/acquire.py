"""Selecting and shaping source rows: stations, granules, layers, levels, model output, and attributes of the result."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skerry.functions import times
from skerry.functions import triangles as T
from skerry.functions.geo import boxes_overlap
from skerry.operators.filters import beside


def find_stations(stations: DataFrame, spans: DataFrame, *, box: tuple[float, float, float, float], start: str, end: str, pad: float = 0.0) -> DataFrame:
    """Stations (``station_id, lat, lon``) within a padded box whose readings' span (``station_id, first, last``) meets the window."""
    w, s, e, n = box
    near = stations.where(F.col("lat").between(s - pad, n + pad) & F.col("lon").between(w - pad, e + pad))
    alive = spans.where((F.col("first") < F.lit(end).cast("timestamp") + F.expr("INTERVAL 1 DAY")) & (F.col("last") >= F.lit(start).cast("timestamp")))
    return near.join(alive.select("station_id"), "station_id", "left_semi")


def station_medians(readings: DataFrame, *, key: str = "station_id") -> DataFrame:
    """``key, lat, lon, n``: median position and number of readings of each station."""
    return readings.groupBy(key).agg(F.median("lat").alias("lat"), F.median("lon").alias("lon"), F.count("*").alias("n"))


def first_present(df: DataFrame, preferred: list[str], to: str) -> DataFrame:
    """Column ``to``: the first of the preferred variables that has a value; variables that the table lacks are passed over."""
    have = [c for c in preferred if c in df.columns]
    return df.withColumn(to, F.coalesce(*map(F.col, have)) if have else F.lit(None).cast("double"))


def meets_box(footprints: DataFrame, box: tuple[float, float, float, float], *, wkt: str = "wkt") -> DataFrame:
    """Rows whose footprint polygon meets a box; an unknown footprint is kept. Triangles of the footprint are tested, so a box within
    a hole is not met."""
    w, s, e, n = box
    frame = [(w, s), (e, s), (e, n), (w, n)]

    def hit(text: str | None) -> bool:
        if text is None:
            return True
        for polygon in T.parse_wkt(text):
            for tri in T.wrapped(T.triangulate(polygon)):
                t = [tuple(map(float, p)) for p in tri]
                # two convex figures are apart exactly if an edge of one has the other wholly on its outer side
                apart = any(all(T.orient(a[k - 1], a[k], p) < 0 for p in b) for a, b in ((t, frame), (frame, t)) for k in range(len(a)))
                if not apart:
                    return True
        return False

    schema = footprints.schema
    at = footprints.columns.index(wkt)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array([hit(x) for x in b.column(at).to_pylist()], pa.bool_()))

    return footprints.mapInArrow(run, schema)


def by_time_of_day(granules: DataFrame, *, lon: Column, wanted: str, night: tuple[float, float] = (19.0, 5.0), ts: str = "ts", tag: str = "tag") -> DataFrame:
    """Granules of ``night``, ``day`` or ``both`` by local solar hour; a day or night tag (D, N) that says otherwise drops the granule.
    Column ``solar_h`` is kept."""
    if wanted not in ("night", "day", "both"):
        raise ValueError(f"not a time of day: {wanted!r}")
    g = granules.withColumn("solar_h", times.solar_hour(F.col(ts), lon))
    dark = times.in_window(F.col("solar_h"), *night)
    if wanted == "both":
        return g
    g = g.where(dark if wanted == "night" else ~dark)
    return g.where(F.coalesce(F.col(tag) != F.lit("D" if wanted == "night" else "N"), F.lit(True)))


def swath_values(pixels: DataFrame, *, least: int, value: str = "sst", quality: str = "quality") -> DataFrame:
    """The value missing where its quality is below the least or unknown."""
    return pixels.withColumn(value, F.when((F.col(quality) >= least) & ~F.isnan(value), F.col(value)))


def aligned_layers(layers: DataFrame, *, core: list[str], others: list[str], keys: tuple[str, ...] = ("granule",)) -> DataFrame:
    """Layers in rows (``*keys, role, row, col, value``) side by side; granules in which a core role has no value at all are dropped."""
    roles = [*core, *others]
    wide = layers.groupBy(*keys, "row", "col").agg(*(F.max(F.when(F.col("role") == r, F.col("value"))).alias(r) for r in roles))
    whole = layers.where(F.col("role").isin(*core) & F.col("value").isNotNull()).groupBy(*keys).agg(F.countDistinct("role").alias("n")).where(F.col("n") == len(core))
    return wide.join(whole.select(*keys), list(keys), "left_semi")


def first_step_of_day(steps: DataFrame, *, keys: tuple[str, ...] = ("var", "level", "row", "col"), ts: str = "ts", value: str = "value") -> DataFrame:
    """``day, *keys, value`` of the first time step of each day."""
    g = steps.groupBy(F.to_date(ts).alias("day"), *keys)
    return g.agg(F.min_by(value, ts).alias("value"))


def level_channels(values: DataFrame, variables: dict[str, list[float | None]], *, keys: tuple[str, ...] = ("day", "row", "col")) -> DataFrame:
    """``<var>_<depth>m`` channels side by side from ``*keys, var, level, value``; a variable of level None is a surface field."""

    def label(d: float) -> str:
        return f"{d:g}".replace(".", "p") + "m"

    made = []
    for var, levels in variables.items():
        for d in levels:
            own = (F.col("var") == var) & (F.lit(True) if d is None else F.col("level") == d)
            made.append(F.max(F.when(own, F.col("value"))).alias(var if d is None else f"{var}_{label(d)}"))
    return values.groupBy(*keys).agg(*made)


def subset(field: DataFrame, *, box: tuple[float, float, float, float], start: str, end: str, step: float, depths: tuple[float, float] | None = None) -> DataFrame:
    """Rows of a field (``ts, lat, lon[, depth]``) in a box padded by one cell and a window; all are predicates that reach the scan."""
    w, s, e, n = box
    f = field.where(F.col("lat").between(s - step, n + step) & F.col("lon").between(w - step, e + step))
    f = f.where((F.col("ts") >= F.lit(start).cast("timestamp")) & (F.col("ts") < F.lit(end).cast("timestamp") + F.expr("INTERVAL 1 DAY")))
    return f if depths is None else f.where(F.col("depth").between(*depths))


def model_for(lat: Column, lon: Column) -> Column:
    """The regional model for a place: within North America's box, from 50 degrees north the northern one; NULL elsewhere."""
    inside = lat.between(20.0, 75.0) & lon.between(-170.0, -50.0)
    return F.when(inside & (lat >= 50), "hrrrak").when(inside, "hrrr")


def of_year_or_all(items: DataFrame, year: int) -> DataFrame:
    """Items of the year; if there is none, all of them."""
    found = items.agg(F.coalesce(F.max(F.col("year") == year), F.lit(False)).alias("_found"))
    return beside(items, found).where((F.col("year") == year) | ~F.col("_found")).drop("_found")


def dem_source(text: Column) -> Column:
    """The elevation model named first in a source text; NULL if none is."""
    t = F.lower(text)
    return F.when(t.startswith("cudem"), "cudem").when(t.startswith("gmrt"), "gmrt")


def scene_times(*tables: DataFrame) -> DataFrame:
    """``area, day, ts``: the distinct scene times over several sensors' tables."""
    out = None
    for t in tables:
        one = t.select("area", F.to_date("ts").alias("day"), "ts")
        out = one if out is None else out.unionByName(one)
    return out.distinct()


def coast_offsets(edges: DataFrame, res_m: float) -> DataFrame:
    """Where the coast cell (``coast_row, coast_col``) of an edge cell (``row, col``) lies from it, in metres to the east and north; rows
    count southward, so a coast south of the edge is negative."""
    return edges.withColumns({"east_m": (F.col("coast_col") - F.col("col")) * res_m, "north_m": (F.col("row") - F.col("coast_row")) * res_m})


def attributes(report: DataFrame, *, key: str) -> DataFrame:
    """``key, attrs``: each row's other columns as one JSON text, for the attributes of a result."""
    rest = [c for c in report.columns if c != key]
    return report.select(key, F.to_json(F.struct(*rest), {"ignoreNullFields": "false"}).alias("attrs"))


def fill_value_clash(df: DataFrame, fills: dict[str, float]) -> DataFrame:
    """``channel, n``: how often a fill value occurs as data; a writer refuses channels with any."""
    agg = df.agg(*(F.sum(F.coalesce((F.col(c) == v).cast("long"), F.lit(0))).alias(c) for c, v in fills.items()))
    return agg.unpivot([], list(fills), "channel", "n").where("n > 0") if len(fills) else agg.limit(0)


def time_axis(*series: DataFrame) -> DataFrame:
    """``ts``: the distinct instants of several series."""
    out = series[0].select("ts")
    for s in series[1:]:
        out = out.union(s.select("ts"))
    return out.where("ts IS NOT NULL").distinct()


def at_scene_time(scenes: DataFrame, snapshots: DataFrame, *, variables: list[str], sources: list[str], keys: tuple[str, ...] = ("ts", "row", "col")) -> DataFrame:
    """Channels ``<var>_<source>`` of snapshots (``source, ts, row, col, var, value``) at exactly the scenes' times; sources stand beside
    each other and never fill one another. A scene without a snapshot has missing values."""
    own = lambda v, s: F.max(F.when((F.col("var") == v) & (F.col("source") == s), F.col("value"))).alias(f"{v}_{s}")
    wide = snapshots.groupBy(*keys).agg(*(own(v, s) for v in variables for s in sources))
    return scenes.join(wide, list(keys), "left")


def boxes_meeting(a: DataFrame, box: tuple[float, float, float, float]) -> DataFrame:
    """Rows whose west..north box overlaps a box (touching edges don't), or isn't known."""
    known = boxes_overlap(tuple(F.col(c) for c in ("west", "south", "east", "north")), tuple(F.lit(float(v)) for v in box))
    return a.where(F.coalesce(known, F.lit(True)))
