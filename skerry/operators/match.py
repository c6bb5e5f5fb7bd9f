"""Matching in time and space: nearest instants, brackets, existence, nearest places."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skerry.functions.geo import Grid, haversine_km
from skerry.operators.regular import finite


def _us(c: str) -> Column:
    return F.unix_micros(F.col(c).cast("timestamp"))


def value_at(targets: DataFrame, readings: DataFrame, *, key: str, target_id: str, at: str, time: str, value: str, tolerance_s: int) -> DataFrame:
    """``target_id, value, dt_min`` of the nearest finite reading of the same key within the tolerance (inclusive).

    dt_min is signed, reading minus target; of equal distances the earlier reading counts, then the smaller value. Targets without a
    reading have NULL. Both sides are bucketed by key and time, each target looking into three buckets, so a hot key is spread
    over its buckets.
    """
    size = tolerance_s * 1_000_000
    t = targets.select(F.col(target_id).alias("id"), F.col(key).alias("k"), _us(at).alias("t0"))
    look = t.withColumn("b", F.explode(F.sequence(F.floor((F.col("t0") - size) / size), F.floor((F.col("t0") + size) / size))))
    r = readings.select(F.col(key).alias("k"), _us(time).alias("t"), F.col(value).cast("double").alias("v")).where(finite(F.col("v")))
    r = r.withColumn("b", F.floor(F.col("t") / size))
    m = look.join(r, ["k", "b"]).where(F.abs(F.col("t") - F.col("t0")) <= size)
    best = m.groupBy("id").agg(F.min(F.struct(F.abs(F.col("t") - F.col("t0")).alias("d"), "t", "v", "t0")).alias("m"))
    return t.select("id").join(best, "id", "left").select(F.col("id").alias(target_id), F.col("m.v").alias("value"), ((F.col("m.t") - F.col("m.t0")) / 60e6).alias("dt_min"))


def coincident(left: DataFrame, right: DataFrame, *, at: str, time: str, tolerance_s: int, key: str | None = None) -> DataFrame:
    """The left rows that have a right row within the tolerance (inclusive), of the same key if one is named."""
    size = tolerance_s * 1_000_000
    r = right.select(*([F.col(key).alias("k_")] if key else []), _us(time).alias("t_")).where("t_ IS NOT NULL")
    r = r.withColumn("b_", F.explode(F.sequence(F.floor((F.col("t_") - size) / size), F.floor((F.col("t_") + size) / size))))
    x = left.withColumn("t0_", _us(at)).withColumn("b0_", F.floor(F.col("t0_") / size))
    on = (F.col("b0_") == F.col("b_")) & (F.abs(F.col("t0_") - F.col("t_")) <= size)
    if key:
        on = on & (x[key] == F.col("k_"))
    return x.join(r, on, "left_semi").drop("t0_", "b0_")


def bracket(targets: DataFrame, series: DataFrame, *, key: str, target_id: str, at: str, time: str, value: str, block_days: int = 30) -> DataFrame:
    """``target_id, t0, t1, v1, t2, v2``: the last value at or before and the first at or after each target (us; NULL if none).

    Rows of one key and time block are ordered together; values from beyond a block come from the ends of the other blocks, so no
    task orders the whole of a hot key. Looking on is by ``lead``: Spark runs a frame that reaches to the end again for every row.
    """
    size = block_days * 86_400_000_000
    s = series.select(F.col(key).alias("k"), _us(time).alias("t"), F.col(value).cast("double").alias("v")).where(finite(F.col("v")) & F.col("t").isNotNull())
    s = s.groupBy("k", "t").agg(F.min("v").alias("v")).select("k", "t", F.struct("t", "v").alias("p"), F.lit(None).cast("string").alias("id"))
    q = targets.select(F.col(key).alias("k"), _us(at).alias("t"), F.lit(None).cast("struct<t:bigint,v:double>").alias("p"), F.col(target_id).cast("string").alias("id")).where("t IS NOT NULL AND id IS NOT NULL")
    u = s.unionByName(q).withColumn("block", F.floor(F.col("t") / size))
    w = W.partitionBy("k", "block").orderBy("t")
    u = u.withColumns({"p1": F.last("p", True).over(w.rangeBetween(W.unboundedPreceding, W.currentRow)), "p2": F.expr("lead(p) IGNORE NULLS OVER (PARTITION BY k, block ORDER BY t)")})
    u = u.withColumn("p2", F.when(F.col("p1.t") == F.col("t"), F.col("p1")).otherwise(F.col("p2")))
    ends = u.groupBy("k", "block").agg(F.min("p").alias("first"), F.max("p").alias("last"))
    wb = W.partitionBy("k").orderBy("block")
    ends = ends.select("k", "block", F.last("last", True).over(wb.rowsBetween(W.unboundedPreceding, -1)).alias("b1"), F.expr("lead(first) IGNORE NULLS OVER (PARTITION BY k ORDER BY block)").alias("b2"))
    out = u.where("id IS NOT NULL").join(ends, ["k", "block"]).withColumns({"p1": F.coalesce("p1", "b1"), "p2": F.coalesce("p2", "b2")})
    return out.select(F.col("id").alias(target_id), F.col("k").alias(key), F.col("t").alias("t0"), F.col("p1.t").alias("t1"), F.col("p1.v").alias("v1"), F.col("p2.t").alias("t2"), F.col("p2.v").alias("v2"))


def value_between(targets: DataFrame, series: DataFrame, **names) -> DataFrame:
    """``target_id, key, value``: linear interpolation at each target; NULL outside the series (no clamping)."""
    b = bracket(targets, series, **names)
    share = (F.col("t0") - F.col("t1")) / (F.col("t2") - F.col("t1"))
    v = F.when(F.col("t1") == F.col("t2"), F.col("v1")).when(F.col("t1").isNotNull() & F.col("t2").isNotNull(), F.col("v1") + share * (F.col("v2") - F.col("v1")))
    return b.select(names["target_id"], names["key"], v.alias("value"))


def station_cells(stations: DataFrame, grid: Grid, water: DataFrame | None = None) -> DataFrame:
    """``station_id, row, col, inside, snap_m`` of stations (``station_id, x, y``).

    With ``water`` (``row, col`` of water cells) a station inside the grid goes to the nearest water cell by centre (of equals the
    smaller row, then column), ``snap_m`` telling how far from its own cell's centre.
    """
    row, col = grid.cell(F.col("x"), F.col("y"))
    s = stations.withColumns({"row": row, "col": col}).withColumn("inside", grid.inside(F.col("row"), F.col("col"))).select("station_id", "row", "col", "inside")
    if water is None:
        return s.withColumn("snap_m", F.lit(0.0))
    # cells are looked up by the column they share, so the search is one join on a key for each column of the grid
    w = water.groupBy(F.col("col").alias("wc")).agg(F.sort_array(F.collect_set("row")).alias("rows"))
    inside = s.where("inside").withColumn("wc", F.explode(F.sequence(F.lit(0), F.lit(grid.width - 1)))).join(w, "wc")
    gap = lambda r: F.abs(r - F.col("row"))
    best_row = F.array_min(F.transform("rows", lambda r: F.struct(gap(r).alias("g"), r.alias("r"))))
    d = inside.withColumn("b", best_row).withColumn("d2", F.pow(F.col("b.g"), 2) + F.pow(F.col("wc") - F.col("col"), 2))
    near = d.groupBy("station_id").agg(F.min(F.struct("d2", F.col("b.r").alias("r"), "wc")).alias("n"))
    j = s.join(near, "station_id", "left")
    return j.select("station_id", F.coalesce("n.r", "row").cast("int").alias("row"), F.coalesce("n.wc", "col").cast("int").alias("col"), "inside", (F.sqrt(F.coalesce("n.d2", F.lit(0.0))) * grid.res).alias("snap_m"))


def insitu_by_cell(matches: DataFrame, stations: DataFrame) -> DataFrame:
    """``row, col, day, target, value, dt_min, n`` from matches (``station_id, day, target, value, dt_min``) and the stations' cells.

    Values and signed minutes are means over the matched stations of a cell; ``n`` counts the stations placed in the cell, whether
    or not they match.
    """
    placed = stations.where("inside").groupBy("row", "col").agg(F.countDistinct("station_id").alias("n"))
    m = matches.where("value IS NOT NULL").join(stations.where("inside").select("station_id", "row", "col"), "station_id")
    means = m.groupBy("row", "col", "day", "target").agg(F.avg("value").alias("value"), F.avg("dt_min").alias("dt_min"))
    return means.join(placed, ["row", "col"])


def assign_to_area(points: DataFrame, areas: DataFrame) -> DataFrame:
    """``point_id, area, metric``: each point (``point_id, lat, lon``) to the area (``area, west, south, east, north``) that
    contains it, of several the one with the nearest centre, then the first by name; points in none are dropped. Longitudes
    are the same modulo 360, so an area may go on past 180 degrees.

    Areas and points meet in the whole degrees that an area covers, so the join is on a key.
    """
    turn = lambda c: F.pmod(F.floor(c), F.lit(360))
    columns = F.array_distinct(F.transform(F.sequence(F.floor("west"), F.floor("east")), lambda c: F.pmod(c, F.lit(360).cast("long"))))
    a = areas.where("west <= east AND south <= north").withColumn("ty", F.explode(F.sequence(F.floor("south"), F.floor("north")))).withColumn("tx", F.explode(columns))
    p = points.withColumns({"ty": F.floor("lat"), "tx": turn(F.col("lon"))})
    lon = F.col("lon") + 360 * F.floor((F.col("east") - F.col("lon")) / 360)  # the last turn not east of the area
    j = p.join(a, ["ty", "tx"]).where((lon >= F.col("west")) & F.col("lat").between(F.col("south"), F.col("north")))
    d = haversine_km(F.col("lat"), F.col("lon"), (F.col("south") + F.col("north")) / 2, (F.col("west") + F.col("east")) / 2)
    best = j.groupBy("point_id").agg(F.min(F.struct(F.round(d, 9).alias("d"), "area")).alias("b"))
    return best.select("point_id", F.col("b.area").alias("area"), F.col("b.d").alias("metric"))


def nearest_place(points: DataFrame, places: DataFrame, *, within_km: float, usable: Column | None = None, other: bool = False) -> DataFrame:
    """``point_id, place_id, km``: the nearest place (``place_id, lat, lon``) of each point within a distance, the first by id of
    equals; with ``usable`` the nearest of those for which it is true (others are walked past), with ``other`` the nearest of
    another id.

    Points and places meet in cells of the distance's size, a point looking at the cells around its own.
    """
    height = max(within_km / 111.0, 0.05)
    band = lambda lat: F.floor((lat + 90) / height)
    n_of = lambda b: F.greatest(F.floor(360 / height * F.cos(F.radians(F.greatest(F.abs((b + 0.5) * height - 90) - height / 2, F.lit(0.0))))), F.lit(1))
    q = (places if usable is None else places.where(usable)).select("place_id", F.col("lat").alias("plat"), F.col("lon").alias("plon"))
    q = q.withColumn("b", band(F.col("plat"))).withColumn("c", F.floor((F.col("plon") + 180) / 360 * n_of(F.col("b"))))
    p = points.select("point_id", "lat", "lon").withColumn("b", F.explode(F.sequence(band(F.col("lat")) - 1, band(F.col("lat")) + 1)))
    n = n_of(F.col("b"))
    reach = F.when(F.abs("lat") + height >= 89.9, n).otherwise(F.ceil(height / F.cos(F.radians("lat")) / 360 * n) + 1)
    c = F.floor((F.col("lon") + 180) / 360 * n)
    p = p.withColumn("c", F.explode(F.array_distinct(F.transform(F.sequence(c - F.least(reach, n), c + F.least(reach, n)), lambda k: F.pmod(k, n)))))
    d = haversine_km(F.col("lat"), F.col("lon"), F.col("plat"), F.col("plon"))
    j = p.join(q, ["b", "c"])
    j = (j.where(F.col("place_id") != F.col("point_id")) if other else j).withColumn("km", d).where(F.col("km") <= within_km)
    best = j.groupBy("point_id").agg(F.min(F.struct("km", "place_id")).alias("m"))
    return best.select("point_id", F.col("m.place_id").alias("place_id"), F.col("m.km").alias("km"))
