"""Aggregations over blocks, days and series; coverage against a calendar; provenance; datum decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skerry.functions.values import flag, null_nan
from skerry.operators.filters import beside


def depth_of(elevation: Column) -> Column:
    """Depth below zero, 0 on land, missing where the elevation is."""
    return F.when(elevation < 0, -elevation).when(elevation >= 0, F.lit(0.0))


def block_stats(fine: DataFrame, k: int) -> DataFrame:
    """``row, col, elevation, depth, depth_p25, depth_p75`` of k x k blocks of fine cells (``row, col, elevation``); missing skipped."""
    by = [F.floor(F.col(c) / k).cast("int").alias(c) for c in ("row", "col")]
    d = depth_of(F.col("elevation"))
    g = fine.withColumn("_d", d).groupBy(*by)
    return g.agg(F.avg("elevation").alias("elevation"), F.avg("_d").alias("depth"), F.percentile("_d", 0.25).alias("depth_p25"), F.percentile("_d", 0.75).alias("depth_p75"))


def with_depths(dem: DataFrame) -> DataFrame:
    """Depths of a DEM; quartiles default to the depth, and nothing known stays missing."""
    has = set(dem.columns)
    d = F.coalesce(F.col("depth"), depth_of(F.col("elevation"))) if "depth" in has else depth_of(F.col("elevation"))
    return dem.withColumns({"depth": d, **{q: F.coalesce(F.col(q), d) if q in has else d for q in ("depth_p25", "depth_p75")}})


def daily_mean_range(series: DataFrame, *, key: str, time: str, value: str) -> DataFrame:
    """``key, day, mean, range`` of each day that has a value."""
    s = series.where(F.col(value).isNotNull() & ~F.isnan(value))
    return s.groupBy(key, F.to_date(time).alias("day")).agg(F.avg(value).alias("mean"), (F.max(value) - F.min(value)).alias("range"))


def daily_mean_of_hours(series: DataFrame, hours: list[int], *, key: str, time: str, value: str) -> DataFrame:
    """``key, day, mean``: the mean of the wanted UTC hours, of those that have a value."""
    return series.where(F.hour(time).isin(*hours)).groupBy(key, F.to_date(time).alias("day")).agg(F.avg(value).alias("mean"))


def calendar(df: DataFrame, start: str, end: str) -> DataFrame:
    """Each row of ``df`` once for every day from start to end, both included (``day``)."""
    return df.withColumn("day", F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)))))


def on_spine(daily: DataFrame, keys: DataFrame, start: str, end: str) -> DataFrame:
    """Daily rows on the calendar: every day of every key has a row, missing where there was none."""
    names = keys.columns
    return calendar(keys, start, end).join(daily, [*names, "day"], "left")


def coverage(values: DataFrame, *, n_days: int, n_cells: int, product: str = "product", day: str = "day", value: str = "value", expected: dict[str, int] | None = None) -> DataFrame:
    """``product, days, fraction, grid_fraction, thin, patchy``: days with any value against the expected ones, and the mean share of
    the grid on those days. ``expected`` gives other numbers of days for sparse products. Thin below 0.95 of the days, patchy
    below a quarter of the grid."""
    per_day = values.where(F.col(value).isNotNull()).groupBy(product, day).agg(F.countDistinct("row", "col").alias("cells"))
    # every product that has rows is present, with or without values
    present = values.select(product).distinct()
    agg = per_day.groupBy(product).agg(F.count("*").alias("days"), F.sum(F.col("cells") / n_cells).alias("_g"))
    want = F.lit(n_days)
    for p, n in (expected or {}).items():
        want = F.when(F.col(product) == p, F.lit(n)).otherwise(want)
    out = present.join(agg, product, "left").fillna(0, ["days", "_g"])
    out = out.withColumn("fraction", F.coalesce(F.try_divide(F.col("days").cast("double"), want), F.lit(0.0))).withColumn("grid_fraction", F.coalesce(F.try_divide(F.col("_g").cast("double"), F.col("days")), F.lit(0.0)))
    return out.select(product, "days", "fraction", "grid_fraction", (F.col("fraction") < 0.95).alias("thin"), (F.col("grid_fraction") < 0.25).alias("patchy"))


def collect_provenance(files: DataFrame, *, product: str = "product", source: str = "source", stamped: str = "acquired_at", modified: str = "modified_at") -> DataFrame:
    """``product, sources, files, first_access, last_access, basis``: sources sorted and joined by commas; an access time is the
    stamped one, else the file's; ``stamped`` only if all files are."""
    at = F.coalesce(F.col(stamped), F.col(modified))
    g = files.groupBy(product).agg(F.array_join(F.sort_array(F.collect_set(source)), ",").alias("sources"), F.count("*").alias("files"), F.min(at).alias("first_access"), F.max(at).alias("last_access"), F.bool_and(F.col(stamped).isNotNull()).alias("_all"))
    return g.select(product, "sources", "files", "first_access", "last_access", F.when(F.col("_all"), "stamped").otherwise("file time").alias("basis"))


def merge_provenance(records: DataFrame, *, product: str = "product") -> DataFrame:
    """Provenance records of one product's tags folded into one: union, sum, least, latest, all."""
    g = records.groupBy(product).agg(F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.split("sources", ","))))), ",").alias("sources"), F.sum("files").alias("files"), F.min("first_access").alias("first_access"), F.max("last_access").alias("last_access"), F.bool_and(F.col("basis") == "stamped").alias("_all"))
    return g.select(product, "sources", "files", "first_access", "last_access", F.when(F.col("_all"), "stamped").otherwise("file time").alias("basis"))


def field_records(fields: DataFrame, inputs: DataFrame, products: DataFrame) -> DataFrame:
    """``field, inputs, last_access``: each field (``field``) with the products whose prefix it carries (``prefix, product``) and the
    latest access of these; a field is of a prefix if it equals it or goes on with an underscore."""
    tokens = fields.withColumn("parts", F.split("field", "_"))
    heads = tokens.withColumn("prefix", F.explode(F.transform(F.sequence(F.lit(1), F.size("parts")), lambda n: F.array_join(F.slice("parts", 1, n), "_"))))
    j = heads.join(inputs, "prefix").join(products.select("product", "last_access"), "product", "left")
    agg = j.groupBy("field").agg(F.array_join(F.sort_array(F.collect_set("product")), ",").alias("inputs"), F.max("last_access").alias("last_access"))
    return fields.join(agg, "field", "left").select("field", F.coalesce("inputs", F.lit("")).alias("inputs"), "last_access")


def longest_tag(names: DataFrame, tags: DataFrame) -> DataFrame:
    """``name, tag``: the longest tag that is a ``_tag`` suffix of the name; NULL if none is."""
    t = names.withColumn("parts", F.split("name", "_"))
    tails = t.withColumn("tag", F.explode(F.transform(F.sequence(F.lit(2), F.greatest(F.size("parts"), F.lit(2))), lambda k: F.array_join(F.slice("parts", k, F.size("parts")), "_"))))
    hit = tails.join(tags.select("tag").distinct(), "tag").groupBy("name").agg(F.max_by("tag", F.length("tag")).alias("tag"))
    return names.join(hit, "name", "left").select("name", "tag")


def sample_cells(dem: DataFrame, *, blocks: int, height: int, width: int, low: float = -5.0, high: float = 2.0, most: int = 25) -> DataFrame:
    """``block, row, col, elevation``: of each of blocks x blocks parts of the grid the cell nearest to zero within the band (of the whole
    DEM if no cell is in it), of equals the first by row and column; the first ``most`` blocks that have one. Block i begins at
    row floor(i * height / blocks), and so for columns."""
    banded = dem.where(F.col("elevation").between(low, high))
    none = banded.agg((F.count("*") == 0).alias("_none"))
    d = beside(dem.where("elevation IS NOT NULL"), none).where(F.col("_none") | F.col("elevation").between(low, high))
    part = lambda c, n: F.floor(((F.col(c) + 1) * blocks - 1) / n)
    d = d.withColumn("block", (part("row", height) * blocks + part("col", width)).cast("int"))
    best = d.groupBy("block").agg(F.min(F.struct(F.abs("elevation").alias("a"), "row", "col", "elevation")).alias("b"))
    best = best.select("block", "b.row", "b.col", "b.elevation")
    return best if most >= blocks * blocks else best.orderBy("block").limit(most)


def datum_offset(points: DataFrame, *, key: str, value: str, least: int = 1, sane_m: float = 5.0, spread_max: float = 0.5, sentinel: float = 10_000.0, fallback: float | None = None) -> DataFrame:
    """``key, offset_m, spread_m, points, status``: the median offset of a key's points.

    Offsets beyond the sentinel are out of coverage, so missing. ``resolved`` needs ``least`` points (any, by default), a spread of at most
    ``spread_max`` and a plausible median; otherwise ``too few``, ``spread`` or ``implausible``, with the fallback (``fallback``)
    where one is given."""
    v = F.when(F.abs(value) <= sentinel, F.col(value))
    g = points.groupBy(key).agg(F.median(v).alias("m"), (F.max(v) - F.min(v)).alias("spread_m"), F.count(v).alias("points"))
    why = F.when(F.col("points") < least, "too few").when(F.abs("m") > sane_m, "implausible").when(F.col("spread_m") > spread_max, "spread")
    status = F.coalesce(F.when(why.isNotNull(), F.lit("fallback" if fallback is not None else None)), why, F.lit("resolved"))
    return g.select(key, F.when(why.isNull(), F.col("m")).otherwise(F.lit(fallback)).alias("offset_m"), "spread_m", "points", status.alias("status"))


def drift_m(positions: DataFrame, *, key: str, lat: str = "lat", lon: str = "lon", max_m: float = 1000.0) -> DataFrame:
    """``key, drift_m, moving``: the largest distance from a platform's median position (equirectangular, 111132 m a degree)."""
    med = positions.groupBy(key).agg(F.median(lat).alias("_y"), F.median(lon).alias("_x"))
    j = positions.join(med, key)
    d = F.hypot((F.col(lat) - F.col("_y")) * 111_132.0, (F.col(lon) - F.col("_x")) * 111_132.0 * F.cos(F.radians("_y")))
    return j.groupBy(key).agg(F.max(d).alias("drift_m")).withColumn("moving", flag(F.col("drift_m") > max_m))


def merged_sources(readings: DataFrame, *, key: str, time: str, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """``key, instants``: keys with one instant at two or more positions, and how many such instants."""
    g = readings.groupBy(key, time).agg(F.countDistinct(lat).alias("a"), F.countDistinct(lon).alias("b"))
    return g.where((F.col("a") > 1) | (F.col("b") > 1)).groupBy(key).agg(F.count("*").alias("instants"))


def first_of(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by an order; an aggregate, so a hot key combines before the shuffle. NaN becomes missing."""
    df = null_nan(df)
    rest = [c for c in df.columns if c not in keys]
    best = F.min(F.struct(*(F.col(c).alias(f"o{i}") for i, c in enumerate(order)), *(F.col(c).alias(f"r{i}") for i, c in enumerate(rest)))).alias("b")
    return df.groupBy(*keys).agg(best).select(*keys, *(F.col(f"b.r{i}").alias(c) for i, c in enumerate(rest)))


def select_readings(readings: DataFrame, *, start: str, end: str, max_depth: float | None = None, qc_pass: list[int] | None = None, allow: list[str] | None = None, deny: list[str] | None = None, station: str = "station_id", time: str = "time", z: str = "z", qc: str = "qc") -> DataFrame:
    """Readings in the window [start, end + 1 day), at most ``max_depth`` deep (a missing depth is kept), of passing quality, of
    allowed stations. All are predicates that reach the scan."""
    r = readings.where((F.col(time) >= F.lit(start).cast("timestamp")) & (F.col(time) < F.lit(end).cast("timestamp") + F.expr("INTERVAL 1 DAY")))
    if max_depth is not None:
        r = r.where(F.col(z).isNull() | F.isnan(z) | (F.abs(z) <= max_depth))
    if qc_pass is not None:
        r = r.where(F.col(qc).isin(*qc_pass))
    if allow:
        r = r.where(F.col(station).isin(*allow))
    return r.where(~F.col(station).isin(*deny)) if deny else r


def nearest_level(wanted: DataFrame, levels: DataFrame) -> DataFrame:
    """``depth, level, gap, far``: the model level nearest to each wanted depth (of equals the shallower); far beyond 5 m.

    A model has a few dozen levels: they go to each wanted depth as one array, without a shuffle of the depths."""
    known = levels.agg(F.sort_array(F.collect_set(F.col("level").cast("double"))).alias("_levels"))
    w = beside(wanted.select(F.col("depth").cast("double").alias("depth")), known)
    best = F.array_min(F.transform("_levels", lambda x: F.struct(F.abs(x - F.col("depth")).alias("gap"), x.alias("level"))))
    w = w.select("depth", best.alias("b"))
    return w.select("depth", "b.level", "b.gap", (F.col("b.gap") > 5).alias("far"))
