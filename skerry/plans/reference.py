"""Queries of the gridded-observation operators and their SQL.

Inputs are given as SQL that both engines read alike (``base``); the operators are then held against independent SQL.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skerry.functions import geo, times, values
from skerry.operators import acquire, cube, datum, filters, match, neighbourhood, rasters, reduce, scenes, tides
from skerry.runtime import table
from skerry.sources import files
from skerry.streaming import readings as streaming

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "station", "obs", "overpass", "aoi", "feed", "logger_row")
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

GRID = geo.Grid(0.0, 2000.0, 100.0, 20, 20)
CELL = "CAST(floor({0} % 400 / 20) AS INT) AS cr, CAST({0} % 20 AS INT) AS cc"

#: Relations that both engines can read; {name} stands for a table.
BASE = {
    "scene": f"""SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS day, concat('g', l_suppkey % 7) AS granule, {CELL.format('l_partkey')},
        min(l_shipdate) AS ts0, CASE WHEN min(l_quantity) < 12 THEN NULL ELSE min(l_extendedprice) / 1000 END AS sst,
        CAST(CASE max(l_returnflag) WHEN 'A' THEN 0 WHEN 'N' THEN 1 END AS DOUBLE) AS water,
        CASE WHEN max(l_discount) > 0.085 THEN 1 WHEN min(l_tax) < 0.005 THEN NULL ELSE 0 END AS cloud,
        CAST(min(l_linenumber) % 4 AS INT) AS quality, min(l_quantity) > 20 AS file_valid
        FROM {{lineitem}} GROUP BY 1, 2, 3, 4""",
    "cubed": f"""SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS day, {CELL.format('l_partkey')},
        CASE WHEN min(l_quantity) < 10 THEN NULL ELSE max(l_extendedprice) / 1000 END AS value,
        CASE WHEN min(l_quantity) > 45 THEN NULL ELSE 20 + min(l_quantity) END AS baseline,
        CAST(max(l_linenumber) * 14 AS DOUBLE) AS cloud_pct, CAST(30 + max(l_tax) * 300 AS DOUBLE) AS airtemp FROM {{lineitem}} GROUP BY 1, 2, 3""",
    "static": f"""SELECT {CELL.format('p_partkey')}, min(p_retailprice) - 1000 AS elevation,
        CASE WHEN min(p_size) % 5 = 0 THEN NULL WHEN min(p_size) % 2 = 0 THEN 1 ELSE 0 END AS water FROM {{part}} GROUP BY 1, 2""",
    "place": "SELECT s_suppkey AS point_id, CAST(s_suppkey * 137 % 2100 AS DOUBLE) - 49.75 AS x, CAST(s_suppkey * 89 % 2100 AS DOUBLE) - 49.25 AS y FROM {supplier}",
    "geo": """SELECT s_suppkey AS point_id, CAST(s_suppkey * 7919 % 16000 AS DOUBLE) / 100 - 80 AS lat, CAST(s_suppkey * 6007 % 35900 AS DOUBLE) / 100 - 179.5 AS lon,
        s_acctbal FROM {supplier}""",
    "pingu": "SELECT event_id, user_id, ts, event_type, CASE WHEN value < 5 THEN NULL ELSE value END AS value FROM {events}",
    "files": """SELECT o_orderpriority AS product, concat('s', o_custkey % 5) AS source, concat('t', o_custkey % 3) AS tag,
        CASE WHEN o_orderkey % 11 = 0 AND o_orderpriority < '3' THEN NULL ELSE o_orderdate END AS acquired_at, o_orderdate AS modified_at FROM {orders}""",
}
RENAME = {"cr": "row", "cc": "col", "ts0": "ts"}


def frame(spark: SparkSession, d: str, sql: str) -> DataFrame:
    """A base relation in Spark."""
    sql = BASE.get(sql, sql)
    return spark.sql(sql, **{t: table(spark, d, t) for t in TABLES if f"{{{t}}}" in sql}).withColumnsRenamed(RENAME)


def with_base(*names: str) -> str:
    """The base relations as common table expressions for DuckDB."""
    return "WITH " + ",\n".join(f"{n} AS ({BASE[n].format(**{t: t for t in TABLES})})" for n in names)


NUDGE = 1e-9  # averages of decimals often end exactly halfway; both engines then round up


def rnd(c, digits: int):
    return F.round(F.col(c) + NUDGE if isinstance(c, str) else c + NUDGE, digits)


def r6(c: str):
    return rnd(c, 6).alias(c)


def _nudged(sql: str) -> str:
    """``round(x, n)`` as ``round((x) + NUDGE, n)``, for n > 0."""
    out, at = "", 0
    while (i := sql.find("round(", at)) >= 0:
        depth, j, comma = 1, i + 6, -1
        while depth:
            depth += {"(": 1, "[": 1, "{": 1, ")": -1, "]": -1, "}": -1}.get(sql[j], 0)
            if sql[j] == "," and depth == 1:
                comma = j
            j += 1
        inner, digits = (sql[i + 6 : comma], sql[comma:j]) if comma > 0 else (sql[i + 6 : j - 1], ")")
        more = f" + {NUDGE}::DOUBLE" if digits[1:-1].strip().isdigit() and int(digits[1:-1]) > 0 else ""
        out += sql[at:i] + (f"round(({_nudged(inner)}){more}{digits}" if more else f"round({_nudged(inner)}{digits}")
        at = j
    return out + sql[at:]


def query(name: str, sql: str | None = None, base: tuple[str, ...] = (), *, day: str | None = None, instants: tuple[str, ...] = ()):
    """Register a query with its SQL over the named base relations. Days and instants come out as text, alike in both engines."""

    def add(f: Callable[[SparkSession, str], DataFrame]):
        @functools.wraps(f)
        def run(spark: SparkSession, d: str) -> DataFrame:
            out = f(spark, d)
            text = {c: F.col(c).cast("string") for c, t in out.dtypes if t == "date"} | {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") for c, t in out.dtypes if t.startswith("timestamp")}
            return out.withColumns(text) if text else out

        QUERIES[name] = run
        if sql is not None:
            joint = "," if sql.lstrip().startswith("+") else ""
            body = _nudged(sql.lstrip().removeprefix("+"))
            full = (with_base(*base) + joint + "\n" + body) if base else body
            text = [f"CAST({day} AS VARCHAR) AS {day}"] * bool(day) + [f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f') AS {c}" for c in instants]
            SQL[name] = f"SELECT * REPLACE ({', '.join(text)}) FROM (\n{full})" if text else full
        return f

    return add


# ---- values around points -------------------------------------------------------------------------------------------------

STATS = ["nearest", "mean", "nanmean", "nanmedian", "nanstd", "nanmin", "nanmax", "nansum", "min", "count", "count_valid", "p25", "p90"]


@query(
    "disc_stats",
    """+ p AS (SELECT *, CAST(floor((2000 - y) / 100) AS INT) AS r0, CAST(floor(x / 100) AS INT) AS c0 FROM place),
g AS (SELECT * FROM p WHERE r0 BETWEEN 0 AND 19 AND c0 BETWEEN 0 AND 19),
disc AS (SELECT point_id, s.cr, s.cc FROM g JOIN (SELECT * FROM static WHERE water > 0) s ON abs(s.cr - r0) <= 1 AND abs(s.cc - c0) <= 1
         WHERE pow((s.cc + 0.5) * 100 - x, 2) + pow(2000 - (s.cr + 0.5) * 100 - y, 2) <= pow(160 + 1e-6, 2) OR (s.cr = r0 AND s.cc = c0)),
n AS (SELECT point_id, count(*) AS cells FROM disc GROUP BY 1),
a AS (SELECT point_id, day, any_value(cells) AS cells, count(value) AS k, avg(value) AS m, median(value) AS md, stddev_pop(value) AS sd, min(value) AS lo, max(value) AS hi, sum(value) AS s,
        quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.9) AS p90 FROM disc JOIN n USING (point_id) JOIN cubed USING (cr, cc) GROUP BY 1, 2),
l AS (SELECT point_id, day, unnest([{'s': 'mean', 'v': CASE WHEN k = cells THEN m END}, {'s': 'nanmean', 'v': m}, {'s': 'nanmedian', 'v': md}, {'s': 'nanstd', 'v': sd}, {'s': 'nanmin', 'v': lo}, {'s': 'nanmax', 'v': hi},
        {'s': 'nansum', 'v': coalesce(s, 0)}, {'s': 'min', 'v': CASE WHEN k = cells THEN lo END}, {'s': 'count', 'v': cells::DOUBLE}, {'s': 'count_valid', 'v': k::DOUBLE}, {'s': 'p25', 'v': p25}, {'s': 'p90', 'v': p90}]) AS u FROM a)
SELECT point_id, day, u.s AS stat, 160.0::DOUBLE AS radius_m, round(u.v, 6) AS value FROM l
UNION ALL SELECT point_id, day, 'nearest', 0.0::DOUBLE, round(value, 6) FROM g JOIN cubed ON cr = r0 AND cc = c0""",
    ("place", "static", "cubed"), day="day")
def disc_stats(spark: SparkSession, d: str) -> DataFrame:
    mask = frame(spark, d, "static").select("row", "col", F.col("water").alias("mask"))
    e = neighbourhood.extract(frame(spark, d, "place"), frame(spark, d, "cubed"), GRID, radius_m=160.0, stats=STATS, mask=mask)
    return e.withColumn("value", rnd("value", 6))


@query("edge_points", "SELECT point_id, least(r, c, 19 - r, 19 - c) * 100.0::DOUBLE AS free_m, least(r, c, 19 - r, 19 - c) * 100 < 300 AS near_edge FROM (SELECT point_id, CAST(floor((2000 - y) / 100) AS INT) AS r, CAST(floor(x / 100) AS INT) AS c FROM place) WHERE r BETWEEN 0 AND 19 AND c BETWEEN 0 AND 19", ("place",))
def edge_points(spark: SparkSession, d: str) -> DataFrame:
    return neighbourhood.edge_points(frame(spark, d, "place"), GRID, 300.0)


# ---- scenes ---------------------------------------------------------------------------------------------------------------

VALID = "v AS (SELECT *, sst IS NOT NULL AND coalesce(water > 0.5, false) AND coalesce(cloud = 0, false) AND coalesce(quality & 3 IN (0, 1), false) AS valid FROM scene)"
RULE = scenes.SensorRule(qc_levels=(0, 1))


def valid_scenes(spark: SparkSession, d: str) -> DataFrame:
    return scenes.with_validity(frame(spark, d, "scene"), RULE)


@query("scene_validity", f"+ {VALID} SELECT day, granule, count(*) AS n, sum(valid::INT)::BIGINT AS n_valid, sum((sst IS NOT NULL AND file_valid)::INT)::BIGINT AS n_trusted, sum((sst IS NOT NULL AND coalesce(water < 0.5, false))::INT)::BIGINT AS n_land_coded FROM v GROUP BY 1, 2", ("scene",), day="day")
def scene_validity(spark: SparkSession, d: str) -> DataFrame:
    s = frame(spark, d, "scene")
    for name, rule in (("a", RULE), ("b", scenes.SensorRule(trust_valid=True)), ("c", scenes.SensorRule(water_is_land=True, use_cloud=False))):
        s = scenes.with_validity(s, rule).withColumnRenamed("valid", name)
    n = lambda c: F.sum(F.col(c).cast("long"))
    return s.groupBy("day", "granule").agg(F.count("*").alias("n"), n("a").alias("n_valid"), n("b").alias("n_trusted"), n("c").alias("n_land_coded"))


DN = "SELECT l_orderkey AS item, l_partkey AS pix, l_linenumber AS k, CAST(floor(l_extendedprice) AS INT) % 40000 AS thermal, CAST(floor(l_quantity * 700) AS INT) AS green, CAST(round(l_discount * 100, 0) AS INT) * 3000 AS nir, CAST(l_partkey % 32 AS INT) AS qa, l_tax * 100 AS cloud_km FROM {lineitem}"


@query("decode_scene", f"""WITH dn AS ({DN.format(lineitem='lineitem')}), v AS (SELECT *, CASE WHEN thermal <> 0 THEN thermal * 0.00341802::DOUBLE + 149.0::DOUBLE - 273.15::DOUBLE END AS sst,
    coalesce(CASE WHEN green + nir <> 0 THEN (green - nir) / (green + nir) END >= 0.1, false) AS w, qa & 26 <> 0 OR cloud_km < 1.5 AS c FROM dn)
  SELECT qa, count(*) AS n, sum(w::INT)::BIGINT AS n_water, sum(c::INT)::BIGINT AS n_cloud, sum((sst IS NOT NULL AND w AND NOT c)::INT)::BIGINT AS n_valid, round(min(sst), 6) AS low, round(max(sst), 6) AS high FROM v GROUP BY 1""")
def decode_scene(spark: SparkSession, d: str) -> DataFrame:
    s = scenes.decode_scene(frame(spark, d, DN), scale=0.00341802, offset=149.0, water_threshold=0.1, cloud_distance=1.5)
    n = lambda c: F.sum(F.col(c).cast("long"))
    return s.groupBy("qa").agg(F.count("*").alias("n"), n("water").alias("n_water"), n("cloud").alias("n_cloud"), n("valid").alias("n_valid"), rnd(F.min("sst"), 6).alias("low"), rnd(F.max("sst"), 6).alias("high"))


GRANULES = f"""{VALID},
gn AS (SELECT day, granule, min(ts0) AS ts, sum(valid::INT)::BIGINT AS n_valid FROM v GROUP BY 1, 2),
g AS (SELECT *, coalesce(n_valid > max(n_valid) OVER (PARTITION BY day ORDER BY ts, granule ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS record,
        row_number() OVER (PARTITION BY day ORDER BY n_valid DESC, ts, granule) AS rank FROM gn)"""


@query("granule_rank", f"+ {GRANULES} SELECT day, granule, ts, n_valid, record, rank::INT AS rank FROM g", ("scene",), day="day", instants=("ts",))
def granule_rank(spark: SparkSession, d: str) -> DataFrame:
    return scenes.granules(valid_scenes(spark, d)).withColumn("rank", F.col("rank").cast("int"))


@query("mosaic_clearest", f"+ {GRANULES} SELECT v.day, v.granule, g.ts, hour(g.ts) + minute(g.ts) / 60.0::DOUBLE AS hour, cr AS row, cc AS col, sst, coalesce(cloud, 0) AS cloud, valid FROM v JOIN g ON g.day = v.day AND g.granule = v.granule AND g.rank = 1", ("scene",), day="day", instants=("ts",))
def mosaic_clearest(spark: SparkSession, d: str) -> DataFrame:
    return scenes.clearest(valid_scenes(spark, d))


@query("mosaic_fill", f"""+ {GRANULES}, b AS (SELECT day, granule AS base, hour(ts) + minute(ts) / 60.0::DOUBLE AS hour FROM g WHERE rank = 1),
m AS (SELECT v.*, g.ts AS gts, b.hour, row_number() OVER (PARTITION BY v.day, cr, cc ORDER BY (sst IS NULL), (NOT valid), CASE WHEN valid OR record THEN 0 ELSE 1 END,
        CASE WHEN valid OR record THEN -n_valid ELSE 0 END, CASE WHEN sst IS NULL AND v.granule <> base THEN 1 ELSE 0 END, g.ts, v.granule) AS k
      FROM v JOIN g ON g.day = v.day AND g.granule = v.granule JOIN b ON b.day = v.day)
SELECT day, cr AS row, cc AS col, sst, coalesce(cloud, 0) AS cloud, valid AND sst IS NOT NULL AS valid, granule AS source, hour FROM m WHERE k = 1""", ("scene",), day="day")
def mosaic_fill(spark: SparkSession, d: str) -> DataFrame:
    return scenes.mosaic(valid_scenes(spark, d))


@query("multi_granule_days", "SELECT sum((n > 1)::INT)::BIGINT AS multi, count(*) AS any FROM (SELECT day, count(DISTINCT granule) AS n FROM scene GROUP BY 1)", ("scene",))
def multi_granule_days(spark: SparkSession, d: str) -> DataFrame:
    return scenes.multi_granule_days(frame(spark, d, "scene"))


@query("layer_present", "SELECT count(water) > 0 AS present FROM scene", ("scene",))
def layer_present(spark: SparkSession, d: str) -> DataFrame:
    return scenes.layer_present(frame(spark, d, "scene"), "water")


@query("water_polarity", """+ gr AS (SELECT granule, min(ts0) AS ts FROM scene GROUP BY 1), k AS (SELECT granule, row_number() OVER (ORDER BY ts, granule) AS k, greatest(count(*) OVER () // 3, 1) AS st FROM gr),
  j AS (SELECT s.water, t.water AS lw FROM scene s JOIN k USING (granule) JOIN static t USING (cr, cc) WHERE (k - 1) % st = 0 AND (k - 1) / st < 3 AND s.water IS NOT NULL AND t.water IS NOT NULL),
  a AS (SELECT avg(((water < 0.5) = (lw > 0.5))::INT) AS f, count(*) AS cells, count(DISTINCT water) AS kinds, min(water) AS lo, max(water) AS hi FROM j)
  SELECT CASE WHEN cells < 500 THEN 'too few' WHEN f >= 0.65 THEN 'land-coded' WHEN f <= 0.35 THEN 'water-coded' ELSE 'ambiguous' END AS code, round(greatest(f, 1 - f), 6) AS agreement, cells, coalesce(kinds <= 2 AND lo >= -0.1 AND hi <= 1.1, true) AS binary FROM a""", ("scene", "static"))
def water_polarity(spark: SparkSession, d: str) -> DataFrame:
    return scenes.water_polarity(frame(spark, d, "scene"), frame(spark, d, "static"), sample=3).withColumn("agreement", rnd("agreement", 6))


@query("stacked_preference", """+ t AS (SELECT day, cr, cc, max(sst) FILTER (WHERE granule = 'g3') AS g3, max(sst) FILTER (WHERE granule = 'g0') AS g0, max(sst) FILTER (WHERE granule = 'g1') AS g1 FROM scene GROUP BY 1, 2, 3)
  SELECT day, cr AS row, cc AS col, g0 AS sst_g0, g1 AS sst_g1, g3 AS sst_g3, coalesce(g3, g0, g1) AS sst FROM t""", ("scene",), day="day")
def stacked_preference(spark: SparkSession, d: str) -> DataFrame:
    w = cube.by_source(frame(spark, d, "scene").withColumnRenamed("granule", "source"), ["day", "row", "col"], ["sst"], ["g0", "g1", "g3"])
    return w.withColumn("sst", scenes.preferred({t: F.col(f"sst_{t}") for t in ("g0", "g1", "g3")}, ["g3"]))


@query("whole_window_variant", "+ c AS (SELECT granule FROM scene ORDER BY (granule <> 'g9'), granule LIMIT 1) SELECT granule AS variant, count(*) AS n FROM scene JOIN c USING (granule) GROUP BY 1", ("scene",))
def whole_window_variant(spark: SparkSession, d: str) -> DataFrame:
    return scenes.whole_window_variant(frame(spark, d, "scene").withColumnRenamed("granule", "variant"), "g9").groupBy("variant").agg(F.count("*").alias("n"))


CLASSES = f"SELECT {CELL.format('l_partkey')}, l_suppkey % 5 AS tile, CAST(min(l_linenumber) % 3 AS INT) AS class FROM {{lineitem}} GROUP BY 1, 2, 3"


@query("first_class", f"WITH t AS ({CLASSES.format(lineitem='lineitem')}) SELECT cr AS row, cc AS col, coalesce(arg_min(class, tile) FILTER (WHERE class <> 0), 0) AS class FROM t GROUP BY 1, 2")
def first_class(spark: SparkSession, d: str) -> DataFrame:
    return scenes.first_class(frame(spark, d, CLASSES))


# ---- matching -------------------------------------------------------------------------------------------------------------


@query("nearest_time_match", """WITH t AS (SELECT DISTINCT overpass_id, trim(station_id) AS s, epoch_us(time) AS t0 FROM overpass),
  m AS (SELECT overpass_id, value, (epoch_us(time) - t0) / 60e6 AS dt, row_number() OVER (PARTITION BY overpass_id ORDER BY abs(epoch_us(time) - t0), epoch_us(time), value) AS k
        FROM t JOIN obs ON obs.station_id = s AND isfinite(value) AND abs(epoch_us(time) - t0) <= 1800000000)
  SELECT DISTINCT t.overpass_id, m.value, round(m.dt, 6) AS dt_min FROM t LEFT JOIN m ON m.overpass_id = t.overpass_id AND k = 1""")
def nearest_time_match(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "overpass").withColumn("station_id", F.trim("station_id")).select("overpass_id", "station_id", "time").distinct()
    m = match.value_at(t, table(spark, d, "obs"), key="station_id", target_id="overpass_id", at="time", time="time", value="value", tolerance_s=1800)
    return m.withColumn("dt_min", rnd("dt_min", 6))


@query("semi_range", "SELECT event_id, user_id FROM events e WHERE event_type = 'error' AND EXISTS (SELECT 1 FROM events p WHERE p.event_type = 'purchase' AND p.user_id = e.user_id AND abs(epoch_us(p.ts) - epoch_us(e.ts)) <= 36000000000)")
def semi_range(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return match.coincident(e.where("event_type = 'error'"), e.where("event_type = 'purchase'"), at="ts", time="ts", tolerance_s=36_000, key="user_id").select("event_id", "user_id")


@query("lerp_at_time", """+ s AS (SELECT user_id, epoch_us(ts) AS t, min(value) AS v FROM pingu WHERE value IS NOT NULL GROUP BY 1, 2),
  q AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day, epoch_us(CAST(ts AS DATE)::TIMESTAMP) + 43200000000 AS t0 FROM pingu),
  b AS (SELECT q.*, (SELECT max(t) FROM s WHERE s.user_id = q.user_id AND t <= t0) AS t1, (SELECT min(t) FROM s WHERE s.user_id = q.user_id AND t >= t0) AS t2 FROM q)
  SELECT b.user_id, concat(b.user_id, '/', day) AS target_id, round(CASE WHEN t1 = t2 THEN a.v ELSE a.v + (t0 - t1) / (t2 - t1) * (z.v - a.v) END, 6) AS value
  FROM b LEFT JOIN s a ON a.user_id = b.user_id AND a.t = t1 LEFT JOIN s z ON z.user_id = b.user_id AND z.t = t2""", ("pingu",))
def lerp_at_time(spark: SparkSession, d: str) -> DataFrame:
    e = frame(spark, d, "pingu")
    q = e.select("user_id", F.to_date("ts").alias("day")).distinct().withColumn("target_id", F.concat_ws("/", F.col("user_id").cast("string"), F.col("day").cast("string"))).withColumn("at", F.col("day").cast("timestamp") + F.expr("INTERVAL 12 HOURS"))
    v = match.value_between(q, e, key="user_id", target_id="target_id", at="at", time="ts", value="value", block_days=7)
    return v.withColumn("value", rnd("value", 6))


STATION_CELLS = "p AS (SELECT *, CAST(floor((2000 - y) / 100) AS INT) AS r0, CAST(floor(x / 100) AS INT) AS c0 FROM place)"


@query("station_cells", f"""+ {STATION_CELLS}, i AS (SELECT *, r0 BETWEEN 0 AND 19 AND c0 BETWEEN 0 AND 19 AS inside FROM p), w AS (SELECT cr, cc FROM static WHERE water > 0),
  n AS (SELECT point_id, cr, cc, pow(cr - r0, 2) + pow(cc - c0, 2) AS d2, row_number() OVER (PARTITION BY point_id ORDER BY pow(cr - r0, 2) + pow(cc - c0, 2), cr, cc) AS k FROM i CROSS JOIN w WHERE inside)
  SELECT i.point_id AS station_id, coalesce(n.cr, r0) AS row, coalesce(n.cc, c0) AS col, inside, round(sqrt(coalesce(d2, 0)) * 100, 6) AS snap_m FROM i LEFT JOIN n ON n.point_id = i.point_id AND k = 1""", ("place", "static"))
def station_cells(spark: SparkSession, d: str) -> DataFrame:
    s = match.station_cells(frame(spark, d, "place").withColumnRenamed("point_id", "station_id"), GRID, frame(spark, d, "static").where("water > 0"))
    return s.withColumn("snap_m", rnd("snap_m", 6))


INSITU = "SELECT l_suppkey AS station_id, CAST(date_trunc('month', l_shipdate) AS DATE) AS day, l_returnflag AS target, CASE WHEN min(l_quantity) < 5 THEN NULL ELSE min(l_quantity) END AS value, max(l_tax) * 100 AS dt_min FROM {lineitem} GROUP BY 1, 2, 3"


@query("insitu_cells", f"""+ m AS ({INSITU.format(lineitem='lineitem')}), {STATION_CELLS}, i AS (SELECT * FROM p WHERE r0 BETWEEN 0 AND 19 AND c0 BETWEEN 0 AND 19), n AS (SELECT r0, c0, count(DISTINCT point_id) AS n FROM i GROUP BY 1, 2)
  SELECT r0 AS row, c0 AS col, day, target, round(avg(value), 6) AS value, round(avg(dt_min), 6) AS dt_min, any_value(n) AS n FROM m JOIN i ON i.point_id = m.station_id JOIN n USING (r0, c0) WHERE value IS NOT NULL GROUP BY 1, 2, 3, 4""", ("place",), day="day")
def insitu_cells(spark: SparkSession, d: str) -> DataFrame:
    s = match.station_cells(frame(spark, d, "place").withColumnRenamed("point_id", "station_id"), GRID)
    m = match.insitu_by_cell(frame(spark, d, INSITU), s)
    return m.select("row", "col", "day", "target", r6("value"), r6("dt_min"), "n")


HAVERSINE = "12742.0::DOUBLE * asin(sqrt(least(1.0, pow(sin(radians({c} - {a}) / 2), 2) + cos(radians({a})) * cos(radians({c})) * pow(sin(radians({d} - {b}) / 2), 2))))"


@query("assign_area", f"""WITH j AS (SELECT station_id, aoi.aoi, round({HAVERSINE.format(a='lat', b='lon', c='(south + north) / 2', d='(west + east) / 2')}, 9) AS dist FROM station JOIN aoi ON lat BETWEEN south AND north JOIN (VALUES (-360), (0), (360)) AS t(turn) ON lon + turn BETWEEN west AND east)
  SELECT station_id AS point_id, aoi AS area, round(dist, 6) AS metric FROM (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY dist, aoi) AS k FROM j) WHERE k = 1""")
def assign_area(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "station").select(F.col("station_id").alias("point_id"), "lat", "lon")
    return match.assign_to_area(p, table(spark, d, "aoi").withColumnRenamed("aoi", "area").drop("wkt")).withColumn("metric", rnd("metric", 6))


def _gauge_sql(where: str) -> str:
    return f"""WITH j AS (SELECT s.station_id, g.station_id AS gauge, {HAVERSINE.format(a='s.lat', b='s.lon', c='g.lat', d='g.lon')} AS km FROM station s JOIN station g ON s.station_id <> g.station_id {where})
  SELECT station_id AS point_id, gauge AS place_id, round(km, 6) AS km FROM (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY km, gauge) AS k FROM j WHERE km <= 150) WHERE k = 1"""


@query("nearest_gauge", _gauge_sql(""))
def nearest_gauge(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "station")
    p, g = s.withColumnRenamed("station_id", "point_id"), s.withColumnRenamed("station_id", "place_id")
    return match.nearest_place(p, g, within_km=150.0, other=True).withColumn("km", rnd("km", 6))


@query("datum_walk", _gauge_sql("AND g.network IS NOT NULL AND length(g.name) > 12"))
def datum_walk(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "station")
    p, g = s.withColumnRenamed("station_id", "point_id"), s.withColumnRenamed("station_id", "place_id")
    return match.nearest_place(p, g, within_km=150.0, usable=F.col("network").isNotNull() & (F.length("name") > 12), other=True).withColumn("km", rnd("km", 6))


# ---- days, coverage, provenance -------------------------------------------------------------------------------------------


@query("daily_range", "SELECT user_id, CAST(ts AS DATE) AS day, round(avg(value), 6) AS mean, round(max(value) - min(value), 6) AS range FROM pingu WHERE value IS NOT NULL GROUP BY 1, 2", ("pingu",), day="day")
def daily_range(spark: SparkSession, d: str) -> DataFrame:
    return reduce.daily_mean_range(frame(spark, d, "pingu"), key="user_id", time="ts", value="value").select("user_id", "day", r6("mean"), r6("range"))


@query("daily_hours", "SELECT user_id, CAST(ts AS DATE) AS day, round(avg(value), 6) AS mean FROM pingu WHERE hour(ts) IN (9, 12, 15) GROUP BY 1, 2", ("pingu",), day="day")
def daily_hours(spark: SparkSession, d: str) -> DataFrame:
    return reduce.daily_mean_of_hours(frame(spark, d, "pingu"), [9, 12, 15], key="user_id", time="ts", value="value").withColumn("mean", rnd("mean", 6))


@query("daily_spine", """+ l AS (SELECT user_id, CAST(ts AS DATE) AS day, avg(value) AS mean, max(value) - min(value) AS range FROM pingu WHERE value IS NOT NULL GROUP BY 1, 2)
  SELECT u.user_id, u.day, round(mean, 6) AS mean, round(range, 6) AS range FROM (SELECT user_id, unnest(generate_series(DATE '2023-12-25', DATE '2024-02-05', INTERVAL 1 DAY))::DATE AS day FROM (SELECT DISTINCT user_id FROM pingu)) u LEFT JOIN l USING (user_id, day)""", ("pingu",), day="day")
def daily_spine(spark: SparkSession, d: str) -> DataFrame:
    e = frame(spark, d, "pingu")
    daily = reduce.daily_mean_range(e, key="user_id", time="ts", value="value")
    return reduce.on_spine(daily, e.select("user_id").distinct(), "2023-12-25", "2024-02-05").select("user_id", "day", r6("mean"), r6("range"))


@query("coverage", """+ v AS (SELECT granule AS product, day, cr, cc, CASE WHEN granule = 'g2' AND year(day) > 1995 THEN NULL ELSE sst END AS value FROM scene),
  p AS (SELECT product, day, count(DISTINCT (cr, cc)) AS cells FROM v WHERE value IS NOT NULL GROUP BY 1, 2), a AS (SELECT product, count(*) AS days, sum(cells / 400.0::DOUBLE) AS g FROM p GROUP BY 1),
  f AS (SELECT DISTINCT v.product, coalesce(days, 0)::BIGINT AS days, round(coalesce(days, 0) / (CASE WHEN v.product = 'g1' THEN 40 ELSE 85 END)::DOUBLE, 6) AS fraction, round(coalesce(g / days, 0), 6) AS grid_fraction FROM v LEFT JOIN a USING (product))
  SELECT *, fraction < 0.95 AS thin, grid_fraction < 0.25 AS patchy FROM f""", ("scene",))
def coverage(spark: SparkSession, d: str) -> DataFrame:
    s = frame(spark, d, "scene").withColumnRenamed("granule", "product")
    s = s.withColumn("value", F.when(~((F.col("product") == "g2") & (F.year("day") > 1995)), F.col("sst")))
    c = reduce.coverage(s, n_days=85, n_cells=400, expected={"g1": 40})
    return c.withColumns({"days": F.col("days").cast("long"), "fraction": rnd("fraction", 6), "grid_fraction": rnd("grid_fraction", 6)})


PROVENANCE = "SELECT {k}, string_agg(DISTINCT source, ',' ORDER BY source) AS sources, count(*) AS files, min(coalesce(acquired_at, modified_at)) AS first_access, max(coalesce(acquired_at, modified_at)) AS last_access, CASE WHEN bool_and(acquired_at IS NOT NULL) THEN 'stamped' ELSE 'file time' END AS basis FROM files GROUP BY {k}"


@query("provenance_collect", PROVENANCE.format(k="product"), ("files",), instants=("first_access", "last_access"))
def provenance_collect(spark: SparkSession, d: str) -> DataFrame:
    return reduce.collect_provenance(frame(spark, d, "files"))


@query("provenance_merge", PROVENANCE.format(k="product"), ("files",), instants=("first_access", "last_access"))
def provenance_merge(spark: SparkSession, d: str) -> DataFrame:
    f = frame(spark, d, "files").withColumn("product", F.concat_ws("/", "product", "tag"))
    return reduce.merge_provenance(reduce.collect_provenance(f).withColumn("product", F.split("product", "/")[0]))


FIELDS = "SELECT DISTINCT concat(lower(substr(c_mktsegment, 1, 4)), '_', CASE WHEN c_nationkey % 3 = 0 THEN 'sst' ELSE 'cloud' END, '_n', c_nationkey) AS field FROM {customer}"
PREFIXES = "SELECT * FROM VALUES ('auto', 'lst'), ('auto_sst', 'mur'), ('buil', 'eco'), ('hous_cloud', 'met'), ('mach_sst_n3', 'tide') AS t(prefix, product)"
ACCESS = "SELECT * FROM VALUES ('lst', 3L), ('mur', 5L), ('eco', 1L), ('met', 9L) AS t(product, last_access)"


@query("field_inputs", f"""WITH f AS ({FIELDS.format(customer='customer')}), i(prefix, product) AS (VALUES ('auto', 'lst'), ('auto_sst', 'mur'), ('buil', 'eco'), ('hous_cloud', 'met'), ('mach_sst_n3', 'tide')),
  p(product, a) AS (VALUES ('lst', 3::BIGINT), ('mur', 5), ('eco', 1), ('met', 9))
  SELECT field, coalesce(string_agg(DISTINCT i.product, ',' ORDER BY i.product), '') AS inputs, coalesce(max(a), -1) AS last_access FROM f LEFT JOIN i ON field = prefix OR starts_with(field, prefix || '_') LEFT JOIN p ON p.product = i.product GROUP BY 1""")
def field_inputs(spark: SparkSession, d: str) -> DataFrame:
    return reduce.field_records(frame(spark, d, FIELDS), spark.sql(PREFIXES), spark.sql(ACCESS)).fillna(-1, ["last_access"])


@query("longest_tag", f"""WITH f AS ({FIELDS.format(customer='customer')}), t(tag) AS (VALUES ('n3'), ('sst_n3'), ('cloud_n4'), ('n4'), ('n5')),
  j AS (SELECT field, tag FROM f JOIN t ON ends_with(field, '_' || tag)) SELECT f.field AS name, (SELECT arg_max(tag, length(tag)) FROM j WHERE j.field = f.field) AS tag FROM f""")
def longest_tag(spark: SparkSession, d: str) -> DataFrame:
    tags = spark.sql("SELECT * FROM VALUES ('n3'), ('sst_n3'), ('cloud_n4'), ('n4'), ('n5') AS t(tag)")
    return reduce.longest_tag(frame(spark, d, FIELDS).withColumnRenamed("field", "name"), tags)


# ---- fits and filters -----------------------------------------------------------------------------------------------------

FIT = "SELECT CAST(o_custkey % 50 AS INT) AS k, CAST(o_orderdate AS DATE) AS day, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_totalprice / 1000 END AS v FROM {orders}"
FIT_DUCK = f"o AS ({FIT.format(orders='orders')})"
HARMONIC = """x AS (SELECT k, v, 1.0::DOUBLE AS x0, sin(dayofyear(day) * 2 * pi() / 365.25) AS x1, cos(dayofyear(day) * 2 * pi() / 365.25) AS x2 FROM o WHERE v IS NOT NULL),
  m AS (SELECT k, count(*) AS n, sum(x0 * x0) AS a, sum(x1) AS b, sum(x2) AS c, sum(x1 * x1) AS d, sum(x1 * x2) AS e, sum(x2 * x2) AS f, sum(v) AS p, sum(x1 * v) AS q, sum(x2 * v) AS r FROM x GROUP BY 1),
  t AS (SELECT *, a * (d * f - e * e) - b * (b * f - c * e) + c * (b * e - c * d) AS det FROM m),
  s AS (SELECT k, n, (p * (d * f - e * e) - b * (q * f - r * e) + c * (q * e - r * d)) / det AS b0, (a * (q * f - r * e) - p * (b * f - c * e) + c * (b * r - c * q)) / det AS b1, (a * (d * r - e * q) - b * (b * r - c * q) + p * (b * e - c * d)) / det AS b2 FROM t),
  fit AS (SELECT s.k, any_value(s.n) AS n, any_value(b0) AS b0, any_value(b1) AS b1, any_value(b2) AS b2, sqrt(sum(pow(v - b0 - b1 * x1 - b2 * x2, 2)) / greatest(any_value(s.n) - 3, 1)) AS sigma FROM s JOIN x USING (k) GROUP BY 1)"""


@query("sigma_fit_pixel", f"WITH {FIT_DUCK}, a AS (SELECT k, count(*) AS n, avg(v) AS m FROM o WHERE v IS NOT NULL GROUP BY 1) SELECT a.k, any_value(n) AS n, round(any_value(m), 6) AS b0, round(sqrt(sum(pow(v - m, 2)) / greatest(any_value(n) - 1, 1)), 6) AS sigma FROM a JOIN o USING (k) WHERE v IS NOT NULL GROUP BY 1")
def sigma_fit_pixel(spark: SparkSession, d: str) -> DataFrame:
    return filters.sigma_fit(frame(spark, d, FIT), keys=["k"], value="v", day="day").select("k", "n", r6("b0"), r6("sigma"))


@query("sigma_fit_pooled", f"WITH {FIT_DUCK}, a AS (SELECT count(v) AS n, avg(v) AS m FROM o) SELECT any_value(n) AS n, round(any_value(m), 6) AS b0, round(sqrt(sum(pow(v - m, 2)) / greatest(any_value(n) - 1, 1)), 6) AS sigma FROM o, a WHERE v IS NOT NULL")
def sigma_fit_pooled(spark: SparkSession, d: str) -> DataFrame:
    return filters.sigma_fit(frame(spark, d, FIT), keys=[], value="v", day="day").select("n", r6("b0"), r6("sigma"))


@query("sigma_fit_harmonic", f"WITH {FIT_DUCK}, {HARMONIC} SELECT k, n, round(b0, 5) AS b0, round(b1, 5) AS b1, round(b2, 5) AS b2, round(sigma, 5) AS sigma FROM fit")
def sigma_fit_harmonic(spark: SparkSession, d: str) -> DataFrame:
    f = filters.sigma_fit(frame(spark, d, FIT), keys=["k"], value="v", day="day", harmonic=True)
    return f.select("k", "n", *(rnd(c, 5).alias(c) for c in ("b0", "b1", "b2", "sigma")))


@query("sigma_filter", f"WITH {FIT_DUCK}, {HARMONIC} SELECT o.k, count(*) AS n, sum(coalesce(v < b0 + b1 * sin(dayofyear(day) * 2 * pi() / 365.25) + b2 * cos(dayofyear(day) * 2 * pi() / 365.25) - 1.2 * sigma, false)::INT)::BIGINT AS dropped FROM o LEFT JOIN fit USING (k) GROUP BY 1")
def sigma_filter(spark: SparkSession, d: str) -> DataFrame:
    o = frame(spark, d, FIT).withColumns({"sst": F.col("v"), "valid": F.lit(True)})
    f = filters.sigma_filter(o, filters.sigma_fit(o, keys=["k"], value="v", day="day", harmonic=True), keys=["k"], n_sigma=1.2, harmonic=True)
    return f.groupBy("k").agg(F.count("*").alias("n"), F.sum(F.col("sigma_flag").cast("long")).alias("dropped"))


@query("season_shows", f"WITH {FIT_DUCK}, y AS (SELECT DISTINCT dayofyear(day) AS n FROM o) SELECT max(n) - min(n) >= 60 AND NOT (stddev_pop(sin(n * 2 * pi() / 365.25)) < 1e-3 AND stddev_pop(cos(n * 2 * pi() / 365.25)) < 1e-3) AS harmonic FROM y")
def season_shows(spark: SparkSession, d: str) -> DataFrame:
    return filters.season_shows(frame(spark, d, FIT))


PIXELS = ("cubed", "static")
JOINED = "j AS (SELECT c.*, s.water, s.elevation FROM cubed c LEFT JOIN static s USING (cr, cc))"


def pixels(spark: SparkSession, d: str) -> DataFrame:
    c = frame(spark, d, "cubed").withColumnRenamed("value", "sst").withColumn("valid", F.col("sst").isNotNull())
    return c.join(frame(spark, d, "static"), ["row", "col"], "left")


@query("offset_filter", "SELECT day, cr AS row, cc AS col, CASE WHEN coalesce(baseline - value > 5, false) OR cloud_pct > 90 THEN NULL ELSE value END AS sst_clean, (coalesce(baseline - value > 5, false) OR cloud_pct > 90)::INT AS cold_flag FROM cubed", ("cubed",), day="day")
def offset_filter(spark: SparkSession, d: str) -> DataFrame:
    p = frame(spark, d, "cubed").withColumnRenamed("value", "sst").withColumns({"valid": F.col("sst").isNotNull(), "cloudy": (F.col("cloud_pct") > 90).cast("int")})
    return filters.offset_filter(p, threshold=5.0, cloud="cloudy").select("day", "row", "col", "sst_clean", "cold_flag")


COVER = f"{JOINED}, m AS (SELECT day, CASE WHEN bool_or(coalesce(water > 0, false)) THEN avg(cloud_pct) FILTER (WHERE water > 0) ELSE avg(cloud_pct) END AS pct FROM j GROUP BY 1)"


@query("cover_gate", f"+ {COVER} SELECT j.day, round(any_value(pct), 6) AS scene_cloud_pct, count(*) AS n, sum((pct > 50 OR coalesce(cloud_pct > 80, false))::INT)::BIGINT AS dropped FROM j JOIN m USING (day) GROUP BY 1", PIXELS, day="day")
def cover_gate(spark: SparkSession, d: str) -> DataFrame:
    g = filters.cover_gate(pixels(spark, d), scene_max=50.0, pixel_max=80.0)
    return g.groupBy("day").agg(rnd(F.first("scene_cloud_pct"), 6).alias("scene_cloud_pct"), F.count("*").alias("n"), F.sum(F.col("cover_flag").cast("long")).alias("dropped"))


@query("land_cloud", f"+ {JOINED} SELECT day, count(*) AS n, sum((coalesce(water, 1) < 0.5 AND coalesce(airtemp - value > 5, false))::INT)::BIGINT AS dropped FROM j GROUP BY 1", PIXELS, day="day")
def land_cloud(spark: SparkSession, d: str) -> DataFrame:
    return filters.land_cloud_filter(pixels(spark, d)).groupBy("day").agg(F.count("*").alias("n"), F.sum(F.col("land_cloud_flag").cast("long")).alias("dropped"))


@query("filters_composed", f"""+ {COVER}, f AS (SELECT j.*, coalesce(baseline - value > 5, false) AS a, pct > 50 OR coalesce(cloud_pct > 80, false) AS b, coalesce(water, 1) < 0.5 AND coalesce(airtemp - value > 5, false) AS c FROM j JOIN m USING (day))
  SELECT day, count(value) AS raw, count(CASE WHEN NOT (a OR b OR c) THEN value END) AS clean, sum((value IS NOT NULL AND NOT (a OR b OR c))::INT)::BIGINT AS n_valid, sum(a::INT)::BIGINT AS cold, sum(b::INT)::BIGINT AS cover, sum(c::INT)::BIGINT AS land FROM f GROUP BY 1""", PIXELS, day="day")
def filters_composed(spark: SparkSession, d: str) -> DataFrame:
    p = filters.land_cloud_filter(filters.cover_gate(filters.offset_filter(pixels(spark, d)), scene_max=50.0))
    n = lambda c: F.sum(F.col(c).cast("long"))
    return p.groupBy("day").agg(F.count("sst").alias("raw"), F.count("sst_clean").alias("clean"), n("valid_clean").alias("n_valid"), n("cold_flag").alias("cold"), n("cover_flag").alias("cover"), n("land_cloud_flag").alias("land"))


@query("water_line", f"+ {JOINED}, t AS (SELECT day, avg(baseline) AS tide FROM cubed WHERE month(day) <> 5 GROUP BY 1) SELECT j.day, cr AS row, cc AS col, round(elevation - 1.3::DOUBLE - tide, 6) AS water_elev, CASE WHEN elevation IS NULL OR tide IS NULL THEN 255 WHEN elevation - 1.3::DOUBLE - tide > 0 THEN 1 ELSE 0 END AS water_class FROM j LEFT JOIN t USING (day)", PIXELS, day="day")
def water_line(spark: SparkSession, d: str) -> DataFrame:
    tide = frame(spark, d, "cubed").where("month(day) <> 5").groupBy("day").agg(F.avg("baseline").alias("tide"))
    return filters.water_line(pixels(spark, d).join(tide, "day", "left"), datum_offset_m=1.3).select("day", "row", "col", r6("water_elev"), "water_class")


# ---- grids, levels, datum, guards -----------------------------------------------------------------------------------------

DEM = "SELECT CAST(floor(l_partkey % 1600 / 40) AS INT) AS cr, CAST(l_partkey % 40 AS INT) AS cc, CASE WHEN min(l_quantity) < 2 THEN NULL ELSE min(l_quantity) - 12.5 END AS elevation FROM {lineitem} GROUP BY 1, 2"
#: As above on 42 x 42 cells, which five blocks don't divide evenly.
DEM42 = DEM.replace("1600 / 40", "1764 / 42").replace("l_partkey % 40 ", "l_partkey % 42 ")
DEM_DUCK = f"dem AS ({DEM.format(lineitem='lineitem')})"


@query("block_stats", f"WITH {DEM_DUCK}, b AS (SELECT *, CASE WHEN elevation < 0 THEN -elevation WHEN elevation >= 0 THEN 0 END AS depth FROM dem) SELECT CAST(floor(cr / 4) AS INT) AS row, CAST(floor(cc / 4) AS INT) AS col, round(avg(elevation), 6) AS elevation, round(avg(depth), 6) AS depth, round(quantile_cont(depth, 0.25), 6) AS depth_p25, round(quantile_cont(depth, 0.75), 6) AS depth_p75 FROM b GROUP BY 1, 2")
def block_stats(spark: SparkSession, d: str) -> DataFrame:
    return reduce.block_stats(frame(spark, d, DEM), 4).select("row", "col", *(r6(c) for c in ("elevation", "depth", "depth_p25", "depth_p75")))


@query("depths", f"WITH {DEM_DUCK} SELECT cr AS row, cc AS col, elevation, CASE WHEN elevation < 0 THEN -elevation WHEN elevation >= 0 THEN 0.0 END::DOUBLE AS depth, CASE WHEN elevation < 0 THEN -elevation WHEN elevation >= 0 THEN 0.0 END::DOUBLE AS depth_p25, CASE WHEN elevation < 0 THEN -elevation WHEN elevation >= 0 THEN 0.0 END::DOUBLE AS depth_p75 FROM dem")
def depths(spark: SparkSession, d: str) -> DataFrame:
    return reduce.with_depths(frame(spark, d, DEM))


@query("sample_cells", f"""WITH dem AS ({DEM42.format(lineitem='lineitem')}), e AS (SELECT * FROM (VALUES (0, 0, 8), (1, 8, 16), (2, 16, 25), (3, 25, 33), (4, 33, 42)) AS t(k, first, after)),
  b AS (SELECT dem.*, (y.k * 5 + x.k)::INT AS block FROM dem JOIN e y ON cr >= y.first AND cr < y.after JOIN e x ON cc >= x.first AND cc < x.after WHERE elevation BETWEEN -5 AND 2)
  SELECT block, cr AS row, cc AS col, elevation FROM (SELECT *, row_number() OVER (PARTITION BY block ORDER BY abs(elevation), cr, cc) AS k FROM b) WHERE k = 1""")
def sample_cells(spark: SparkSession, d: str) -> DataFrame:
    return reduce.sample_cells(frame(spark, d, DEM42), blocks=5, height=42, width=42)


OFFSETS = "SELECT c_nationkey AS k, CASE WHEN c_custkey % 17 = 0 THEN -999999 WHEN c_custkey % 25 <= c_nationkey AND c_nationkey >= 5 THEN NULL ELSE (c_custkey % (3 + c_nationkey)) / 20.0 + CASE WHEN c_nationkey > 22 THEN 7 ELSE 0 END END AS off FROM {customer}"


@query("datum_offset", f"""WITH o AS (SELECT k, CASE WHEN abs(off) <= 10000 THEN off::DOUBLE END AS v FROM ({OFFSETS.format(customer='customer')})), g AS (SELECT k, median(v) AS m, max(v) - min(v) AS s, count(v) AS n FROM o GROUP BY 1),
  w AS (SELECT *, n < 1 OR abs(m) > 5 OR s > 0.5 AS bad FROM g) SELECT k, round(CASE WHEN bad THEN 0.25 ELSE m END, 6)::DOUBLE AS offset_m, round(s, 6) AS spread_m, n AS points, CASE WHEN bad THEN 'fallback' ELSE 'resolved' END AS status FROM w""")
def datum_offset(spark: SparkSession, d: str) -> DataFrame:
    o = frame(spark, d, OFFSETS).withColumn("off", F.col("off").cast("double"))
    return reduce.datum_offset(o, key="k", value="off", fallback=0.25).select("k", r6("offset_m"), r6("spread_m"), "points", "status")


LADDER_AREAS = "SELECT aoi AS area, CASE ascii(aoi) % 4 WHEN 0 THEN 'gmrt' WHEN 1 THEN 'other' ELSE 'cudem' END AS dem_source, (south + north) / 2 AS lat, (west + east) / 2 AS lon, CASE WHEN length(aoi) % 2 = 0 THEN 0.75 END AS fallback_m FROM {aoi}"
LADDER_SAMPLES = "SELECT aoi AS area, CASE WHEN s_suppkey % 2 = 0 THEN 'westcoast' ELSE 'contiguous' END AS region, CASE WHEN s_acctbal < 0 AND s_nationkey % 2 = 0 THEN -999999.0 WHEN s_nationkey > 20 THEN 6.0 + s_acctbal / 100000 ELSE s_acctbal / CASE WHEN s_nationkey % 3 = 0 THEN 10000 ELSE 60000 END END AS t_z FROM {aoi} JOIN {supplier} ON s_nationkey = (ascii(aoi) + length(aoi) * 7) % 26"
LADDER_GAUGES = "SELECT station_id AS place_id, lat, lon, lat / 100 AS msl, CASE WHEN network IS NOT NULL THEN lat / 100 - length(name) / 20.0 END AS navd88, CASE length(name) % 3 WHEN 0 THEN 'meters' WHEN 1 THEN '' ELSE 'feet' END AS units FROM {station}"


@query("datum_ladder", f"""WITH a AS (SELECT * FROM ({LADDER_AREAS.format(aoi='aoi')})), r AS (SELECT area, region, -t_z::DOUBLE AS v FROM ({LADDER_SAMPLES.format(aoi='aoi', supplier='supplier')}) JOIN a USING (area) WHERE abs(t_z) <= 10000 AND (region = 'contiguous' OR lon < -115)),
  p AS (SELECT area, region, median(v) AS off, max(v) - min(v) AS spread, count(*) AS n, row_number() OVER (PARTITION BY area ORDER BY region <> 'westcoast') AS k FROM r GROUP BY 1, 2),
  g AS (SELECT place_id, lat, lon, (msl - navd88)::DOUBLE AS tie FROM ({LADDER_GAUGES.format(station='station')}) WHERE abs(msl - navd88) <= 5 AND units <> 'feet'),
  w AS (SELECT area, place_id, tie, {HAVERSINE.format(a='a.lat', b='a.lon', c='g.lat', d='g.lon')} AS km FROM a, g), near AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY area ORDER BY km, place_id) AS k FROM w WHERE km <= 300) WHERE k = 1),
  j AS (SELECT a.*, p.region, off, spread, n, place_id, km, tie, coalesce(dem_source = 'cudem' AND abs(off) <= 5, false) AS known FROM a LEFT JOIN p ON p.area = a.area AND p.k = 1 LEFT JOIN near ON near.area = a.area),
  m AS (SELECT *, CASE dem_source WHEN 'gmrt' THEN 'gmrt_msl_assumed' WHEN 'other' THEN 'unknown_dem_datum' ELSE CASE WHEN known AND spread > 0.5 THEN 'vdatum_spread_too_large' WHEN known THEN 'vdatum_navd88_to_lmsl' WHEN tie IS NOT NULL THEN 'coops_msl_minus_navd88' ELSE 'none' END END AS how FROM j),
  f AS (SELECT *, how IN ('unknown_dem_datum', 'vdatum_spread_too_large', 'none') AS lost, how = 'vdatum_navd88_to_lmsl' AND tie IS NOT NULL AS crossed FROM m)
  SELECT area, CASE dem_source WHEN 'gmrt' THEN 'MSL_APPROX' WHEN 'other' THEN 'UNKNOWN' ELSE 'NAVD88' END AS datum,
    round(CASE WHEN how = 'vdatum_navd88_to_lmsl' THEN off WHEN how = 'coops_msl_minus_navd88' THEN tie WHEN lost AND fallback_m IS NOT NULL THEN fallback_m ELSE 0 END, 3)::DOUBLE AS datum_offset_m,
    CASE WHEN lost AND fallback_m IS NOT NULL THEN 'config_fallback' ELSE how END AS method, CASE WHEN NOT lost THEN 'ok' WHEN fallback_m IS NOT NULL THEN 'regional_default' ELSE 'unresolved_assumed_zero' END AS status,
    CASE WHEN known THEN n END AS samples, CASE WHEN known THEN region END AS region, CASE WHEN crossed OR how = 'coops_msl_minus_navd88' THEN place_id END AS gauge_id, round(CASE WHEN crossed THEN abs(off - tie) END, 3) AS crosscheck_m,
    concat_ws(', ', CASE WHEN known AND n < 5 THEN 'few samples' END, CASE WHEN how = 'vdatum_navd88_to_lmsl' AND spread > 0.15 THEN 'samples vary' END, CASE WHEN (crossed OR how = 'coops_msl_minus_navd88') AND km > 10 THEN 'gauge is far' END, CASE WHEN crossed AND abs(off - tie) > 0.15 THEN 'gauge disagrees' END) AS warning FROM f""")
def datum_ladder(spark: SparkSession, d: str) -> DataFrame:
    num = lambda df, *cs: df.withColumns({c: F.col(c).cast("double") for c in cs})
    a, s, g = (frame(spark, d, q) for q in (LADDER_AREAS, LADDER_SAMPLES, LADDER_GAUGES))
    r = datum.resolve_datum(num(a, "lat", "lon", "fallback_m"), num(s, "t_z"), num(g, "msl", "navd88"), datum.DatumRule(gauge_km=300.0))
    return r.select("area", "datum", rnd("datum_offset_m", 3).alias("datum_offset_m"), "method", "status", "samples", "region", "gauge_id", rnd("crosscheck_m", 3).alias("crosscheck_m"), "warning")


DRIFT = "SELECT user_id, 40 + user_id % 10 + (event_id % 7) * 0.0001 * (user_id % 5) AS lat, -70 + (event_id % 3) * 0.001 * (user_id % 4) AS lon, date_trunc('hour', ts) AS h FROM {events}"


@query("platform_drift", f"""WITH p AS (SELECT user_id, lat::DOUBLE AS lat, lon::DOUBLE AS lon FROM ({DRIFT.format(events='events')})), m AS (SELECT user_id, median(lat) AS y, median(lon) AS x FROM p GROUP BY 1)
  SELECT user_id, round(max(sqrt(pow((lat - y) * 111132, 2) + pow((lon - x) * 111132 * cos(radians(y)), 2))), 4) AS drift_m, max(sqrt(pow((lat - y) * 111132, 2) + pow((lon - x) * 111132 * cos(radians(y)), 2))) > 100 AS moving FROM p JOIN m USING (user_id) GROUP BY 1""")
def platform_drift(spark: SparkSession, d: str) -> DataFrame:
    p = frame(spark, d, DRIFT).withColumns({"lat": F.col("lat").cast("double"), "lon": F.col("lon").cast("double")})
    return reduce.drift_m(p, key="user_id", max_m=100.0).withColumn("drift_m", rnd("drift_m", 4))


@query("merged_station", f"WITH p AS ({DRIFT.format(events='events')}), g AS (SELECT user_id, h FROM p GROUP BY 1, 2 HAVING count(DISTINCT lat) > 1 OR count(DISTINCT lon) > 1) SELECT user_id, count(*) AS instants FROM g GROUP BY 1")
def merged_station(spark: SparkSession, d: str) -> DataFrame:
    return reduce.merged_sources(frame(spark, d, DRIFT), key="user_id", time="h")


@query("dedupe_first", "SELECT station_id, time, obs_id, CASE WHEN NOT isnan(value) THEN value END AS value FROM (SELECT *, row_number() OVER (PARTITION BY station_id, time ORDER BY received_at, obs_id) AS k FROM obs) WHERE k = 1", instants=("time",))
def dedupe_first(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "obs").select("station_id", "time", "obs_id", "value", "received_at").withColumn("time", F.col("time").cast("timestamp"))
    return reduce.first_of(o, ["station_id", "time"], ["received_at", "obs_id"]).select("station_id", "time", "obs_id", "value")


@query("select_readings", "SELECT station_id, count(*) AS n FROM (SELECT DISTINCT obs_id, station_id FROM obs WHERE time >= TIMESTAMP '2024-03-01' AND time < TIMESTAMP '2025-09-01' AND (z IS NULL OR isnan(z) OR abs(z) <= 5.05) AND qc IN (1, 2) AND station_id <> 'QM-000777') GROUP BY 1")
def select_readings(spark: SparkSession, d: str) -> DataFrame:
    o = reduce.select_readings(table(spark, d, "obs"), start="2024-03-01", end="2025-08-31", max_depth=5.05, qc_pass=[1, 2], deny=["QM-000777"])
    return o.select("obs_id", "station_id").distinct().groupBy("station_id").agg(F.count("*").alias("n"))


LEVELS = "SELECT DISTINCT CAST(p_size * p_size AS DOUBLE) / 4 AS level FROM {part} WHERE p_size % 3 = 0"
WANTED = "SELECT DISTINCT CAST(p_size AS DOUBLE) * 13 AS depth FROM {part}"


@query("nearest_level", f"""WITH w AS ({WANTED.format(part='part')}), l AS ({LEVELS.format(part='part')}), j AS (SELECT depth, level, abs(depth - level) AS gap, row_number() OVER (PARTITION BY depth ORDER BY abs(depth - level), level) AS k FROM w CROSS JOIN l)
  SELECT depth, level, gap, gap > 5 AS far FROM j WHERE k = 1""")
def nearest_level(spark: SparkSession, d: str) -> DataFrame:
    return reduce.nearest_level(frame(spark, d, WANTED), frame(spark, d, LEVELS))


# ---- shapes of the cube ---------------------------------------------------------------------------------------------------


@query("pivot_channels", "SELECT user_id, CAST(ts AS DATE) AS day, round(avg(value) FILTER (WHERE event_type = 'click'), 6) AS click, round(avg(value) FILTER (WHERE event_type = 'error'), 6) AS error, round(avg(value) FILTER (WHERE event_type = 'view'), 6) AS view FROM pingu GROUP BY 1, 2", ("pingu",), day="day")
def pivot_channels(spark: SparkSession, d: str) -> DataFrame:
    long = frame(spark, d, "pingu").groupBy("user_id", F.to_date("ts").alias("day"), "event_type").agg(rnd(F.avg("value"), 6).alias("value"))
    return cube.side_by_side(long, ["user_id", "day"], ["click", "error", "view"], channel="event_type")


@query("unpivot_stack", "SELECT day, cr AS row, cc AS col, unnest(['value', 'baseline', 'cloud_pct']) AS channel, unnest([value, baseline, cloud_pct]) AS value FROM cubed", ("cubed",), day="day")
def unpivot_stack(spark: SparkSession, d: str) -> DataFrame:
    return cube.stack(frame(spark, d, "cubed").drop("airtemp"), ["day", "row", "col"], ["value", "baseline", "cloud_pct"])


@query("skip_guard", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def skip_guard(spark: SparkSession, d: str) -> DataFrame:
    return cube.missing_work(table(spark, d, "orders").select("o_orderkey", "o_custkey"), table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), ["o_orderkey"])


@query("covers_range", "WITH s AS (SELECT o_custkey, min(o_orderdate) AS a, CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE max(o_orderdate) END AS b FROM orders GROUP BY 1) SELECT o_custkey, coalesce(a <= TIMESTAMP '1997-01-01' AND b >= TIMESTAMP '1999-12-31', false) AS covered FROM s")
def covers_range(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
    s = s.withColumn("b", F.when(F.col("o_custkey") % 7 != 0, F.col("b")))
    return s.select("o_custkey", cube.covers(F.col("a"), F.col("b"), F.lit("1997-01-01").cast("timestamp"), F.lit("1999-12-31").cast("timestamp")).alias("covered"))


@query("assembled_cube", f"""+ {GRANULES}, sp AS (SELECT unnest(generate_series(DATE '1994-12-01', DATE '2001-12-01', INTERVAL 1 MONTH))::DATE AS day), ce AS (SELECT r AS cr, c AS cc FROM range(20) a(r), range(20) b(c)),
  eco AS (SELECT v.day, cr, cc, sst, coalesce(cloud, 0) AS cloud FROM v JOIN g ON g.day = v.day AND g.granule = v.granule AND rank = 1)
  SELECT day, cr::INT AS row, cc::INT AS col, eco.sst AS eco_sst, coalesce(eco.cloud, 0) AS eco_cloud, cubed.baseline AS mur_sst, round(sin(dayofyear(day) * 2 * pi() / 365.25), 6) AS doy_sin, coalesce(static.water, 1) AS landcover_water, static.elevation AS elevation_a
  FROM sp CROSS JOIN ce LEFT JOIN eco USING (day, cr, cc) LEFT JOIN cubed USING (day, cr, cc) LEFT JOIN static USING (cr, cc)""", ("scene", "cubed", "static"), day="day")
def assembled_cube(spark: SparkSession, d: str) -> DataFrame:
    days = spark.range(1).select(F.explode(F.expr("sequence(DATE '1994-12-01', DATE '2001-12-01', INTERVAL 1 MONTH)")).alias("day"))
    base = cube.cells(days, GRID)
    static = frame(spark, d, "static")
    parts = [
        cube.Contributor("doy", lambda f: days.select("day", rnd(times.season(F.col("day"))[0], 6).alias("doy_sin")), ("day",)),
        cube.Contributor("mur", lambda f: frame(spark, d, "cubed").select("day", "row", "col", F.col("baseline").alias("mur_sst")), ("day", "row", "col"), depends_on=("eco",)),
        cube.Contributor("eco", lambda f: scenes.clearest(valid_scenes(spark, d)).select("day", "row", "col", F.col("sst").alias("eco_sst"), F.col("cloud").alias("eco_cloud")), ("day", "row", "col"), fills={"eco_cloud": 0}),
        cube.Contributor("landcover", lambda f: static.select("row", "col", F.coalesce("water", F.lit(1)).alias("landcover_water"), F.col("elevation").alias("elevation_a")), ("row", "col"), fills={"landcover_water": 1}),
    ]
    return cube.assemble(base, parts)


# ---- scalar functions -----------------------------------------------------------------------------------------------------


@query("utm_positions", f"""+ z AS (SELECT *, CAST(floor((lon + 180) / 6) + 1 AS INT) AS zone FROM geo), k AS (SELECT 0.0016792203863836474::DOUBLE AS n, 6367449.145823415::DOUBLE * 0.9996 AS ar, sqrt((1 / 298.257223563) * (2 - 1 / 298.257223563))::DOUBLE AS e),
  a AS (SELECT *, radians(lat) AS phi, radians(lon - (zone * 6 - 183)) AS lam FROM z, k), t AS (SELECT *, sinh(atanh(sin(phi)) - e * atanh(e * sin(phi))) AS t FROM a), u AS (SELECT *, atan2(t, cos(lam)) AS xi, atanh(sin(lam) / sqrt(1 + t * t)) AS eta FROM t),
  s AS (SELECT *, [n/2 - 2*n*n/3 + 5*n**3/16 + 41*n**4/180, 13*n*n/48 - 3*n**3/5 + 557*n**4/1440, 61*n**3/240 - 103*n**4/140, 49561*n**4/161280] AS al FROM u)
  SELECT point_id, zone, CASE WHEN lat >= 0 THEN 32600 + zone ELSE 32700 + zone END AS epsg, round(500000 + ar * (eta + list_sum(list_transform(al, lambda c, i: c * cos(2 * i * xi) * sinh(2 * i * eta)))), 2) AS easting,
    round(CASE WHEN lat < 0 THEN 10000000 ELSE 0 END + ar * (xi + list_sum(list_transform(al, lambda c, i: c * sin(2 * i * xi) * cosh(2 * i * eta)))), 2) AS northing FROM s""", ("geo",))
def utm_positions(spark: SparkSession, d: str) -> DataFrame:
    g = frame(spark, d, "geo").withColumn("zone", geo.utm_zone(F.col("lon")))
    e, n = geo.utm_forward(F.col("lat"), F.col("lon"), F.col("zone"), F.col("lat") < 0)
    return g.select("point_id", "zone", geo.utm_epsg(F.col("lat"), F.col("lon")).alias("epsg"), rnd(e, 2).alias("easting"), rnd(n, 2).alias("northing"))


@query("area_boxes", """+ b AS (SELECT point_id, lat, lon, 50 / 111.0::DOUBLE AS dy, 80 / (111.0::DOUBLE * cos(radians(lat))) AS dx FROM geo), w AS (SELECT point_id, ((lon - dx + 180) % 360 + 360) % 360 - 180 AS west, greatest(lat - dy, -90) AS south, ((lon + dx + 180) % 360 + 360) % 360 - 180 AS east, least(lat + dy, 90) AS north FROM b)
  SELECT point_id, round(west, 6) AS west, round(south, 6) AS south, round(east, 6) AS east, round(north, 6) AS north, west < 30 AND 20 < east AND south < 40 AND 30 < north AS overlaps FROM w""", ("geo",))
def area_boxes(spark: SparkSession, d: str) -> DataFrame:
    b = frame(spark, d, "geo").select("point_id", *(c.alias(k) for k, c in geo.bbox(F.col("lat"), F.col("lon"), F.lit(50.0), F.lit(80.0)).items()))
    hit = geo.boxes_overlap(tuple(F.col(c) for c in ("west", "south", "east", "north")), tuple(map(F.lit, (20.0, 30.0, 30.0, 40.0))))
    return b.select("point_id", r6("west"), r6("south"), r6("east"), r6("north"), hit.alias("overlaps"))


@query("solar_window", "WITH h AS (SELECT event_id, (((hour(ts) + minute(ts) / 60.0::DOUBLE + second(ts) / 3600.0::DOUBLE + (user_id % 360 - 180) / 15.0::DOUBLE) % 24) + 24) % 24 AS h FROM events) SELECT event_id, round(h, 6) AS solar_hour, h >= 19 OR h < 5 AS night, h >= 10 AND h < 14 AS noon FROM h")
def solar_window(spark: SparkSession, d: str) -> DataFrame:
    h = table(spark, d, "events").select("event_id", times.solar_hour(F.col("ts"), F.col("user_id") % 360 - 180).alias("h"))
    return h.select("event_id", rnd("h", 6).alias("solar_hour"), times.in_window(F.col("h"), 19, 5).alias("night"), times.in_window(F.col("h"), 10, 14).alias("noon"))


@query("reference_instants", """+ r AS (SELECT point_id, 10.5::DOUBLE - round(lon / 7.5, 0) / 2 AS h FROM geo)
  SELECT point_id, DATE '2024-03-01'::TIMESTAMP + INTERVAL 1 HOUR * (CASE WHEN h - floor(h) = 0.5 THEN CASE WHEN floor(h)::BIGINT % 2 = 0 THEN floor(h) ELSE floor(h) + 1 END ELSE round(h) END)::BIGINT AS instant FROM r""", ("geo",), instants=("instant",))
def reference_instants(spark: SparkSession, d: str) -> DataFrame:
    lon = F.round(F.col("lon") / 7.5, 0) * 7.5
    return frame(spark, d, "geo").select("point_id", times.reference_instant(F.lit("2024-03-01").cast("date"), lon, times.clock_hours("10:30")).alias("instant"))


@query("season_terms", "SELECT DISTINCT CAST(o_orderdate AS DATE) AS day, round(sin(dayofyear(o_orderdate) * 2 * pi() / 365.25), 6) AS doy_sin, round(cos(dayofyear(o_orderdate) * 2 * pi() / 365.25), 6) AS doy_cos FROM orders", day="day")
def season_terms(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    s, c = times.season(F.col("day"))
    return o.select("day", rnd(s, 6).alias("doy_sin"), rnd(c, 6).alias("doy_cos"))


@query("granule_stamps", "SELECT granule, strptime(regexp_extract(granule, '_([0-9]{8}T[0-9]{6})', 1), '%Y%m%dT%H%M%S') AS instant, CAST(least(floor((hour(time) + 1.5) / 3) * 3, 21) AS INT) AS cycle, count(*) AS n FROM overpass WHERE regexp_matches(granule, '_[0-9]{8}T[0-9]{6}') GROUP BY ALL", instants=("instant",))
def granule_stamps(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "overpass").select("granule", times.stamp_in_name(F.col("granule")).alias("instant"), times.model_cycle(F.hour("time"), 3).alias("cycle")).where("instant IS NOT NULL")
    return o.groupBy("granule", "instant", "cycle").agg(F.count("*").alias("n"))


@query("unit_conversion", "SELECT row_id, round(any_value(CASE units WHEN 'degC' THEN value WHEN 'K' THEN value - 273.15 WHEN 'degF' THEN (value - 32) * 5 / 9 END), 6) AS celsius FROM logger_row JOIN feed USING (feed_id) WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY 1")
def unit_conversion(spark: SparkSession, d: str) -> DataFrame:
    r = values.null_nan(table(spark, d, "logger_row"), "value").where("value IS NOT NULL").join(table(spark, d, "feed").select("feed_id", "units"), "feed_id")
    return r.groupBy("row_id").agg(rnd(F.first(values.to_celsius(F.col("value"), F.col("units"))), 6).alias("celsius"))


@query("met_fields", "SELECT l_returnflag, l_linestatus, round(avg(sqrt(l_tax * l_tax + l_discount * l_discount)), 6) AS wind_speed, round(avg(l_extendedprice / 3600.0), 6) AS swrad, round(avg(CASE WHEN l_tax + l_discount <> 0 THEN (l_tax - l_discount) / (l_tax + l_discount) END), 6) AS index FROM lineitem GROUP BY 1, 2")
def met_fields(spark: SparkSession, d: str) -> DataFrame:
    u, v = F.col("l_tax"), F.col("l_discount")
    return table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(rnd(F.avg(values.wind_speed(u, v)), 6).alias("wind_speed"), rnd(F.avg(values.hourly_flux(F.col("l_extendedprice"))), 6).alias("swrad"), rnd(F.avg(values.normalised_difference(u, v)), 6).alias("index"))


@query("missing_rules", "SELECT user_id, round(CASE WHEN count(value) = count(*) THEN avg(value) END, 6) AS mean, round(avg(value), 6) AS nanmean, round(CASE WHEN count(value) = count(*) THEN stddev_pop(value) END, 6) AS std, round(coalesce(sum(value), 0), 6) AS nansum, count(*)::DOUBLE AS count, count(value)::DOUBLE AS count_valid, round(quantile_cont(value, 0.1), 6) AS p10 FROM pingu GROUP BY 1", ("pingu",))
def missing_rules(spark: SparkSession, d: str) -> DataFrame:
    names = ["mean", "nanmean", "std", "nansum", "count", "count_valid", "p10"]
    return frame(spark, d, "pingu").groupBy("user_id").agg(*(rnd(values.statistic(s, F.col("value")), 6).alias(s) for s in names))


# ---- rasters --------------------------------------------------------------------------------------------------------------

SPARSE = f"SELECT l_returnflag AS scene, {CELL.format('l_partkey')}, CASE WHEN max(l_extendedprice) > 30000 + 200 * (max(l_partkey) % 400) THEN max(l_extendedprice) / 1000 END AS value FROM {{lineitem}} GROUP BY 1, 2, 3"


@query("nn_fill", f"""+ f AS ({SPARSE.format(lineitem='lineitem')}), want AS (SELECT scene, s.cr, s.cc FROM (SELECT DISTINCT scene FROM f) CROSS JOIN static s LEFT JOIN f USING (scene, cr, cc) WHERE s.water > 0 AND f.value IS NULL),
  n AS (SELECT w.scene, w.cr, w.cc, f.value, row_number() OVER (PARTITION BY w.scene, w.cr, w.cc ORDER BY pow(f.cr - w.cr, 2) + pow(f.cc - w.cc, 2), f.cr, f.cc) AS k FROM want w JOIN (SELECT * FROM f WHERE value IS NOT NULL) f USING (scene))
  SELECT scene, cr AS row, cc AS col, value, true AS filled FROM n WHERE k = 1 UNION ALL SELECT scene, cr, cc, value, false FROM f WHERE value IS NOT NULL""", ("static",))
def nn_fill(spark: SparkSession, d: str) -> DataFrame:
    return rasters.fill_nearest(frame(spark, d, SPARSE), frame(spark, d, "static"), GRID, keys=["scene"])


SHIFT_GRID = geo.Grid(0.0, 6000.0, 100.0, 60, 60)
SHIFT_RULE = rasters.GeorefRule(tol_m=100.0, max_shift_m=1000.0, min_coast=50, min_edges=30, z_min=2.0, lift_min=1.5, ok_shift_m=100.0, windows_m=(500.0, 1000.0))
DISK = "SELECT n_nationkey AS scene, CAST(floor(k / 60) AS INT) AS cr, CAST(k % 60 AS INT) AS cc, CASE WHEN pow(k % 60 - 30 - (n_nationkey % 5 - 2), 2) + pow(floor(k / 60) - 30 - (floor(n_nationkey / 5) - 2), 2) < 400 THEN 280.0 ELSE 290.0 END + (k * 7919 % 100) / 10000.0 AS sst FROM (SELECT n_nationkey, explode(sequence(0, 3599)) AS k FROM {nation})"


def _disk(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    s = frame(spark, d, DISK).withColumn("sst", F.col("sst").cast("double"))
    w = frame(spark, d, "SELECT CAST(floor(k / 60) AS INT) AS cr, CAST(k % 60 AS INT) AS cc, CASE WHEN pow(k % 60 - 30, 2) + pow(floor(k / 60) - 30, 2) < 400 THEN 1 ELSE 0 END AS water FROM (SELECT explode(sequence(0, 3599)) AS k)")
    return s, w


@query("georef_check", """WITH cell AS (SELECT k // 60 AS y, k % 60 AS x, pow(k % 60 - 30, 2) + pow(k // 60 - 30, 2) < 400 AS water, k FROM range(3600) AS t(k)),
  coast AS (SELECT count(*) AS n FROM cell w WHERE water AND EXISTS (SELECT 1 FROM cell l WHERE NOT l.water AND l.y BETWEEN w.y - 1 AND w.y + 1 AND l.x BETWEEN w.x - 1 AND w.x + 1)),
  moved AS (SELECT n_nationkey AS scene, (n_nationkey // 5 - 2)::INT AS my, (n_nationkey % 5 - 2)::INT AS mx FROM nation),
  v AS (SELECT scene, water, CASE WHEN pow(x - 30 - mx, 2) + pow(y - 30 - my, 2) < 400 THEN 280.0 ELSE 290.0 END + (k * 7919 % 100) / 10000.0 AS sst FROM moved, cell),
  q AS (SELECT scene, round(abs(avg(sst) FILTER (WHERE NOT water) - avg(sst) FILTER (WHERE water)), 6) AS contrast FROM v GROUP BY 1)
  SELECT scene, -my AS dy, -mx AS dx, round(100 * sqrt(my * my + mx * mx), 6) AS shift_m, coast.n AS coast_obs, contrast, CASE WHEN my * my + mx * mx <= 1 THEN 'ok' ELSE 'displaced' END AS verdict FROM moved JOIN q USING (scene), coast""")
def georef_check(spark: SparkSession, d: str) -> DataFrame:
    """The disk is moved by a known number of cells in each scene; the check has to find just that."""
    s, w = _disk(spark, d)
    return rasters.check_georeference(s, w, SHIFT_GRID, SHIFT_RULE, keys=["scene"]).select("scene", "dy", "dx", r6("shift_m"), "coast_obs", r6("contrast"), "verdict")


@query("georef_correct", """WITH k AS (SELECT n_nationkey AS scene, (2 - n_nationkey // 5)::INT AS dy, (2 - n_nationkey % 5)::INT AS dx FROM nation), s AS (SELECT l_suppkey % 25 AS scene, CAST(floor(l_partkey % 400 / 20) AS INT) AS cr, CAST(l_partkey % 20 AS INT) AS cc, max(l_quantity) AS sst FROM lineitem GROUP BY 1, 2, 3),
  m AS (SELECT s.scene, s.cr + CASE WHEN scene % 2 = 0 THEN dy ELSE 0 END AS cr, s.cc + CASE WHEN scene % 2 = 0 THEN dx ELSE 0 END AS cc, sst AS moved FROM s JOIN k USING (scene))
  SELECT s.scene, s.cr AS row, s.cc AS col, sst, moved AS sst_corrected FROM s LEFT JOIN m ON m.scene = s.scene AND m.cr = s.cr AND m.cc = s.cc""")
def georef_correct(spark: SparkSession, d: str) -> DataFrame:
    s = frame(spark, d, f"SELECT l_suppkey % 25 AS scene, {CELL.format('l_partkey')}, max(l_quantity) AS sst FROM {{lineitem}} GROUP BY 1, 2, 3")
    v = frame(spark, d, "SELECT n_nationkey AS scene, CAST(2 - floor(n_nationkey / 5) AS INT) AS dy, CAST(2 - n_nationkey % 5 AS INT) AS dx, CASE WHEN n_nationkey % 2 = 0 THEN 'displaced' ELSE 'ok' END AS verdict FROM {nation}")
    return rasters.correct_georeference(s, v, GRID, keys=["scene"], fills={"sst": None})


@query("swath_to_grid", """+ p AS (SELECT point_id AS pixel, x, y, s_acctbal AS value FROM place JOIN supplier ON s_suppkey = point_id), c AS (SELECT r, c FROM range(20) a(r), range(20) b(c)),
  j AS (SELECT r, c, pixel, value, pow((c + 0.5) * 100 - x, 2) + pow(2000 - (r + 0.5) * 100 - y, 2) AS d2 FROM c JOIN p ON pow((c + 0.5) * 100 - x, 2) + pow(2000 - (r + 0.5) * 100 - y, 2) <= 22500)
  SELECT 1 AS scene, r::INT AS row, c::INT AS col, value, pixel FROM (SELECT *, row_number() OVER (PARTITION BY r, c ORDER BY d2, pixel) AS k FROM j) WHERE k = 1""", ("place",))
def swath_to_grid(spark: SparkSession, d: str) -> DataFrame:
    p = frame(spark, d, "place").join(table(spark, d, "supplier").select(F.col("s_suppkey").alias("point_id"), F.col("s_acctbal").alias("value")), "point_id")
    return rasters.swath_to_grid(p.withColumnRenamed("point_id", "pixel").withColumn("scene", F.lit(1)), GRID, 150.0, keys=["scene"])


@query("bilinear_points", """+ t AS (SELECT point_id, lat, lon, floor((lat + 80) / 8)::INT AS i, floor((lon + 180) / 18)::INT AS j, (lat + 80) / 8 - floor((lat + 80) / 8) AS fy, (lon + 180) / 18 - floor((lon + 180) / 18) AS fx FROM geo),
  q AS (SELECT point_id, i + a AS cr, j + b AS cc, (CASE WHEN a = 1 THEN fy ELSE 1 - fy END) * (CASE WHEN b = 1 THEN fx ELSE 1 - fx END) AS w FROM t, (VALUES (0), (1)) u(a), (VALUES (0), (1)) v(b)),
  n AS (SELECT point_id, count(*) AS need FROM q WHERE w > 0 GROUP BY 1) SELECT point_id AS target_id, round(CASE WHEN count(*) = any_value(need) THEN sum(w * elevation) END, 6) AS value FROM q JOIN n USING (point_id) JOIN static USING (cr, cc) WHERE w > 0 AND elevation IS NOT NULL GROUP BY 1""", ("geo", "static"))
def bilinear_points(spark: SparkSession, d: str) -> DataFrame:
    f = frame(spark, d, "static").select(F.col("row").alias("i"), F.col("col").alias("j"), F.col("elevation").alias("value"))
    t = frame(spark, d, "geo").select(F.col("point_id").alias("target_id"), (F.col("lat") + 80).alias("lat"), ((F.col("lon") + 180) / 18 * 8).alias("lon"))
    return rasters.bilinear(t, f, lat0=0.0, lon0=0.0, step=8.0, keys=[]).withColumn("value", rnd("value", 6))


@query("scene_quality", """+ land AS (SELECT cr, cc FROM static WHERE water <= 0.5), cells AS (SELECT y AS cr, x AS cc FROM range(20) a(y), range(20) b(x)),
  coast AS (SELECT c.cr, c.cc FROM cells c ANTI JOIN land USING (cr, cc) SEMI JOIN land l ON abs(l.cr - c.cr) <= 1 AND abs(l.cc - c.cc) <= 1),
  j AS (SELECT granule, sst, land.cr IS NOT NULL AS on_land, coast.cr IS NOT NULL AS on_coast FROM scene s LEFT JOIN land ON land.cr = s.cr AND land.cc = s.cc LEFT JOIN coast ON coast.cr = s.cr AND coast.cc = s.cc)
  SELECT granule, round(count(sst) / 400.0::DOUBLE, 6) AS valid_frac, count(sst) FILTER (WHERE on_coast) AS coast_obs, round(count(sst) FILTER (WHERE on_coast) / (SELECT greatest(count(*), 1) FROM coast)::DOUBLE, 6) AS coast_obs_frac,
    round(abs(avg(sst) FILTER (WHERE on_land) - avg(sst) FILTER (WHERE NOT on_land)), 6) AS contrast FROM j GROUP BY 1""", ("scene", "static"))
def scene_quality(spark: SparkSession, d: str) -> DataFrame:
    s = frame(spark, d, "scene").drop("water")
    return rasters.scene_quality(s, frame(spark, d, "static"), GRID, keys=["granule"]).select("granule", r6("valid_frac"), "coast_obs", r6("coast_obs_frac"), r6("contrast"))


#: M2, K1 and O1 of every supplier: (number, amplitude, phase).
NODAL = "SELECT s_suppkey AS station_id, unnest([1, 4, 6]) AS number, unnest([1.2, 0.4, 0.3]) AS amplitude, unnest([CAST(s_suppkey % 360 AS DOUBLE), 40.0, 210.0]) AS phase_deg FROM supplier"
NODAL_SPARK = "SELECT s_suppkey AS station_id, inline(array(struct(1 AS number, 1.2D AS amplitude, CAST(s_suppkey % 360 AS DOUBLE) AS phase_deg), struct(4 AS number, 0.4D AS amplitude, 40.0D AS phase_deg), struct(6 AS number, 0.3D AS amplitude, 210.0D AS phase_deg))) FROM {supplier}"


@query("tide_nodal", f"""WITH c AS ({NODAL}), t AS (SELECT ts, epoch(ts) / 86400 - 10957.5 AS d FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-02 23:00:00', INTERVAL 1 HOUR)) AS ts)),
  l AS (SELECT ts, (d - floor(d)) * 360 AS t0, 218.3164591 + 481267.88134236 * d / 36525 - 0.0013268 * pow(d / 36525, 2) AS s, 280.46645 + 36000.76983 * d / 36525 + 0.0003032 * pow(d / 36525, 2) AS h, radians(125.044555 - 1934.1361849 * d / 36525 + 0.0020762 * pow(d / 36525, 2)) AS n FROM t),
  i AS (SELECT *, acos(cos(radians(5.145)) * cos(radians(23.4392911)) - sin(radians(5.145)) * sin(radians(23.4392911)) * cos(n)) AS i, asin(sin(radians(5.145)) * sin(n) / sin(acos(cos(radians(5.145)) * cos(radians(23.4392911)) - sin(radians(5.145)) * sin(radians(23.4392911)) * cos(n)))) AS nu FROM l),
  x AS (SELECT *, atan2(sin(radians(23.4392911)) * sin(n), cos(radians(5.145)) * sin(radians(23.4392911)) * cos(n) + sin(radians(5.145)) * cos(radians(23.4392911))) AS arc, atan2(sin(2 * i) * sin(nu), sin(2 * i) * cos(nu) + 0.3347) AS nu1 FROM i),
  y AS (SELECT *, n - arc - 2 * pi() * round((n - arc) / (2 * pi())) AS xi FROM x),
  f AS (SELECT ts, unnest([1, 4, 6]) AS number, unnest([pow(cos(i / 2), 4) / 0.9154, sqrt(0.8965 * pow(sin(2 * i), 2) + 0.6001 * sin(2 * i) * cos(nu) + 0.1006), sin(i) * pow(cos(i / 2), 2) / 0.38]) AS f,
          unnest([2 * t0 - 2 * s + 2 * h + degrees(2 * xi - 2 * nu), t0 + h - 90 - degrees(nu1), t0 - 2 * s + h + 90 + degrees(2 * xi - nu)]) AS v FROM y)
  SELECT station_id, ts, round(sum(amplitude * f * cos(radians(v - phase_deg))), 5) AS value FROM c JOIN f USING (number) GROUP BY 1, 2""", instants=("ts",))
def tide_nodal(spark: SparkSession, d: str) -> DataFrame:
    return tides.predict_harmonics(frame(spark, d, NODAL_SPARK), start="2024-01-01", end="2024-01-02").withColumn("value", rnd("value", 5))


# ---- tides, catalogues, streams -------------------------------------------------------------------------------------------

HARMONICS = "SELECT s_suppkey AS station_id, 1 + s_acctbal / 10000 AS amplitude, 28.9841042 AS speed_deg_h, CAST(s_suppkey % 360 AS DOUBLE) AS phase_deg FROM {supplier} UNION ALL SELECT s_suppkey, 0.3, 15.0410686, CAST(s_suppkey * 7 % 360 AS DOUBLE) FROM {supplier}"


@query("tide_prediction", f"""WITH c AS ({HARMONICS.format(supplier='supplier')}), t AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-03 23:00:00', INTERVAL 1 HOUR)) AS ts)
  SELECT station_id, ts, round(sum(amplitude * cos(radians(speed_deg_h * (epoch(ts) / 3600) - phase_deg))), 5) AS value FROM c CROSS JOIN t GROUP BY 1, 2""", instants=("ts",))
def tide_prediction(spark: SparkSession, d: str) -> DataFrame:
    c = frame(spark, d, HARMONICS).select("station_id", *(F.col(x).cast("double").alias(x) for x in ("amplitude", "speed_deg_h", "phase_deg")))
    return tides.predict(c.select("station_id").distinct(), c, start="2024-01-01", end="2024-01-03").withColumn("value", rnd("value", 5))


@query("scene_search", "SELECT overpass_id, any_value(sensor) AS sensor FROM overpass JOIN aoi USING (aoi) WHERE time >= TIMESTAMP '2024-06-01' AND time < TIMESTAMP '2025-06-16' AND sensor IN ('lst', 'eco') AND west < 20 AND -30 < east AND south < 60 AND -20 < north AND overpass_id % 100 < 40 GROUP BY 1")
def scene_search(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "overpass").join(table(spark, d, "aoi").drop("wkt"), "aoi").withColumnRenamed("sensor", "platform").withColumn("cloud_cover", F.col("overpass_id") % 100)
    s = files.search_scenes(c, box=(-30.0, -20.0, 20.0, 60.0), start="2024-06-01", end="2025-06-15", platforms=["lst", "eco"], cloud_max=0.4)
    return s.groupBy("overpass_id").agg(F.first("platform").alias("sensor"))


TILES = "SELECT s_suppkey AS id, concat('ncei19_', CASE WHEN s_suppkey % 3 = 0 THEN 's' ELSE 'n' END, lpad(CAST(s_suppkey % 60 AS STRING), 2, '0'), 'x', CASE s_suppkey % 4 WHEN 0 THEN '00' WHEN 1 THEN '25' WHEN 2 THEN '50' ELSE '75' END, '_w', lpad(CAST(s_suppkey % 180 AS STRING), 3, '0'), 'x50_2018v1.tif') AS name FROM {supplier}"


@query("tile_bounds", f"""WITH t AS ({TILES.format(supplier='supplier').replace('AS STRING', 'AS VARCHAR')}), p AS (SELECT id, regexp_extract(name, '([ns])([0-9]{{2}})x([0-9]{{2}})_([ew])([0-9]{{3}})x([0-9]{{2}})', ['s', 'a', 'b', 'w', 'c', 'd']) AS x FROM t),
  b AS (SELECT id, (x.a::DOUBLE + x.b::DOUBLE / 100) * CASE WHEN x.s = 's' THEN -1 ELSE 1 END AS north, (x.c::DOUBLE + x.d::DOUBLE / 100) * CASE WHEN x.w = 'w' THEN -1 ELSE 1 END AS west FROM p)
  SELECT id, west, north - 0.25 AS south, west + 0.25 AS east, north, west < -60 AND -90 < west + 0.25 AND north - 0.25 < 45 AND 10 < north AS wanted FROM b""")
def tile_bounds(spark: SparkSession, d: str) -> DataFrame:
    t = frame(spark, d, TILES)
    b = t.select("id", *(c.alias(k) for k, c in files.tile_bounds(F.col("name")).items()))
    return b.withColumn("wanted", geo.boxes_overlap(tuple(F.col(c) for c in ("west", "south", "east", "north")), tuple(map(F.lit, (-90.0, 10.0, -60.0, 45.0)))))


DAYS = "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN concat('A', year(o_orderdate), lpad(CAST(month(o_orderdate) AS STRING), 2, '0'), '15.nc') ELSE 'unnamed' END AS name, CASE WHEN o_orderkey % 5 > 0 THEN o_orderdate END AS t0, o_orderdate + INTERVAL 36 HOURS AS t1 FROM {orders}"
FLOWN = "SELECT DISTINCT CAST(l_shipdate AS DATE) AS day FROM {lineitem} WHERE l_quantity > 48"


@query("granule_days", f"""WITH g AS ({DAYS.format(orders='orders').replace('AS STRING', 'AS VARCHAR')}), s AS (SELECT id, coalesce(CAST(try_strptime(nullif(regexp_extract(name, '([0-9]{{8}})', 1), ''), '%Y%m%d') AS DATE), CAST(t0 + (t1 - t0) / 2 AS DATE)) AS day FROM g)
  SELECT id, day FROM s WHERE day IS NULL OR day IN (SELECT day FROM ({FLOWN.format(lineitem='lineitem')}))""", day="day")
def granule_days(spark: SparkSession, d: str) -> DataFrame:
    g = frame(spark, d, DAYS).select("id", files.granule_day(F.col("name"), F.col("t0"), F.col("t1")).alias("day"))
    return files.days_kept(g, frame(spark, d, FLOWN))


@query("user_observations", """WITH r AS (SELECT station_id, strptime(trim(time, ' ' || chr(9)), '%Y-%m-%d %H:%M:%S') AT TIME ZONE coalesce(time_zone, 'UTC') AT TIME ZONE 'UTC' AS u, coalesce(time_zone, 'UTC') AS tz, strptime(trim(time, ' ' || chr(9)), '%Y-%m-%d %H:%M:%S') AS w,
    CASE units WHEN 'degC' THEN value WHEN 'K' THEN value - 273.15 ELSE (value - 32) * 5 / 9 END AS v FROM logger_row JOIN feed USING (feed_id)
    WHERE regexp_full_match(trim(time, ' ' || chr(9)), '[0-9]{4}-(0[1-9]|1[0-2])-[0-9]{2} ([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]') AND try_strptime(trim(time, ' ' || chr(9)), '%Y-%m-%d %H:%M:%S') IS NOT NULL AND value IS NOT NULL AND NOT isnan(value))
  SELECT station_id, count(*) AS n, sum((v NOT BETWEEN -5 AND 45)::INT)::BIGINT AS n_suspect FROM r WHERE station_id IS NOT NULL AND (u AT TIME ZONE 'UTC') AT TIME ZONE tz = w
    AND NOT ((u + INTERVAL 1 HOUR) AT TIME ZONE 'UTC') AT TIME ZONE tz = w AND NOT ((u - INTERVAL 1 HOUR) AT TIME ZONE 'UTC') AT TIME ZONE tz = w
    AND NOT ((u + INTERVAL 30 MINUTE) AT TIME ZONE 'UTC') AT TIME ZONE tz = w AND NOT ((u - INTERVAL 30 MINUTE) AT TIME ZONE 'UTC') AT TIME ZONE tz = w GROUP BY 1""")
def user_observations(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "logger_row").withColumn("time", F.regexp_replace("time", r"^[ \t]+|[ \t]+$", "")).where(F.regexp_like("time", F.lit(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$")))
    r = r.join(table(spark, d, "feed").select("feed_id", "time_zone", "units"), "feed_id")
    o = files.observations(r, columns={"station_id": "station_id", "time": "time", "value": "value"}, units=F.col("units"), zone=F.coalesce("time_zone", F.lit("UTC")))
    return o.groupBy("station_id").agg(F.count("*").alias("n"), F.sum(F.col("suspect").cast("long")).alias("n_suspect"))


@query("stream_hourly", "WITH r AS (SELECT DISTINCT station_id, time, obs_id, value FROM obs WHERE isfinite(value)) SELECT station_id, date_trunc('hour', time) AS start, count(*) AS n, round(avg(value), 6) AS mean, min(value) AS low, max(value) AS high FROM r GROUP BY 1, 2", instants=("start",))
def stream_hourly(spark: SparkSession, d: str) -> DataFrame:
    schema = table(spark, d, "obs").schema
    s = streaming.stream_of(spark, f"{d}/obs.parquet*", schema)
    # readings come up to two months late; what is later than that would be left out
    out = streaming.drain(streaming.windowed(s, late="60 days"), ["station_id", "start"])
    return out.withColumn("mean", rnd("mean", 6))


# ---- selecting and shaping source rows ------------------------------------------------------------------------------------


@query("find_stations", "SELECT DISTINCT s.station_id FROM station s JOIN (SELECT station_id, min(time) AS a, max(time) AS b FROM obs GROUP BY 1) o USING (station_id) WHERE lat BETWEEN -60.5 AND 70.5 AND lon BETWEEN -170.5 AND 170.5 AND a < TIMESTAMP '2025-01-01' AND b >= TIMESTAMP '2024-05-01'")
def find_stations(spark: SparkSession, d: str) -> DataFrame:
    spans = table(spark, d, "obs").groupBy("station_id").agg(F.min("time").alias("first"), F.max("time").alias("last"))
    return acquire.find_stations(table(spark, d, "station"), spans, box=(-170.0, -60.0, 170.0, 70.0), start="2024-05-01", end="2024-12-31", pad=0.5).select("station_id")


@query("station_medians", f"WITH p AS ({DRIFT.format(events='events')}) SELECT user_id, round(median(lat::DOUBLE), 6) AS lat, round(median(lon::DOUBLE), 6) AS lon, count(*) AS n FROM p GROUP BY 1")
def station_medians(spark: SparkSession, d: str) -> DataFrame:
    p = frame(spark, d, DRIFT).withColumns({"lat": F.col("lat").cast("double"), "lon": F.col("lon").cast("double")})
    return acquire.station_medians(p, key="user_id").select("user_id", r6("lat"), r6("lon"), "n")


@query("first_variable", "SELECT day, cr AS row, cc AS col, coalesce(value, baseline, cloud_pct) AS sst FROM cubed", ("cubed",), day="day")
def first_variable(spark: SparkSession, d: str) -> DataFrame:
    return acquire.first_present(frame(spark, d, "cubed"), ["missing", "value", "baseline", "cloud_pct"], "sst").select("day", "row", "col", "sst")


@query("areas_meeting_box", "SELECT aoi FROM aoi WHERE west < 12 AND -120 < east AND south < 50.05 AND -40.05 < north")
def areas_meeting_box(spark: SparkSession, d: str) -> DataFrame:
    return acquire.boxes_meeting(table(spark, d, "aoi"), (-120.0, -40.05, 12.0, 50.05)).select("aoi")


@query("footprints_meeting_box", """WITH rings AS (SELECT aoi, unnest(regexp_extract_all(wkt, '\\(([^()]+)\\)', 1)) AS r FROM aoi),
  pts AS (SELECT aoi, list_transform(string_split(r, ','), lambda q: list_transform(string_split(trim(q), ' '), lambda v: v::DOUBLE)) AS q FROM rings),
  seg AS (SELECT aoi, t.turn, q[i][1] + t.turn AS x0, q[i][2] AS y0, q[i + 1][1] + t.turn AS x1, q[i + 1][2] AS y1 FROM (SELECT aoi, q, unnest(generate_series(1, len(q) - 1)) AS i FROM pts), (VALUES (-360), (0), (360)) AS t(turn)),
  box AS (SELECT -120.0 AS w, -40.05 AS s, 12.0 AS e, 50.05 AS n), corner AS (SELECT w AS x, s AS y FROM box UNION ALL SELECT e, s FROM box UNION ALL SELECT e, n FROM box UNION ALL SELECT w, n FROM box),
  side AS (SELECT w AS px, s AS py, e AS qx, s AS qy FROM box UNION ALL SELECT e, s, e, n FROM box UNION ALL SELECT e, n, w, n FROM box UNION ALL SELECT w, n, w, s FROM box),
  vertex AS (SELECT DISTINCT aoi FROM seg, box WHERE x0 BETWEEN w AND e AND y0 BETWEEN s AND n),
  crossing AS (SELECT DISTINCT aoi FROM seg, side WHERE ((qx - px) * (y0 - py) - (qy - py) * (x0 - px)) * ((qx - px) * (y1 - py) - (qy - py) * (x1 - px)) <= 0 AND ((x1 - x0) * (py - y0) - (y1 - y0) * (px - x0)) * ((x1 - x0) * (qy - y0) - (y1 - y0) * (qx - x0)) <= 0),
  held AS (SELECT DISTINCT aoi FROM (SELECT aoi, turn, x, y, count(*) AS c FROM seg, corner WHERE (y0 > y) <> (y1 > y) AND x < (x1 - x0) * (y - y0) / (y1 - y0) + x0 GROUP BY 1, 2, 3, 4) WHERE c % 2 = 1)
  SELECT aoi FROM vertex UNION SELECT aoi FROM crossing UNION SELECT aoi FROM held UNION SELECT aoi FROM aoi WHERE wkt IS NULL""")
def footprints_meeting_box(spark: SparkSession, d: str) -> DataFrame:
    return acquire.meets_box(table(spark, d, "aoi").select("aoi", "wkt"), (-120.0, -40.05, 12.0, 50.05)).select("aoi")


TAGGED = "SELECT event_id, ts, CASE event_id % 5 WHEN 0 THEN 'D' WHEN 1 THEN 'N' END AS tag FROM {events}"


@query("night_granules", f"WITH g AS ({TAGGED.format(events='events')}), h AS (SELECT *, (((hour(ts) + minute(ts) / 60.0::DOUBLE + second(ts) / 3600.0::DOUBLE + -70.0 / 15) % 24) + 24) % 24 AS h FROM g) SELECT event_id, round(h, 6) AS solar_h FROM h WHERE (h >= 19 OR h < 5) AND coalesce(tag <> 'D', true)")
def night_granules(spark: SparkSession, d: str) -> DataFrame:
    return acquire.by_time_of_day(frame(spark, d, TAGGED), lon=F.lit(-70.0), wanted="night").select("event_id", r6("solar_h"))


@query("swath_quality", "SELECT day, granule, count(*) AS n, count(CASE WHEN quality >= 2 THEN sst END) AS kept FROM scene GROUP BY 1, 2", ("scene",), day="day")
def swath_quality(spark: SparkSession, d: str) -> DataFrame:
    s = frame(spark, d, "scene").withColumn("raw", F.col("sst"))
    return acquire.swath_values(s, least=2).groupBy("day", "granule").agg(F.count("*").alias("n"), F.count("sst").alias("kept"))


LAYERS = f"SELECT concat('g', l_suppkey % 40) AS granule, CASE l_linenumber % 4 WHEN 0 THEN 'sst' WHEN 1 THEN 'cloud' WHEN 2 THEN 'water' ELSE 'error' END AS role, {CELL.format('l_partkey')}, CASE WHEN l_suppkey % 40 = 7 AND l_linenumber % 4 = 1 THEN NULL ELSE max(l_quantity) END AS value FROM {{lineitem}} GROUP BY l_suppkey % 40, l_linenumber % 4, 3, 4"


@query("aligned_layers", f"""WITH l AS ({LAYERS.format(lineitem='lineitem')}), ok AS (SELECT granule FROM l WHERE role IN ('sst', 'cloud') AND value IS NOT NULL GROUP BY 1 HAVING count(DISTINCT role) = 2)
  SELECT granule, cr AS row, cc AS col, max(value) FILTER (WHERE role = 'sst') AS sst, max(value) FILTER (WHERE role = 'cloud') AS cloud, max(value) FILTER (WHERE role = 'water') AS water FROM l JOIN ok USING (granule) GROUP BY 1, 2, 3""")
def aligned_layers(spark: SparkSession, d: str) -> DataFrame:
    return acquire.aligned_layers(frame(spark, d, LAYERS), core=["sst", "cloud"], others=["water"])


STEPS = f"SELECT CASE l_suppkey % 2 WHEN 0 THEN 'thetao' ELSE 'zos' END AS var, CAST(l_suppkey % 3 AS DOUBLE) * 2.5 AS level, {CELL.format('l_partkey')}, date_trunc('month', l_shipdate) + INTERVAL 1 HOUR * (l_linenumber % 5) AS ts0, max(l_quantity) AS value FROM {{lineitem}} GROUP BY 1, 2, 3, 4, 5"


@query("level_channels", f"""WITH s AS ({STEPS.format(lineitem='lineitem')}), f AS (SELECT CAST(ts0 AS DATE) AS day, var, level, cr, cc, arg_min(value, ts0) AS value FROM s GROUP BY 1, 2, 3, 4, 5)
  SELECT day, cr AS row, cc AS col, max(value) FILTER (WHERE var = 'thetao' AND level = 0) AS thetao_0m, max(value) FILTER (WHERE var = 'thetao' AND level = 2.5) AS thetao_2p5m, max(value) FILTER (WHERE var = 'zos') AS zos FROM f GROUP BY 1, 2, 3""", day="day")
def level_channels(spark: SparkSession, d: str) -> DataFrame:
    s = frame(spark, d, STEPS.replace("INTERVAL 1 HOUR * (l_linenumber % 5)", "make_interval(0, 0, 0, 0, l_linenumber % 5)"))
    return acquire.level_channels(acquire.first_step_of_day(s), {"thetao": [0.0, 2.5], "zos": [None]})


@query("field_subset", "SELECT obs_id, any_value(station_id) AS station_id FROM obs JOIN station USING (station_id) WHERE lat BETWEEN -45.5 AND 55.5 AND lon BETWEEN -60.5 AND 140.5 AND time >= TIMESTAMP '2024-02-01' AND time < TIMESTAMP '2025-08-02' AND z BETWEEN 0 AND 5.2 GROUP BY 1")
def field_subset(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "obs").join(table(spark, d, "station").select("station_id", "lat", "lon"), "station_id").withColumnsRenamed({"time": "ts", "z": "depth"})
    s = acquire.subset(f, box=(-60.0, -45.0, 140.0, 55.0), start="2024-02-01", end="2025-08-01", step=0.5, depths=(0.0, 5.2))
    return s.groupBy("obs_id").agg(F.first("station_id").alias("station_id"))


@query("model_choice", "SELECT station_id, CASE WHEN lat BETWEEN 20 AND 75 AND lon BETWEEN -170 AND -50 THEN CASE WHEN lat >= 50 THEN 'hrrrak' ELSE 'hrrr' END END AS model FROM station")
def model_choice(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "station").select("station_id", acquire.model_for(F.col("lat"), F.col("lon")).alias("model"))


@query("items_of_year", "SELECT o_orderkey AS id, year(o_orderdate)::INT AS year, '1998' AS wanted FROM orders WHERE year(o_orderdate) = 1998 UNION ALL SELECT o_orderkey, year(o_orderdate)::INT, '2030' FROM orders")
def items_of_year(spark: SparkSession, d: str) -> DataFrame:
    i = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.year("o_orderdate").alias("year"))
    return acquire.of_year_or_all(i, 1998).withColumn("wanted", F.lit("1998")).unionByName(acquire.of_year_or_all(i, 2030).withColumn("wanted", F.lit("2030")))


DEMS = "SELECT p_partkey AS id, concat(CASE p_size % 3 WHEN 0 THEN 'CUDEM tiles ' WHEN 1 THEN 'gmrt v4 ' ELSE 'other ' END, p_name) AS source FROM {part}"


@query("dem_sources", f"SELECT id, CASE WHEN lower(source) LIKE 'cudem%' THEN 'cudem' WHEN lower(source) LIKE 'gmrt%' THEN 'gmrt' END AS dem FROM ({DEMS.format(part='part')})")
def dem_sources(spark: SparkSession, d: str) -> DataFrame:
    return frame(spark, d, DEMS).select("id", acquire.dem_source(F.col("source")).alias("dem"))


@query("scene_times", "SELECT DISTINCT aoi AS area, CAST(time AS DATE) AS day, time AS ts FROM overpass WHERE sensor IN ('eco', 'lst') AND aoi IS NOT NULL", day="day", instants=("ts",))
def scene_times(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "overpass").where("aoi IS NOT NULL").withColumnsRenamed({"aoi": "area"}).withColumn("ts", F.col("time").cast("timestamp"))
    return acquire.scene_times(o.where("sensor = 'eco'"), o.where("sensor = 'lst'"))


@query("coast_offsets", "SELECT cr AS row, cc AS col, (9 - cc) * 100.0::DOUBLE AS east_m, (cr - 11) * 100.0::DOUBLE AS north_m FROM static", ("static",))
def coast_offsets(spark: SparkSession, d: str) -> DataFrame:
    e = frame(spark, d, "static").select("row", "col", F.lit(11).alias("coast_row"), F.lit(9).alias("coast_col"))
    return acquire.coast_offsets(e, 100.0).select("row", "col", "east_m", "north_m")


@query("coverage_attrs", "SELECT event_type, concat('{\"days\":', count(DISTINCT CAST(ts AS DATE)), ',\"n\":', count(*), '}') AS attrs FROM events GROUP BY 1")
def coverage_attrs(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "events").groupBy("event_type").agg(F.countDistinct(F.to_date("ts")).alias("days"), F.count("*").alias("n"))
    return acquire.attributes(r, key="event_type")


@query("fill_value_clash", "SELECT * FROM (SELECT 'l_quantity' AS channel, sum((l_quantity = 25)::INT)::BIGINT AS n FROM lineitem UNION ALL SELECT 'l_tax', sum((l_tax = -9999)::INT)::BIGINT FROM lineitem) WHERE n > 0")
def fill_value_clash(spark: SparkSession, d: str) -> DataFrame:
    return acquire.fill_value_clash(table(spark, d, "lineitem"), {"l_quantity": 25.0, "l_tax": -9999.0})


@query("time_axis", "SELECT DISTINCT ts FROM (SELECT date_trunc('hour', time) AS ts FROM obs UNION ALL SELECT date_trunc('hour', time) FROM overpass) WHERE ts IS NOT NULL", instants=("ts",))
def time_axis(spark: SparkSession, d: str) -> DataFrame:
    hour = lambda n: table(spark, d, n).select(F.date_trunc("hour", F.col("time").cast("timestamp")).alias("ts"))
    return acquire.time_axis(hour("obs"), hour("overpass"))


SNAPSHOTS = f"SELECT CASE l_returnflag WHEN 'A' THEN 'era5' ELSE 'hrrr' END AS source, l_shipdate AS ts0, {CELL.format('l_partkey')}, CASE l_linenumber % 2 WHEN 0 THEN 'airtemp' ELSE 'swrad' END AS var, max(l_tax) * 100 AS value FROM {{lineitem}} GROUP BY 1, 2, 3, 4, 5"


@query("met_at_overpass", f"""+ b AS (SELECT DISTINCT ts0, cr, cc FROM scene), m AS ({SNAPSHOTS.format(lineitem='lineitem')})
  SELECT ts0 AS ts, cr AS row, cc AS col, max(value) FILTER (WHERE var = 'airtemp' AND source = 'hrrr') AS airtemp_hrrr, max(value) FILTER (WHERE var = 'airtemp' AND source = 'era5') AS airtemp_era5,
    max(value) FILTER (WHERE var = 'swrad' AND source = 'hrrr') AS swrad_hrrr, max(value) FILTER (WHERE var = 'swrad' AND source = 'era5') AS swrad_era5 FROM b LEFT JOIN m USING (ts0, cr, cc) GROUP BY 1, 2, 3""", ("scene",), instants=("ts",))
def met_at_overpass(spark: SparkSession, d: str) -> DataFrame:
    b = frame(spark, d, "scene").select("ts", "row", "col").distinct()
    return acquire.at_scene_time(b, frame(spark, d, SNAPSHOTS), variables=["airtemp", "swrad"], sources=["hrrr", "era5"])


@query("tide_at_overpass", """+ o AS (SELECT DISTINCT overpass_id, trim(station_id) AS s, epoch_us(time) AS t0 FROM overpass), r AS (SELECT station_id AS s, epoch_us(time) AS t, min(value) AS v FROM obs WHERE isfinite(value) GROUP BY 1, 2),
  lo AS (SELECT o.*, r.t AS t1, r.v AS v1 FROM o ASOF LEFT JOIN r ON o.s = r.s AND o.t0 >= r.t), hi AS (SELECT lo.*, r.t AS t2, r.v AS v2 FROM lo ASOF LEFT JOIN r ON lo.s = r.s AND lo.t0 <= r.t)
  SELECT overpass_id::VARCHAR AS overpass_id, s AS station_id, round(CASE WHEN t1 = t2 THEN v1 ELSE v1 + (t0 - t1) / (t2 - t1) * (v2 - v1) END, 6) AS value FROM hi""".removeprefix("+ ").replace("o AS (SELECT", "WITH o AS (SELECT", 1))
def tide_at_overpass(spark: SparkSession, d: str) -> DataFrame:
    q = table(spark, d, "overpass").select("overpass_id", F.trim("station_id").alias("station_id"), "time").distinct()
    v = match.value_between(q, table(spark, d, "obs"), key="station_id", target_id="overpass_id", at="time", time="time", value="value")
    return v.withColumn("value", rnd("value", 6))
