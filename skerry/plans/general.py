"""Queries p1 to p5 (general data-preparation problems) and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skerry.operators.faults import implausible_readings
from skerry.operators.places import containing_regions, near_or_inside, near_pairs, positions
from skerry.operators.regular import hours_without_reading, regular_grid
from skerry.operators.stamps import normalise_stamps, unambiguous_instants
from skerry.runtime import table
from skerry.sources.lines import loaded_lines, rejected_lines


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return near_or_inside(table(spark, d, "sites"), table(spark, d, "aoi"))


def p1_neighbours(spark: SparkSession, d: str) -> DataFrame:
    """Each site with a position: how many other sites are within 250 m, and how many areas hold it."""
    p = positions(table(spark, d, "sites"))
    near = near_pairs(p, 250.0)
    ends = near.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count("*").alias("n_near"))
    inside = containing_regions(p, table(spark, d, "aoi")).groupBy("id").agg(F.count("*").alias("n_inside"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return p.join(ends, "id", "left").join(inside, "id", "left").select("id", zero("n_near"), zero("n_inside"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return rejected_lines(table(spark, d, "raw_line"))


def p2_loaded(spark: SparkSession, d: str) -> DataFrame:
    """The good lines as observations."""
    o = loaded_lines(table(spark, d, "raw_line"))
    return o.select("line_id", "station_id", F.unix_micros("time").alias("time_us"), "latitude", "longitude", "value")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return implausible_readings(table(spark, d, "obs")).select("obs_id").distinct()


def p3_by_station(spark: SparkSession, d: str) -> DataFrame:
    """Faulty readings per station and kind."""
    f = implausible_readings(table(spark, d, "obs"))
    return f.groupBy("station_id").agg(*(F.sum(F.col(c).cast("long")).alias(f"n_{c}") for c in ("spike", "stuck", "impossible")))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return hours_without_reading(table(spark, d, "obs"))


def p4_hourly(spark: SparkSession, d: str) -> DataFrame:
    """The hourly series: readings, coverage and time-weighted mean of every hour of every station."""
    g = regular_grid(table(spark, d, "obs"))
    return g.select("station_id", F.col("cell_s").cast("long").alias("hour_s"), "n", F.round(F.col("mean") + 1e-9, 6).alias("mean"), F.round("coverage", 6).alias("coverage"), "status")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return unambiguous_instants(table(spark, d, "logger_row"), table(spark, d, "feed"))


def p5_formats(spark: SparkSession, d: str) -> DataFrame:
    """Rows by format and number of readings."""
    n = normalise_stamps(table(spark, d, "logger_row"), table(spark, d, "feed"))
    return n.groupBy(F.coalesce("format", F.lit("none")).alias("format"), "readings").agg(F.count("*").alias("n"))


P1_SITES = """
s AS (SELECT id, min(struct_pack(lat := lat, lon := CASE WHEN lon >= 180 THEN lon - 360 ELSE lon END)) AS p FROM sites
      WHERE id IS NOT NULL AND lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 360 GROUP BY id),
c AS (SELECT id, p.lat AS lat, p.lon AS lon, floor((p.lat + 90) / 0.005)::INT AS band FROM s),
near AS (SELECT x.id AS a, y.id AS b FROM c x JOIN (SELECT *, unnest([band - 1, band, band + 1]) AS of FROM c) y ON x.band = y.of AND x.id < y.id
         WHERE 12742000 * asin(sqrt(least(1, pow(sin(radians(y.lat - x.lat) / 2), 2) + cos(radians(x.lat)) * cos(radians(y.lat)) * pow(sin(radians(y.lon - x.lon) / 2), 2)))) <= 250),
rings AS (SELECT aoi, unnest(regexp_extract_all(wkt, '\\(([^()]+)\\)', 1)) AS r FROM aoi),
pts AS (SELECT aoi, row_number() OVER () AS ring, list_transform(string_split(r, ','), lambda q: list_transform(string_split(trim(q), ' '), lambda v: v::DOUBLE)) AS q FROM rings),
seg AS (SELECT aoi, q[i] AS u, q[i + 1] AS v FROM (SELECT aoi, q, unnest(generate_series(1, len(q) - 1)) AS i FROM pts)),
turn AS (SELECT c.id, c.lat, c.lon + 360 * k AS lon FROM c, unnest([-1, 0, 1]) AS t(k)),
cross_ AS (SELECT turn.id, aoi, lon FROM turn JOIN (SELECT seg.*, a2.west, a2.east, a2.south, a2.north FROM seg JOIN aoi a2 USING (aoi)) e
           ON turn.lon BETWEEN west - 0.001 AND east + 0.001 AND turn.lat BETWEEN south - 0.001 AND north + 0.001
           WHERE (u[2] > lat) <> (v[2] > lat) AND lon < (v[1] - u[1]) * (lat - u[2]) / (v[2] - u[2]) + u[1]),
inside AS (SELECT DISTINCT id AS a, aoi AS b FROM (SELECT id, aoi, lon, count(*) AS n FROM cross_ GROUP BY 1, 2, 3) WHERE n % 2 = 1)
"""

NUMBER_SQL = "[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?"
P2_LINES = f"""
l AS (SELECT line_id, regexp_replace(coalesce(line, ''), '\\r$', '') AS s FROM raw_line),
q AS (SELECT line_id, s, regexp_full_match(s, '([^",]*|"([^"]|"")*")(,([^",]*|"([^"]|"")*"))*', 's') AS quoted,
        regexp_extract_all(',' || s, ',("(?:[^"]|"")*"|[^",]*)', 1, 's') AS f FROM l),
c AS (SELECT line_id, quoted, len(f) = 8 AND s <> '' AS eight,
        list_transform(f, lambda x: regexp_replace(CASE WHEN x[1] = '"' THEN replace(x[2:-2], '""', '"') ELSE x END, '^[ \\t]+|[ \\t]+$', '', 'g')) AS f FROM q),
k AS (SELECT *, regexp_full_match(f[2], '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}[T ][0-9]{{2}}:[0-9]{{2}}(:[0-9]{{2}}(\\.[0-9]{{1,9}})?)?(Z|[+-][0-9]{{2}}:?[0-9]{{2}})?') AS shape,
        regexp_extract(f[2], '([+-])([0-9]{{2}}):?([0-9]{{2}})$', ['sg', 'h', 'm']) AS o,
        regexp_full_match(f[3], '{NUMBER_SQL}') AS lat, regexp_full_match(f[5], '{NUMBER_SQL}') AS val, regexp_full_match(f[4], '{NUMBER_SQL}') AS lon FROM c),
t AS (SELECT *, CASE WHEN shape AND length(f[2]) > 16 AND o.sg <> '' AND regexp_matches(f[2], ':[0-9]{{2}}.*[+-][0-9]{{2}}:?[0-9]{{2}}$')
          THEN try_cast(o.h AS INT) * 60 + try_cast(o.m AS INT) ELSE 0 END AS off FROM k),
v AS (SELECT *, coalesce(shape AND try_cast(f[2][1:10] AS DATE) IS NOT NULL AND f[2][1:4] <> '0000' AND try_cast(f[2][12:13] AS INT) <= 23 AND try_cast(f[2][15:16] AS INT) <= 59
            AND CASE WHEN f[2][17:17] = ':' THEN try_cast(f[2][18:19] AS INT) <= 59 ELSE true END AND off <= 840, false) AS time_ok,
        coalesce(lat AND abs(try_cast(f[3] AS DOUBLE)) <= 90, false) AS lat_ok, coalesce(val AND isfinite(try_cast(f[5] AS DOUBLE)), false) AS val_ok FROM t)
"""
P2_FOUND = f"""WITH {P2_LINES}
SELECT line_id, 'quoting' AS reason FROM v WHERE NOT quoted
UNION ALL SELECT line_id, 'columns' FROM v WHERE quoted AND NOT eight
UNION ALL SELECT line_id, 'time' FROM v WHERE quoted AND eight AND NOT time_ok
UNION ALL SELECT line_id, 'latitude' FROM v WHERE quoted AND eight AND NOT lat_ok
UNION ALL SELECT line_id, 'value' FROM v WHERE quoted AND eight AND NOT val_ok"""
P2_LOADED = f"""WITH {P2_LINES}
SELECT line_id, f[1] AS station_id,
  (epoch_us(f[2][1:10]::TIMESTAMP) + f[2][12:13]::BIGINT * 3600000000 + f[2][15:16]::BIGINT * 60000000
   + CASE WHEN f[2][17:17] = ':' THEN f[2][18:19]::BIGINT * 1000000 ELSE 0 END
   + CASE WHEN f[2][20:20] = '.' THEN rpad(regexp_extract(f[2], '\\.([0-9]+)', 1), 6, '0')[1:6]::BIGINT ELSE 0 END
   - CASE WHEN off = 0 THEN 0 WHEN o.sg = '-' THEN -off ELSE off END::BIGINT * 60000000)::BIGINT AS time_us,
  f[3]::DOUBLE AS latitude, CASE WHEN lon THEN try_cast(f[4] AS DOUBLE) END AS longitude, f[5]::DOUBLE AS value
FROM v WHERE quoted AND eight AND time_ok AND lat_ok AND val_ok"""

P3_READINGS = """
r AS (SELECT DISTINCT station_id, epoch_us(time) AS t, obs_id, value AS v FROM obs
      WHERE station_id IS NOT NULL AND time IS NOT NULL AND obs_id IS NOT NULL AND isfinite(value)),
o AS (SELECT *, row_number() OVER w AS p, v - lag(v) OVER w AS d,
        [lag(v, 3) OVER w, lag(v, 2) OVER w, lag(v, 1) OVER w] AS b,
        [[v], [v, lead(v, 1) OVER w], [v, lead(v, 1) OVER w, lead(v, 2) OVER w]] AS x,
        [[lead(v, 1) OVER w, lead(v, 2) OVER w, lead(v, 3) OVER w], [lead(v, 2) OVER w, lead(v, 3) OVER w, lead(v, 4) OVER w],
         [lead(v, 3) OVER w, lead(v, 4) OVER w, lead(v, 5) OVER w]] AS a,
        count(*) OVER (PARTITION BY station_id) AS n
      FROM r WINDOW w AS (PARTITION BY station_id ORDER BY t, obs_id)),
step AS (SELECT station_id, greatest(coalesce(median(abs(d)), 0), 0.001) AS step FROM o GROUP BY 1),
win AS (SELECT o.station_id, p, k, list_sort(b)[2] AS b, list_sort(a[k])[2] AS a, list_min(x[k]) AS lo, list_max(x[k]) AS hi
        FROM o, unnest([1, 2, 3]) AS u(k) WHERE p > 3 AND p + k + 2 <= n),
hit AS (SELECT win.station_id, p, k FROM win JOIN step USING (station_id)
        WHERE (lo - greatest(a, b) - 10 * step > 1e-9 AND lo - greatest(a, b) - abs(a - b) > 1e-9)
           OR (least(a, b) - hi - 10 * step > 1e-9 AND least(a, b) - hi - abs(a - b) > 1e-9)),
spike AS (SELECT DISTINCT hit.station_id, hit.p + j AS p FROM hit, unnest([0, 1, 2]) AS u(j) WHERE j < k),
run AS (SELECT *, sum((d IS NULL OR d <> 0)::INT) OVER (PARTITION BY station_id ORDER BY p) AS run FROM o),
len AS (SELECT station_id, run, count(*) AS c FROM run GROUP BY 1, 2),
ordinary AS (SELECT station_id, coalesce(max(c) FILTER (WHERE c < 15), 0) AS most FROM len GROUP BY 1),
flagged AS (
  SELECT run.station_id, run.obs_id, spike.p IS NOT NULL AS spike, len.c >= 15 AND len.c >= 3 * most AS stuck, v < -5 OR v > 45 AS impossible
  FROM run JOIN len USING (station_id, run) JOIN ordinary USING (station_id) LEFT JOIN spike ON spike.station_id = run.station_id AND spike.p = run.p)
"""

P4_READINGS = """
one AS (SELECT DISTINCT station_id, epoch_us(time) AS t, obs_id, value AS v FROM obs
        WHERE station_id IS NOT NULL AND time IS NOT NULL AND isfinite(value)),
inst AS (SELECT station_id, t, avg(v) AS v, count(*) AS n FROM one GROUP BY 1, 2),
iv AS (SELECT *, lead(t) OVER (PARTITION BY station_id ORDER BY t) AS until FROM inst),
span AS (SELECT station_id, min(t) // 3600000000 AS c0, max(t) // 3600000000 AS c1 FROM inst GROUP BY 1),
cells AS (SELECT station_id, unnest(generate_series(c0, c1)) AS c FROM span),
part AS (SELECT cells.station_id, c, iv.t, iv.v, iv.n, iv.t // 3600000000 = c AS starts,
           CASE WHEN iv.t IS NULL THEN 0 ELSE greatest(0, least(coalesce(until, (iv.t // 3600000000 + 1) * 3600000000), iv.t + 3600000000, (c + 1) * 3600000000) - greatest(iv.t, c * 3600000000)) END::DOUBLE AS us
         FROM cells LEFT JOIN iv ON iv.station_id = cells.station_id AND iv.t < (c + 1) * 3600000000 AND iv.t + 3600000000 > c * 3600000000),
hourly AS (SELECT station_id, c * 3600 AS hour_s, coalesce(sum(n) FILTER (WHERE starts), 0)::BIGINT AS n, coalesce(sum(us), 0) AS us,
             sum(us * v) AS vus, avg(v) FILTER (WHERE starts) AS plain FROM part GROUP BY 1, 2)
"""

QUERIES = {"p1_found": p1_found, "p1_neighbours": p1_neighbours, "p2_found": p2_found, "p2_loaded": p2_loaded, "p3_found": p3_found, "p3_by_station": p3_by_station, "p4_found": p4_found, "p4_hourly": p4_hourly, "p5_found": p5_found, "p5_formats": p5_formats}
SQL = {
    "p1_found": f"WITH {P1_SITES} SELECT 'near' AS relation, a, b FROM near UNION ALL SELECT 'inside', a, b FROM inside",
    "p1_neighbours": f"""WITH {P1_SITES}, n AS (SELECT unnest([a, b]) AS id FROM near) SELECT c.id, (SELECT count(*) FROM n WHERE n.id = c.id) AS n_near,
        (SELECT count(*) FROM inside i WHERE i.a = c.id) AS n_inside FROM c""",
    "p2_found": P2_FOUND,
    "p2_loaded": P2_LOADED,
    "p3_found": f"WITH {P3_READINGS} SELECT DISTINCT obs_id FROM flagged WHERE spike OR stuck OR impossible",
    "p3_by_station": f"WITH {P3_READINGS} SELECT station_id, sum(spike::INT)::BIGINT AS n_spike, sum(stuck::INT)::BIGINT AS n_stuck, sum(impossible::INT)::BIGINT AS n_impossible FROM flagged WHERE spike OR stuck OR impossible GROUP BY 1",
    "p4_found": f"WITH {P4_READINGS} SELECT station_id, hour_s FROM hourly WHERE n = 0",
    "p4_hourly": f"""WITH {P4_READINGS} SELECT station_id, hour_s, n, round(CASE WHEN us > 0 THEN vus / us ELSE plain END + 1e-9, 6) AS mean,
        round(us / 3600000000.0, 6) AS coverage, CASE WHEN n > 0 THEN 'read' WHEN us > 0 THEN 'held' ELSE 'missing' END AS status FROM hourly""",
}
