"""A project from its input tables to the cube, the derived channels and the extracted table.

Inputs are long tables keyed by area; each stage is one lazy plan that is written once. Tables (those not given are passed over):
``scenes(area, sensor, version, day, granule, ts, row, col, sst, water, cloud, quality, file_valid[, footprint_id])``,
``daily(area, source, day, row, col, value)``, ``static(area, row, col, water)``,
``bathymetry(area, source, row, col, elevation[, depth, depth_p25, depth_p75])``, ``datum(area, source, datum_offset_m, status, method)``,
``series(area, source, ts, value)``, ``met(area, source, variant, day, row, col, <variables>)``,
``snapshots(area, source, ts, row, col, var, value)``, ``ocean(area, source, var, level, day, row, col, value)``,
``stations(area, station_id, lat, lon)``, ``readings(station_id, time, value[, z, qc, lat, lon])``, ``points(point_id, lat, lon)``.
Stations and points may have ``x, y`` in metres of the area's projection in place of positions.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skerry.functions import geo, times
from skerry.functions.geo import Grid
from skerry.functions.values import flag
from skerry.operators import acquire, cube, filters, match, neighbourhood, rasters, reduce, scenes
from skerry.plans.config import CORRECTED, Area, Project, step_order
from skerry.plans.fields import inputs_of
from skerry.sources.files import read_points
from skerry.sources.store import attributes_of, is_complete, stamp, write_table

CELL = ["day", "row", "col"]
#: Met fields of the cube, the order in which met sources are preferred, and the name of each filter's flag.
MET = ("airtemp", "wind_u", "wind_v", "wind_speed", "swrad", "cloud_cover")
PREFERRED = ("hrrr", "era5")
FLAGS = {"filter_clouds": "cloudfiltered", "filter_cloud_cover": "metcloudfiltered", "filter_land_clouds": "landcloudfiltered"}
MOVED = "_georef_corrected"
#: What cells vacated by a correction get.
VACATED: dict[str, Any] = {"sst": None, "valid": False, "cloud": 0, "footprint_id": -1}


def epsg_and_grid(project: Project, area: Area) -> tuple[int, Grid]:
    """The area's projection and grid: its box in its UTM zone, edges on multiples of the cell size."""
    crs = project.target_crs.strip().lower()
    epsg = (32600 if area.lat >= 0 else 32700) + int((area.lon + 180) // 6) + 1 if crs == "auto" else int(crs.removeprefix("epsg:"))
    return geo.area_grid(area.lat, area.bbox(), project.resolution_m, epsg=epsg, snap=project.snap_origin)


def grid_of(project: Project, area: Area) -> Grid:
    return epsg_and_grid(project, area)[1]


def projected(df: DataFrame, epsg: int) -> DataFrame:
    """``df`` with ``x, y`` in the projection, from ``lat, lon`` where it has these."""
    if not {"lat", "lon"} <= set(df.columns):
        return df
    x, y = geo.utm_forward(F.col("lat"), F.col("lon"), F.lit(epsg % 100), F.lit(epsg // 100 == 327))
    return df.withColumns({"x": x, "y": y})


class Inputs:
    """The input tables of one area; a table that isn't given is None."""

    def __init__(self, spark: SparkSession, project: Project, area: Area) -> None:
        self.spark, self.project, self.area = spark, project, area

    def __getitem__(self, name: str) -> DataFrame | None:
        path = self.project.inputs.get(name)
        if path is None:
            return None
        if name == "points" and path.endswith(".csv"):
            return read_points(self.spark, path, self.project.points_columns)
        df = self.spark.read.parquet(path)
        df = df.where(F.col("area") == self.area.name).drop("area") if "area" in df.columns else df
        if "day" in df.columns:
            df = df.withColumn("day", F.col("day").cast("date")).where(F.col("day").between(F.lit(self.project.start).cast("date"), F.lit(self.project.end).cast("date")))
        return df

    def tags(self, name: str, product: str, column: str = "source") -> list[str]:
        """The sources of a table that stand beside each other: those of the settings that are there, else all that are."""
        df = self[name]
        if df is None or column not in df.columns:
            return []
        have = sorted(r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct().collect())  # a handful of tags
        wanted = self.project.product(product, self.area.name).get("sources")
        return have if wanted is None else [s for s in wanted if s in have]


class Sensors:
    """The scenes of each sensor and version with their validity, and the instants of the scenes that the cube keeps."""

    def __init__(self, project: Project, tables: Inputs) -> None:
        self.scenes: dict[str, tuple[DataFrame, bool]] = {}
        self.of: dict[str, list[str]] = {}
        table = tables["scenes"]
        if table is None:
            return
        layers = {"version": "string", "water": "double", "cloud": "double", "quality": "int", "file_valid": "boolean"}
        table = table.withColumns({c: F.lit(None).cast(t) for c, t in layers.items() if c not in table.columns})
        there = {tuple(r) for r in table.select("sensor", "version").distinct().collect()}  # a few sensors and versions
        for sensor in project.sensors:
            rule = scenes.SensorRule(sensor.water_is_land, sensor.use_cloud, sensor.qc_levels, sensor.trust_valid)
            for version in sensor.versions or (None,):
                if not any(s == sensor.prefix and version in (None, v) for s, v in there):
                    continue  # not acquired: no channels
                own = table.where(F.col("sensor") == sensor.prefix)
                own = own if version is None else own.where(F.col("version") == version)
                name = "" if version is None else f"_{version}"
                self.scenes[f"{sensor.prefix}|{name}"] = scenes.with_validity(own, _polarity(own, tables, rule)), sensor.mosaic
                self.of.setdefault(sensor.prefix, []).append(name)

    def times(self, prefix: str) -> DataFrame:
        """``day, ts``: the instant of the scene kept on each day, of the first version that has one."""
        out = None
        for rank, name in enumerate(self.of[prefix]):
            g = scenes.granules(self.scenes[f"{prefix}|{name}"][0]).where("rank = 1").select("day", "ts", F.lit(rank).alias("o"))
            out = g if out is None else out.unionByName(g)
        return out.groupBy("day").agg(F.min_by("ts", "o").alias("ts"))


def _polarity(own: DataFrame, tables: Inputs, rule: scenes.SensorRule) -> scenes.SensorRule:
    """The rule with its reading of the water layer turned round where land cover clearly contradicts it."""
    land = tables["static"]
    if rule.trust_valid or land is None:
        return rule
    got = scenes.water_polarity(own, land).first()
    found = {"land-coded": True, "water-coded": False}.get(got["code"] if got else None)
    return rule if found is None or not got["binary"] else scenes.SensorRule(found, rule.use_cloud, rule.qc_levels, rule.trust_valid)


def contributors(project: Project, area: Area, tables: Inputs) -> list[cube.Contributor]:
    """The parts of the cube for which there are input tables."""
    parts: list[cube.Contributor] = []
    opts = lambda p: project.product(p, area.name)
    epsg, grid = epsg_and_grid(project, area)

    def part(name: str, keys: list[str], df: DataFrame, after: tuple[str, ...] = (), fills: dict[str, Any] | None = None) -> None:
        parts.append(cube.Contributor(name, lambda frames, df=df: df, tuple(keys), after, fills or {}))

    if tags := tables.tags("bathymetry", "bathymetry"):
        deep = reduce.with_depths(tables["bathymetry"])
        part("bathymetry", ["row", "col"], cube.by_source(deep, ["row", "col"], ["elevation", "depth", "depth_p25", "depth_p75"], tags))
    sensors = Sensors(project, tables)
    for prefix, names in sensors.of.items():
        for name in names:
            own, mosaic = sensors.scenes[f"{prefix}|{name}"]
            f = scenes.mosaic(own) if mosaic else scenes.clearest(own)
            fields = ["sst", "cloud", "valid", "hour"]
            if "footprint_id" in own.columns and not mosaic:
                f, fields = f.join(own.select(*CELL, "granule", "footprint_id"), [*CELL, "granule"], "left"), [*fields, "footprint_id"]
            part(f"{prefix}{name}", CELL, f.select(*CELL, *(F.col(c).alias(f"{prefix}_{c}{name}") for c in fields)))
    if tables["daily"] is not None:
        part("mur", CELL, tables["daily"].where("source = 'mur'").select(*CELL, F.col("value").alias("mur_sst")))
    if tags := tables.tags("met", "met"):
        met = tables["met"]
        if "variant" in met.columns:
            met = scenes.whole_window_variant(met, project.met_time)
        fields = [v for v in opts("met")["variables"] or MET if v in met.columns]
        part("met", CELL, cube.by_source(met, CELL, fields, tags))
    for sensor, source in opts("met_overpass")["combinations"] if tables["snapshots"] is not None else ():
        if sensor in sensors.of:
            snaps = tables["snapshots"].where(F.col("source") == source)
            names = opts("met_overpass")["variables"] or sorted(r[0] for r in snaps.select("var").distinct().collect())
            at = _snapshots(sensors.times(sensor), snaps, list(names), source)
            part(f"met_overpass:{sensor}:{source}", CELL, at.select(*CELL, *(F.col(f"{v}_{source}").alias(f"{sensor}_{v}_{source}") for v in names)), (sensor + sensors.of[sensor][0],))
    if tags := tables.tags("series", "tides"):
        tide = reduce.daily_mean_range(tables["series"], key="source", time="ts", value="value")
        part("tides", ["day"], cube.by_source(tide.select("day", "source", F.col("mean").alias("tide"), F.col("range").alias("tide_range")), ["day"], ["tide", "tide_range"], tags))
        for sensor, source in opts("tides")["overpass_combinations"]:
            if sensor in sensors.of:
                part(f"tide_overpass:{sensor}:{source}", ["day"], tide_at(tables, sensors.times(sensor).select("day", _minute(F.col("ts")).alias("ts")), source).select("day", F.col("tide").alias(f"{sensor}_tide_{source}")), (sensor + sensors.of[sensor][0],))
    if tags := tables.tags("ocean", "cmems"):
        o = opts("cmems")
        own = tables["ocean"].where(F.col("var").isin(*o["variables"])) if o["variables"] else tables["ocean"]
        own = own.where(F.col("level").isNull() | F.col("level").isin(*map(float, o["depths"]))) if o["depths"] else own
        found = own.select("var", "level").distinct().orderBy("var", "level").collect()  # a few variables and levels
        levels: dict[str, list[float | None]] = {}
        for r in found:
            levels.setdefault(r["var"], []).append(r["level"])
        for tag in tags if levels else ():
            wide = acquire.level_channels(own.where(F.col("source") == tag), levels)
            part(f"cmems:{tag}", CELL, wide.select(*CELL, *(F.col(c).alias(f"cmems_{c}_{tag}") for c in wide.columns if c not in CELL)))
    if tables["static"] is not None:
        part("landcover", ["row", "col"], tables["static"].select("row", "col", F.coalesce((F.col("water") > 0.5).cast("int"), F.lit(1)).alias("landcover_water")), fills={"landcover_water": 1})
    if project.insitu and tables["stations"] is not None and tables["readings"] is not None:
        parts += _insitu(project, area, tables, sensors, epsg, grid)
    return parts


def _minute(ts):
    """An instant without its seconds, as the hours of the cube have it."""
    return F.date_trunc("minute", ts)


def _snapshots(at: DataFrame, snaps: DataFrame, names: list[str], source: str) -> DataFrame:
    """Gridded snapshots at exactly the kept scenes' instants; a scene without one has no rows."""
    cells = snaps.join(at, "ts", "left_semi").select("ts", "row", "col").distinct()
    return acquire.at_scene_time(cells, snaps, variables=names, sources=[source]).join(at, "ts")


def tide_at(tables: Inputs, at: DataFrame, source: str) -> DataFrame:
    """``day, tide``: a source's series at each day's instant (``day, ts``), interpolated, missing outside the series."""
    q = at.select(F.lit(source).alias("source"), "ts", F.col("day").cast("string").alias("target"))
    v = match.value_between(q, tables["series"].where(F.col("source") == source), key="source", target_id="target", at="ts", time="ts", value="value")
    return v.select(F.col("target").cast("date").alias("day"), F.col("value").alias("tide"))


def _insitu(project: Project, area: Area, tables: Inputs, sensors: Sensors, epsg: int, grid: Grid) -> list[cube.Contributor]:
    """Station values in their cells: at the reference instant of each day and at each sensor's scene; how many stations a cell has,
    and the number (from 1, by id) of the first of them."""
    o, met = project.product("insitu", area.name), project.product("met", area.name)
    readings = tables["readings"]
    have = set(readings.columns)
    readings = reduce.select_readings(readings, start=project.start, end=project.end, max_depth=o["max_sensor_depth_m"] if "z" in have else None, qc_pass=o["qc_pass_values"] if "qc" in have else None, allow=list(o["stations"]) or None, deny=list(o["exclude_stations"]) or None)
    stations = projected(tables["stations"], epsg)
    if {"lat", "lon"} <= have:  # platforms that move have no cell
        moving = reduce.drift_m(readings, key="station_id", max_m=o["max_position_drift_m"]).where("moving")
        stations = stations.join(moving.select("station_id"), "station_id", "left_anti")
    at = match.station_cells(stations, grid)
    inside = at.where("inside")
    hours = times.clock_hours(met["reference_time"])
    day = F.col("day")
    west, _, east, _ = area.bbox()
    noon = reduce.calendar(inside.select("station_id"), project.start, project.end)
    lon = F.lit((west + east) / 2 if met["reference_basis"] == "solar" else 0.0)
    targets = noon.select("station_id", "day", F.lit("insitu").alias("target"), times.reference_instant(day, lon, hours).alias("at"))
    for prefix in sensors.of:
        seen = sensors.times(prefix).select("day", _minute(F.col("ts")).alias("at"))
        targets = targets.unionByName(noon.join(seen, "day").select("station_id", "day", F.lit(prefix).alias("target"), "at"))
    targets = targets.withColumn("id", F.concat_ws("/", "station_id", F.col("day").cast("string"), "target"))
    m = match.value_at(targets, readings, key="station_id", target_id="id", at="at", time="time", value="value", tolerance_s=int(project.insitu_max_dt_min * 60))
    m = targets.select("station_id", "day", "target", "id").join(m, "id")
    got = match.insitu_by_cell(m, at)
    own = lambda target, c: F.max(F.when(F.col("target") == target, F.col(c)))
    made = [own("insitu", "value").alias("insitu_sst"), own("insitu", "dt_min").alias("insitu_dt_min")]
    for prefix in sensors.of:
        made += [own(prefix, "value").alias(f"{prefix}_insitu_sst"), own(prefix, "dt_min").alias(f"{prefix}_insitu_dt_min")]
    wide = got.groupBy(*CELL).agg(*made)
    # stations of one area: numbered in the order of their ids by their place in the sorted list
    ids = filters.beside(inside, inside.agg(F.sort_array(F.collect_set("station_id")).alias("_ids")))
    cells = ids.groupBy("row", "col").agg(F.countDistinct("station_id").alias("insitu_n"), F.min(F.array_position("_ids", F.col("station_id"))).cast("int").alias("insitu_station"))
    return [cube.Contributor("insitu", lambda f: wide, tuple(CELL)), cube.Contributor("insitu_station", lambda f: cells, ("row", "col"), fills={"insitu_n": 0, "insitu_station": 0})]


def assemble(spark: SparkSession, project: Project, area: Area) -> DataFrame:
    """The area's cube: every day and cell of the window."""
    days = spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit(project.start)), F.to_date(F.lit(project.end)))).alias("day"))
    base = cube.cells(days, grid_of(project, area))
    sin, cos = times.season(F.col("day"))
    return cube.assemble(base, contributors(project, area, Inputs(spark, project, area))).withColumns({"doy_sin": sin, "doy_cos": cos})


def met_channel(columns: list[str], prefix: str, var: str, source: str = "auto") -> tuple[str, str] | None:
    """(channel, source) of a met variable for a sensor: that of its overpass before the daily one, sources in their preferred order,
    then the others by name; one source only if it is named."""
    tags = {c.removeprefix(f"{p}_"): 0 for p in (f"{prefix}_{var}", var) for c in columns if c.startswith(f"{p}_")}
    order = [source] if source not in (None, "auto") else [*PREFERRED, *sorted(set(tags) - set(PREFERRED))]
    return next(((c, s) for s in order for c in (f"{prefix}_{var}_{s}", f"{var}_{s}") if c in columns), None)


def passes(columns: list[str], prefix: str, corrected: bool) -> list[tuple[str, str, str]]:
    """(value, validity, cloud) channels that a filter works on: those of each version, or these on corrected geometry."""
    tail = MOVED if corrected else ""
    derived = ("_clean", MOVED, "_gapfilled", "_filled", "filtered")
    base = [c.removeprefix(f"{prefix}_sst") for c in columns if c.startswith(f"{prefix}_sst") and not c.endswith(derived)]
    found = [(f"{prefix}_sst{v}{tail}", f"{prefix}_valid{v}{tail}", f"{prefix}_cloud{v}{tail}") for v in base]
    return [x for x in found if x[0] in columns and x[1] in columns]


class Steps:
    """Derived channels by the selected steps, folded into one plan. Raw channels stay; filters compose on ``<value>_clean``;
    sensors whose channels the cube lacks are passed over."""

    def __init__(self, project: Project, area: Area, tables: Inputs, df: DataFrame) -> None:
        self.project, self.area, self.tables, self.df = project, area, tables, df
        self.grid = grid_of(project, area)

    def run(self) -> DataFrame:
        for name in step_order(list(self.project.steps)):
            base = CORRECTED.get(name, name)
            o = self.project.step(name, self.area.name)
            if base in FLAGS:
                for prefix in o["sensors"] or [s.prefix for s in self.project.sensors]:
                    getattr(self, base)(prefix, o, name in CORRECTED)
            else:
                getattr(self, name)(o)
        return self.df

    def _fold(self, channels: tuple[str, str, str], name: str, o: dict[str, Any], screen) -> None:
        """A filter's drop on the running result of one channel set; ``screen`` gets the frame and the running value."""
        value, valid, _ = channels
        clean = f"{value}_clean" if f"{value}_clean" in self.df.columns else value
        work = self.df.withColumns({"sst": F.col(value), "valid": F.col(valid)})
        for c, own in (("sst", value), ("valid", valid)):
            if f"{own}_clean" in self.df.columns:
                work = work.withColumn(f"{c}_clean", F.col(f"{own}_clean"))
        work, dropped = screen(work, F.col(clean))
        out = filters.fold_drop(work, dropped, "_flag", mask=o["mask_sst"])
        made = {f"{value}_clean": F.col("sst_clean"), f"{valid}_clean": F.col("valid_clean"), f"{value}_clean_{FLAGS[name]}": F.col("_flag")}
        self.df = out.withColumns(made).drop("sst", "valid", "sst_clean", "valid_clean", "_flag")

    def filter_clouds(self, prefix: str, o: dict[str, Any], corrected: bool) -> None:
        if o["method"] == "offset" and o["threshold_k"] <= 0 or o["baseline"] not in self.df.columns:
            return
        for channels in passes(self.df.columns, prefix, corrected):
            cloud = channels[2] if o["use_cloud_raster"] and channels[2] in self.df.columns else None
            clouded = flag(F.col(cloud) > 0) if cloud else F.lit(False)
            if o["method"] == "offset":
                base = f"{o['baseline']}_gapfilled" if f"{o['baseline']}_gapfilled" in self.df.columns else o["baseline"]
                self._fold(channels, "filter_clouds", o, lambda df, v, base=base: (df, flag(F.col(base) - v > o["threshold_k"]) | clouded))
                continue
            keys = ["row", "col"] if o["stat_scope"] == "pixel" else []
            # whether a season shows is a question to the whole window
            harmonic = o["seasonality"] == "harmonic" and bool(filters.season_shows(self.df.select("day")).first()[0])
            fit = filters.sigma_fit(self.df, keys=keys, value=o["baseline"], day="day", harmonic=harmonic)

            def screen(df: DataFrame, v, fit=fit, keys=keys, harmonic=harmonic):
                betas = [c for c in fit.columns if c in ("b0", "b1", "b2", "sigma")]
                one = fit.select(*keys, *(F.col(c).alias(f"_{c}") for c in betas))
                j = df.join(one, keys, "left") if keys else filters.beside(df, one)
                cut = filters.cutoff(o["n_sigma"], F.col("day"), harmonic, pre="_")
                return j.withColumn("_cut", cut).drop(*(f"_{c}" for c in betas)), flag(v < F.col("_cut")) | clouded

            self._fold(channels, "filter_clouds", o, screen)
            self.df = self.df.drop("_cut")

    def filter_cloud_cover(self, prefix: str, o: dict[str, Any], corrected: bool) -> None:
        found = met_channel(self.df.columns, prefix, "cloud_cover", o["source"])
        limits = [None if v is None or v >= 100 else v for v in (o["scene_max_pct"], o["pixel_max_pct"])]
        if found is None or limits == [None, None]:
            return
        pct, source = found
        mask = o["water_mask_channel"] if o["water_mask_channel"] in self.df.columns else None
        mean = filters.scene_cover(self.df, pct=pct, water=mask)
        name = f"{prefix}_scene_cloud_pct_{source}"
        self.df = self.df.drop(name).join(mean.withColumnRenamed("scene_cloud_pct", name), "day", "left")
        above = lambda c, limit: F.lit(False) if limit is None else flag(F.col(c) > limit)
        for channels in passes(self.df.columns, prefix, corrected):
            self._fold(channels, "filter_cloud_cover", o, lambda df, v: (df, above(name, limits[0]) | above(pct, limits[1])))

    def filter_land_clouds(self, prefix: str, o: dict[str, Any], corrected: bool) -> None:
        found = met_channel(self.df.columns, prefix, "airtemp", o["source"])
        mask = f"{prefix}_water_class" if o["land_source"] == "water_line" else o["mask_channel"]
        if found is None or mask not in self.df.columns or o["threshold_k"] <= 0:
            return
        land = F.col(mask) == 1 if o["land_source"] == "water_line" else F.coalesce(F.col(mask), F.lit(1)) < 0.5
        for channels in passes(self.df.columns, prefix, corrected):
            self._fold(channels, "filter_land_clouds", o, lambda df, v: (df, flag(land) & flag(F.col(found[0]) - v > o["threshold_k"])))

    def fill_water(self, o: dict[str, Any]) -> None:
        if o["mask_channel"] not in self.df.columns:
            return
        water = self.df.select("row", "col", F.col(o["mask_channel"]).alias("water")).distinct()
        named = {"mur": ["mur_sst"], "cmems": [c for c in self.df.columns if c.startswith("cmems_")]}
        wanted = [c for s in o["sources"] or named for c in named.get(s, [s])]  # products or channels
        for c in (c for c in wanted if c in self.df.columns):
            filled = rasters.fill_nearest(self.df.select(*CELL, c).where(F.col(c).isNotNull()), water, self.grid, keys=["day"], value=c)
            filled = filled.select(*CELL, F.col("value").alias(f"{c}_gapfilled"), F.col("filled").cast("int").alias(f"{c}_filled"))
            self.df = self.df.join(filled, CELL, "left")

    def water_line(self, o: dict[str, Any]) -> None:
        """Ground against the waterline at each sensor's overpass: the DEM's datum offset and the tide then are taken off."""
        dems = sorted(c.removeprefix("elevation_") for c in self.df.columns if c.startswith("elevation_"))
        tides = sorted(c.removeprefix("tide_") for c in self.df.columns if c.startswith("tide_") and not c.startswith("tide_range_"))
        dem, tide = o["dem_source"] or next(iter(dems), None), o["tide_source"] or next(iter(tides), None)
        if dem is None or f"elevation_{dem}" not in self.df.columns:
            return
        datum, offset = self.tables["datum"], self.project.product("bathymetry", self.area.name)["datum_offset_m"] or 0.0
        if datum is not None:  # one row a source
            row = datum.where(F.col("source") == dem).select("datum_offset_m").first()
            offset = row[0] if row and row[0] is not None else offset
        for prefix in o["sensors"] or [s.prefix for s in self.project.sensors]:
            hours = [c for c in self.df.columns if c == f"{prefix}_hour" or c.startswith(f"{prefix}_hour_")]
            if not hours:
                continue
            ready = f"{prefix}_tide_{tide}"
            if ready in self.df.columns:
                df = self.df.withColumn("_tide", F.col(ready))
            elif tide is not None and self.tables["series"] is not None:
                at = self.df.select("day", F.coalesce(*hours).alias("h")).where("h IS NOT NULL").groupBy("day").agg(F.min("h").alias("h"))
                at = at.select("day", F.timestamp_seconds(F.unix_timestamp(F.col("day").cast("timestamp")) + F.round(F.col("h") * 60).cast("long") * 60).alias("ts"))
                df = self.df.join(tide_at(self.tables, at, tide).withColumnRenamed("tide", "_tide"), "day", "left")
            else:
                df = self.df.withColumn("_tide", F.lit(None).cast("double"))
            self.df = filters.water_line(df, elevation=f"elevation_{dem}", tide="_tide", datum_offset_m=float(offset)).withColumnsRenamed({"water_elev": f"{prefix}_water_elev", "water_class": f"{prefix}_water_class"}).drop("_tide")

    def flag_georef(self, o: dict[str, Any]) -> None:
        """The check of each sensor's geometry, on the filtered values of its first version where a filter has run."""
        if "landcover_water" not in self.df.columns:
            return
        rule = rasters.GeorefRule(o["tol_m"], o["max_shift_m"], o["coarse_stride"], o["n_refine"], o["min_coast_obs"], o["min_valid_pct"], o["min_edges"], o["z_min"], o["lift_min"], o["gain_min"], o["ok_shift_m"], sigma=o["sigma"], low_pct=o["lo_pct"], high_pct=o["hi_pct"], windows_m=tuple(1000.0 * w for w in o["stability_windows_km"]))
        water = self.df.select("row", "col", F.col("landcover_water").alias("water")).distinct()
        for prefix in o["sensors"]:
            own = passes(self.df.columns, prefix, False)
            if not own:
                continue
            value = own[0][0]
            value = f"{value}_clean" if f"{value}_clean" in self.df.columns else value
            v = rasters.check_georeference(self.df.where(F.col(value).isNotNull()), water, self.grid, rule, keys=["day"], value=value)
            names = {"verdict": "flag"} | {c: c for c in ("dy", "dx", "shift_m", "z", "agree", "agree0", "n_edge", "coast_obs")} | {"contrast": "dt_k"}
            self.df = self.df.join(v.select("day", *(F.col(c).alias(f"{prefix}_georef_{n}") for c, n in names.items())), "day", "left")

    def correct_georef(self, o: dict[str, Any]) -> None:
        for prefix in o["sensors"]:
            if f"{prefix}_georef_flag" not in self.df.columns:
                continue
            v = self.df.select("day", F.col(f"{prefix}_georef_dy").alias("dy"), F.col(f"{prefix}_georef_dx").alias("dx"), F.col(f"{prefix}_georef_flag").alias("verdict")).distinct()
            versions = [x[0].removeprefix(f"{prefix}_sst") for x in passes(self.df.columns, prefix, False)]
            fills = {f"{prefix}_{f}{n}": VACATED.get(f, o["fill"]) for f in o["fields"] for n in versions if f"{prefix}_{f}{n}" in self.df.columns}
            self.df = rasters.correct_georeference(self.df, v, self.grid, keys=["day"], fills=fills).withColumnsRenamed({f"{c}_corrected": f"{c}{MOVED}" for c in fills})
            self.df = self.df.withColumn(f"{prefix}_georef_applied", flag(F.col(f"{prefix}_georef_flag") == "displaced").cast("int"))


def preprocess(project: Project, area: Area, df: DataFrame) -> DataFrame:
    """The cube with the derived channels of the selected steps."""
    return Steps(project, area, Inputs(df.sparkSession, project, area), df).run()


def extract(spark: SparkSession, project: Project, area: Area, df: DataFrame) -> DataFrame:
    """The long table ``point_id, area, day, variable, stat, radius_m, value``. Channels or masks that the cube lacks are all named."""
    missing = sorted({c for ch in project.channels for c in (ch.name, ch.mask) if c and c not in df.columns})
    if missing:
        raise ValueError(f"the cube has no {', '.join(missing)}")
    epsg, grid = epsg_and_grid(project, area)
    points = projected(Inputs(spark, project, area)["points"], epsg)
    out = None
    for ch in project.channels:
        mask = None if ch.mask is None else df.select("row", "col", F.col(ch.mask).alias("mask")).distinct()
        e = neighbourhood.extract(points, df.select(*CELL, F.col(ch.name).cast("double").alias("value")), grid, radius_m=ch.radius_m, stats=list(ch.stat), mask=mask)
        e = e.withColumns({"area": F.lit(area.name), "variable": F.lit(ch.name)})
        out = e if out is None else out.unionByName(e)
    return out.select("point_id", "area", "day", "variable", "stat", "radius_m", "value")


def provenance(spark: SparkSession, project: Project, area: Area) -> DataFrame:
    """``product, sources, rows, first_day, last_day``: what each input table holds for the area."""
    tables, out = Inputs(spark, project, area), None
    for name in project.inputs:
        df = tables[name]
        source = F.array_join(F.sort_array(F.collect_set("source" if "source" in df.columns else "sensor")), ",") if {"source", "sensor"} & set(df.columns) else F.lit("")
        when = next((F.to_date(c) for c in ("day", "ts", "time") if c in df.columns), F.lit(None).cast("date"))
        one = df.agg(F.lit(name).alias("product"), source.alias("sources"), F.count("*").alias("rows"), F.min(when).alias("first_day"), F.max(when).alias("last_day"))
        out = one if out is None else out.unionByName(one)
    return out


STAGES = ("cube", "derived", "points")


def run(spark: SparkSession, project: Project, *, areas: list[str] | None = None, overwrite: bool = False, stages: tuple[str, ...] = STAGES) -> dict[str, str]:
    """Cube, derived channels and extracted table of each area below the output folder; tables finished with the same settings are passed over. Returns what
    was done for each table. Areas run ``jobs`` at a time, so that Spark has work for all its cores; with ``block_days`` the cube and
    the derived channels are written in blocks of whole days (:func:`cube.day_blocks`) by the writer, not by the plan."""
    report: dict[str, str] = {}
    settings = project.fingerprint()

    def one(area: Area) -> None:
        at = {k: f"{project.output}/{area.name}/{k}" for k in STAGES}

        def step(name: str, make) -> DataFrame | None:
            key = f"{area.name}/{name}"
            done = is_complete(spark, at[name]) and attributes_of(spark, at[name]).get("settings") == settings
            if name not in stages:
                return spark.read.parquet(at[name]) if done else None
            if done and not overwrite:
                report[key] = "kept"
            else:
                df = make()
                if name != "points":
                    days = project.block_days or project.memory_budget_gb and cube.block_days(df, grid_of(project, area), int(project.memory_budget_gb * 2**30))
                    df = cube.day_blocks(df, project.start, days) if days else df
                elif project.points_format == "csv":
                    write_table(df, f"{at[name]}_csv", "csv")
                write_table(df, at[name])
                stamp(spark, at[name], {"settings": settings, "area": area.name, "start": project.start, "end": project.end, "inputs": {c: inputs_of(c) for c in df.columns if c not in CELL} if name != "points" else {}})
                report[key] = "written"
            return spark.read.parquet(at[name])

        df = step("cube", lambda: assemble(spark, project, area))
        if project.steps and df is not None:
            df = step("derived", lambda df=df: preprocess(project, area, df)) or df
        if project.channels and df is not None:
            step("points", lambda df=df: extract(spark, project, area, df))

    chosen = project.select(areas)
    if project.jobs == 1:
        for area in chosen:
            one(area)
    else:
        with ThreadPoolExecutor(project.jobs) as pool:
            for done in [pool.submit(one, a) for a in chosen]:
                done.result()
    return dict(sorted(report.items(), key=lambda kv: ([a.name for a in chosen].index(kv[0].split("/")[0]), STAGES.index(kv[0].split("/")[1]))))
