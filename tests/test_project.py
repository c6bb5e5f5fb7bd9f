"""Settings, and a small project from its tables to the extracted values."""

import dataclasses
import json
from datetime import datetime

import numpy as np
import pytest

from skerry.__main__ import main
from skerry.functions import images
from skerry.plans import config
from skerry.plans.project import epsg_and_grid, run
from skerry.sources.store import attributes_of

SETTINGS = {
    "areas": [{"name": "bay", "lat": 50.0, "lon": 3.0, "ns_km": 0.5, "ew_km": 0.5}],
    "start": "2024-06-01",
    "end": "2024-06-03",
    "steps": {"filter_clouds": {"threshold_k": 5.0, "sensors": ["eco"]}, "filter_cloud_cover": {}, "filter_land_clouds": {}, "fill_water": {}, "water_line": {"sensors": ["eco"]}},
    "products": {"met_overpass": {"combinations": [["eco", "hrrr"]]}, "tides": {"overpass_combinations": [["eco", "coops"]]}},
    "channels": [{"name": "eco_sst"}, {"name": "eco_sst_clean", "radius_m": 150.0, "stat": ["nanmean", "count_valid"], "mask": "landcover_water"}],
}


def test_settings_report_every_fault():
    bad = SETTINGS | {"stepz": 1, "start": "2025", "steps": {"filter_cloud": {}, "fill_water": {"source": []}, "filter_clouds": {"method": "ofset"}, "correct_georef": {}}, "products": {"tide": {}, "met": {"source": ["hrrr"], "sources": []}, "met_overpass": {"combinations": [["ecco", "hrrr"], ["eco", "hrr"]]}}, "regions": {"bay": {"insitu": {"qc_pass_values": [1]}}}, "channels": [{"name": "x", "radius_m": 5}, {"name": "y", "stat": "meen"}]}
    with pytest.raises(config.SettingsError) as e:
        config.parse(bad)
    for part in ("did you mean 'steps'", "start and end", "did you mean 'filter_clouds'", "did you mean 'sources'", "radius is not used", "did you mean 'mean'", "did you mean 'offset'", "correct_georef needs flag_georef", "did you mean 'tides'", "did you mean 'sources'", "sources is empty", "did you mean 'eco'", "did you mean 'hrrr'", "can't differ by region"):
        assert part in str(e.value)
    with pytest.raises(config.SettingsError):
        config.parse(SETTINGS).select(["bey"])
    assert config.step_order(["correct_georef", "flag_georef", "fill_water"]) == ["fill_water", "flag_georef", "correct_georef"]
    p = config.parse(SETTINGS | {"overrides": {"bay": {"filter_clouds": {"threshold_k": 1.0}}}})
    assert p.step("filter_clouds", "bay")["threshold_k"] == 1.0 and p.step("filter_clouds", "other")["threshold_k"] == 5.0


def test_area_box_wraps():
    west, south, east, north = config.Area("x", 89.9, 179.99, 50, 50).bbox()
    assert north == 90.0 and -180 <= west < 180 and -180 <= east < 180 and south < 89.9


@pytest.fixture(scope="module")
def project(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("project")
    epsg, grid = epsg_and_grid(config.parse(SETTINGS), config.parse(SETTINGS).areas[0])
    assert (epsg, grid.height, grid.width) == (32631, 11, 12)
    cells = [(r, c) for r in range(11) for c in range(12)]
    place = lambda r, c: (grid.x0 + 100 * c + 50.0, grid.y0 - 100 * r - 50.0)

    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(str(at / name))

    scenes = []
    for day, granules in ((1, 1), (2, 2)):
        for g in range(granules):
            t = datetime(2024, 6, day, 10 + g, 30)
            scenes += [("bay", "eco", None, f"2024-06-0{day}", f"g{day}{g}", t, r, c, 280.0 + r if (c + g) % 2 else 270.0, 0.0 if c < 8 else 1.0, 0.0, 0, None) for r, c in cells]
    put("scenes", scenes, "area string, sensor string, version string, day string, granule string, ts timestamp, row int, col int, sst double, water double, cloud double, quality int, file_valid boolean")
    put("daily", [("bay", "mur", f"2024-06-0{d}", r, c, 284.0) for d in (1, 2) for r, c in cells if r != 4], "area string, source string, day string, row int, col int, value double")
    put("met", [("bay", src, v, f"2024-06-0{d}", r, c, (10.0 if d == 1 else 90.0) + more, 285.0 + more) for src, more in (("hrrr", 0.0), ("era5", 1.0)) for v in ("reference", "daily_mean") for d in (1, 2) for r, c in cells], "area string, source string, variant string, day string, row int, col int, cloud_cover double, airtemp double")
    put("snapshots", [("bay", "hrrr", datetime(2024, 6, 1, h, 30), r, c, "airtemp", 286.0 if h == 10 else 299.0) for h in (10, 9) for r, c in cells], "area string, source string, ts timestamp, row int, col int, var string, value double")
    put("static", [("bay", r, c, 1.0 if c < 8 else 0.0) for r, c in cells if c < 9], "area string, row int, col int, water double")
    put("bathymetry", [("bay", s, r, c, z) for s, z in (("cudem", 11.0), ("gmrt", -3.0)) for r, c in cells], "area string, source string, row int, col int, elevation double")
    put("datum", [("bay", "cudem", 1.25, "ok", "x")], "area string, source string, datum_offset_m double, status string, method string")
    put("series", [("bay", s, datetime(2024, 6, d, h), float(h) + more) for s, more in (("coops", 0.0), ("eo_tides", 100.0)) for d in (1, 2, 3) for h in range(24)], "area string, source string, ts timestamp, value double")
    put("ocean", [("bay", "my_global", "thetao", z, f"2024-06-0{d}", r, c, 284.0 - z) for z in (0.0, 2.5) for d in (1, 2) for r, c in cells], "area string, source string, var string, level double, day string, row int, col int, value double")
    put("stations", [("bay", "s1", *place(2, 2)), ("bay", "s2", *place(2, 2)), ("bay", "off", -5.0, 5.0)], "area string, station_id string, x double, y double")
    put("readings", [("s1", datetime(2024, 6, 1, 10, 20), 12.0), ("s2", datetime(2024, 6, 1, 9, 50), 14.0), ("s1", datetime(2024, 6, 2, 14), 9.0)], "station_id string, time timestamp, value double")
    put("points", [("bay", "p", *place(6, 3)), ("bay", "q", 5000.0, 5.0)], "area string, point_id string, x double, y double")
    return config.parse(SETTINGS | {"inputs": {n: str(at / n) for n in config.INPUTS}, "output": str(at / "out")})


def test_from_tables_to_values(spark, rows, project):
    assert run(spark, project) == {"bay/cube": "written", "bay/derived": "written", "bay/points": "written"}
    assert set(run(spark, project).values()) == {"kept"}
    stamped = attributes_of(spark, f"{project.output}/bay/derived")
    assert stamped["start"] == "2024-06-01" and stamped["inputs"]["eco_water_elev"] == ["bathymetry", "tides", "ecostress"]
    assert None not in stamped["inputs"].values()  # every channel is known to the rules
    c = spark.read.parquet(f"{project.output}/bay/cube")
    assert c.count() == 396 and c.where("eco_sst IS NOT NULL").count() == 264
    r = c.where("day = '2024-06-01' AND row = 2 AND col = 2").collect()[0]
    # at the scene (10:30) and at the reference time (10:30 solar, to the full hour: 10:00), sources beside each other
    assert (r["eco_insitu_sst"], r["eco_insitu_dt_min"]) == (13.0, pytest.approx(-25.0))
    assert (r["insitu_sst"], r["insitu_dt_min"], r["insitu_n"], r["insitu_station"]) == (13.0, pytest.approx(5.0), 2, 1)
    assert (r["tide_coops"], r["tide_range_coops"], r["tide_eo_tides"], r["eco_tide_coops"]) == (11.5, 23.0, 111.5, 10.5)
    assert (r["airtemp_hrrr"], r["airtemp_era5"], r["eco_airtemp_hrrr"]) == (285.0, 286.0, 286.0)
    assert (r["elevation_cudem"], r["depth_cudem"], r["depth_gmrt"], r["depth_p75_gmrt"]) == (11.0, 0.0, 3.0, 3.0)
    assert (r["cmems_thetao_0m_my_global"], r["cmems_thetao_2p5m_my_global"]) == (284.0, 281.5)
    two = c.where("day = '2024-06-02' AND row = 0 AND col = 0").collect()[0]
    assert two["eco_airtemp_hrrr"] is None and two["eco_hour"] == 10.5 and two["insitu_n"] == 0  # no snapshot at that scene, no station
    d = spark.read.parquet(f"{project.output}/bay/derived")
    assert d.count() == 396
    first = d.where("day = '2024-06-01' AND row = 6").orderBy("col").collect()
    assert [x["eco_sst_clean"] for x in first] == [None if x["col"] % 2 == 0 else 286.0 for x in first]
    assert {x["eco_scene_cloud_pct_hrrr"] for x in first} == {10.0}
    assert d.where("day = '2024-06-02' AND eco_sst_clean IS NOT NULL").count() == 0  # the whole scene is clouded
    assert d.where("day = '2024-06-02' AND eco_sst IS NOT NULL AND eco_sst_clean_metcloudfiltered = 1").count() == 132
    assert {x["mur_sst_gapfilled"] for x in d.where("day = '2024-06-01' AND row = 4 AND col < 8").collect()} == {284.0}
    # 11.0 less the datum offset and the tide at 10:30: below the waterline, though above it at the day's least tide
    assert {(x["eco_water_elev"], x["eco_water_class"]) for x in d.where("day = '2024-06-01'").collect()} == {(11.0 - 1.25 - 10.5, 0)}
    p = {(r["day"], r["variable"], r["stat"]): r["value"] for r in spark.read.parquet(f"{project.output}/bay/points").collect()}
    day = min(k[0] for k in p)
    assert p[day, "eco_sst", "nearest"] == 286.0 and p[day, "eco_sst_clean", "nanmean"] == 286.0 and p[day, "eco_sst_clean", "count_valid"] == 3


def test_sources_of_the_settings_and_other_steps(spark, project):
    p = dataclasses.replace(project, products=project.products | {"met": {"sources": ["era5"]}, "bathymetry": {"sources": ["gmrt"]}}, block_days=2, jobs=2, output=project.output + "2", steps={"water_line": {}, "filter_land_clouds": {"land_source": "water_line", "threshold_k": 0.5}, "filter_clouds": {"method": "sigma", "seasonality": "harmonic", "stat_scope": "pooled", "n_sigma": 1.0}})
    assert set(run(spark, p, stages=("cube", "derived")).values()) == {"written"}
    d = spark.read.parquet(f"{p.output}/bay/derived")
    assert "airtemp_hrrr" not in d.columns and "elevation_cudem" not in d.columns and "airtemp_era5" in d.columns
    assert len(set(d.select("day").distinct().collect())) == 3
    # ground at -3 is submerged at any tide: not land, so nothing is dropped there, while cold pixels fall to the fit
    assert d.where("eco_sst_clean_landcloudfiltered = 1").count() == 0
    assert d.where("eco_sst = 270.0 AND eco_sst_clean_cloudfiltered = 1").count() == d.where("eco_sst = 270.0").count() > 0


def test_georeferencing_steps(spark, tmp_path_factory):
    """A scene moved by (3, -2) is put back, the filters run again on it, and a registered one stays."""
    at = tmp_path_factory.mktemp("georef")
    settings = SETTINGS | {
        "areas": [{"name": "disk", "lat": 0.5, "lon": 3.0, "ns_km": 2.9, "ew_km": 2.9}],
        "products": {},
        "channels": [],
        "steps": {
            "flag_georef": {"min_edges": 10, "min_coast_obs": 5, "min_valid_pct": 0.0, "tol_m": 100.0, "max_shift_m": 1500.0, "stability_windows_km": [0.5, 1.0]},
            "correct_georef": {},
            "filter_clouds": {"threshold_k": 20.0},
            "filter_clouds_corrected": {"threshold_k": 5.0},
        },
    }
    grid = epsg_and_grid(config.parse(settings), config.parse(settings).areas[0])[1]
    h, w = grid.height, grid.width
    yy, xx = np.mgrid[0:h, 0:w]
    water = (yy - h // 2) ** 2 + (xx - w // 2) ** 2 < (min(h, w) // 2 - 4) ** 2
    sst = np.where(water, 280.0, 290.0) + np.random.default_rng(0).normal(0, 0.01, water.shape)
    moved = images.shifted(sst, 3, -2)
    cell = lambda a, d: [("disk", "eco", f"2024-06-0{d}", f"g{d}", datetime(2024, 6, d, 10), y, x, float(a[y, x]) if np.isfinite(a[y, x]) else None, 0.0, 0.0, 0) for y in range(h) for x in range(w)]
    spark.createDataFrame(cell(sst, 1) + cell(moved, 2), "area string, sensor string, day string, granule string, ts timestamp, row int, col int, sst double, water double, cloud double, quality int").write.parquet(str(at / "scenes"))
    spark.createDataFrame([("disk", y, x, float(water[y, x])) for y in range(h) for x in range(w)], "area string, row int, col int, water double").write.parquet(str(at / "static"))
    spark.createDataFrame([("disk", "mur", f"2024-06-0{d}", y, x, 290.0) for d in (1, 2) for y in range(h) for x in range(w)], "area string, source string, day string, row int, col int, value double").write.parquet(str(at / "daily"))
    p = config.parse(settings | {"inputs": {n: str(at / n) for n in ("scenes", "static", "daily")}, "output": str(at / "out")})
    run(spark, p)
    d = spark.read.parquet(f"{p.output}/disk/derived")
    got = {str(r["day"]): r for r in d.select("day", "eco_georef_flag", "eco_georef_dy", "eco_georef_dx", "eco_georef_applied").distinct().collect()}
    one, two = got["2024-06-01"], got["2024-06-02"]
    assert (one["eco_georef_flag"], two["eco_georef_flag"]) == ("ok", "displaced")
    assert (two["eco_georef_dy"] - one["eco_georef_dy"], two["eco_georef_dx"] - one["eco_georef_dx"]) == (-3, 2)
    assert (one["eco_georef_applied"], two["eco_georef_applied"]) == (0, 1)
    dy, dx = two["eco_georef_dy"], two["eco_georef_dx"]
    back = {(r["row"], r["col"]): (r["eco_sst_georef_corrected"], r["eco_sst_georef_corrected_clean"], r["eco_sst_clean"]) for r in d.where("day = '2024-06-02'").collect()}
    want = images.shifted(moved, dy, dx)
    for (y, x), (v, clean, _) in back.items():
        assert (v is None) == bool(np.isnan(want[y, x])) and (v is None or v == want[y, x])
        assert clean == (v if v is not None and v > 285 else None)  # the repeated filter has its own threshold
    assert sum(c is not None for _, _, c in back.values()) == int(np.isfinite(moved).sum())  # the first pass, at 20, drops nothing


def test_command_line(tmp_path, capsys):
    f = tmp_path / "s.json"
    f.write_text(json.dumps(SETTINGS))
    assert main(["validate", str(f)]) == 0 and main(["grids", str(f)]) == 0 and main(["order", str(f)]) == 0
    assert "11 x 12 cells of 100 m, EPSG:32631" in capsys.readouterr().out
    f.write_text(json.dumps(SETTINGS | {"areas": []}))
    assert main(["validate", str(f)]) == 2
