"""The command line from settings to tables, step by step."""

import json

import pytest

from skerry.__main__ import VERBS, main
from skerry.plans.config import SettingsError, parse
from skerry.plans.products import PRODUCTS, order


@pytest.fixture
def settings(spark, tmp_path):
    cells = [(r, c) for r in range(11) for c in range(12)]
    put = lambda name, rows, schema: spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / name))
    put("daily", [("bay", "mur", "2024-06-01", r, c, 284.0) for r, c in cells if r != 4], "area string, source string, day string, row int, col int, value double")
    put("static", [("bay", r, c, 1.0) for r, c in cells], "area string, row int, col int, water double")
    put("points", [("p", 50.0, 3.0)], "point_id string, lat double, lon double")
    data = {
        "areas": [{"name": "bay", "lat": 50.0, "lon": 3.0, "ns_km": 0.5, "ew_km": 0.5}],
        "start": "2024-06-01",
        "end": "2024-06-02",
        "inputs": {n: str(tmp_path / n) for n in ("daily", "static", "points")},
        "output": str(tmp_path / "out"),
        "steps": {"fill_water": {}},
        "channels": [{"name": "mur_sst_gapfilled"}],
        "products": {"mur": {"access": "download"}, "landcover": {}},
    }
    f = tmp_path / "s.json"
    f.write_text(json.dumps(data))
    return f, data


def test_each_verb(spark, settings, capsys, tmp_path):
    f, data = settings

    def said(*args, code=0):
        assert main([args[0], str(f), *args[1:]]) == code
        return capsys.readouterr().out

    assert set(VERBS) >= {"validate", "grids", "verify", "run", "assemble", "preprocess", "extract", "provenance", "check"}
    assert "mur.access" in said("validate")
    assert "products: mur, landcover" in said("order")
    assert "3 input tables can be read" in said("verify")
    assert "bay daily: 120 rows, mur, 2024-06-01 to 2024-06-01" in said("provenance")
    assert json.loads(said("assemble", "--dry-run")) == {"bay/cube": "to be written"}
    assert json.loads(said("assemble")) == {"bay/cube": "written"} and json.loads(said("assemble")) == {"bay/cube": "kept"}
    assert json.loads(said("preprocess")) == {"bay/derived": "written"} and json.loads(said("extract")) == {"bay/points": "written"}
    got = spark.read.parquet(f"{data['output']}/bay/points").orderBy("day").collect()
    assert [(r["point_id"], r["value"]) for r in got] == [("p", 284.0), ("p", None)]
    assert json.loads(said("run")) == {"bay/cube": "kept", "bay/derived": "kept", "bay/points": "kept"}
    spark.range(1).write.parquet(f"{data['output']}/bay/cube.staging-x")
    assert "cube.staging-x" in said("check", code=1)
    assert "deleted" in said("check", "--repair", "--yes")
    assert json.loads(said("check"))["bay"] == {"complete": ["cube", "derived", "points"], "bad": [], "scratch": []}
    f.write_text(json.dumps(data | {"end": "2024-06-03"}))  # other settings: the tables are not those
    assert json.loads(said("assemble")) == {"bay/cube": "written"}
    f.write_text(json.dumps(data | {"inputs": data["inputs"] | {"series": str(tmp_path / "static"), "met": str(tmp_path / "none")}}))
    told = said("verify", code=1)
    assert "series: no column source, ts, value" in told and "met: can't be read" in told


def test_products_and_their_order():
    assert len(PRODUCTS) == 12
    assert order(["tides", "mur", "landsat", "modis_ref"]) == ["landsat", "mur", "modis_ref", "tides"]
    p = parse({"areas": [{"name": "a", "lat": 1.0, "lon": 1.0, "ns_km": 1, "ew_km": 1}], "start": "2024-01-01", "end": "2024-01-01", "products": {"met": {"sources": ["era5"]}}, "regions": {"a": {"met": {"sources": ["hrrr"]}}}})
    assert p.product("met", "a")["sources"] == ["hrrr"] and p.product("met")["sources"] == ["era5"] and p.product("met")["reference_time"] == "10:30"


NESTED = """
name: example
output_dir: {out}
time: {{start_date: "2024-06-01", end_date: "2024-06-02"}}
auth: {{earthdata: netrc}}
runtime: {{jobs: 4, assemble_jobs: 2}}
grid: {{resolution_m: 100, target_crs: auto, resampling_continuous: bilinear}}
products:
  mur: {{access: opendap}}
  landcover:
  tides: {{sources: [coops]}}
datacube: {{chunks: {{time: 64}}, met_time: daily_mean, insitu: false, insitu_max_dt_min: 30, block_days: auto, memory_budget_gb: 0.001}}
preprocess:
  enabled: true
  steps:
    fill_water: {{sources: [mur, cmems]}}
    filter_clouds:
extract:
  points: {points}
  columns: {{point_id: site}}
  format: csv
  channels:
    mur_sst:
    mur_sst_gapfilled: {{radius_m: 150, stat: [nanmean, count_valid]}}
    landcover_water: max
regions:
  - name: somewhere
    sources:
      tides: {{sources: [eo_tides]}}
    areas:
      - {{name: bay, center_lat: 50.0, center_lon: 3.0, buffer_ns_km: 0.5, buffer_ew_km: 0.5}}
inputs: {{daily: {daily}, static: {static}}}
"""


def test_settings_in_nested_blocks(spark, settings, tmp_path):
    yaml = pytest.importorskip("yaml")
    from skerry.plans.project import run

    points = tmp_path / "sites.csv"
    points.write_text("site,latitude,longitude\np1,50.0,3.0\np2,10,10\n")
    text = NESTED.format(out=tmp_path / "nested", points=points, daily=tmp_path / "daily", static=tmp_path / "static")
    p = parse(yaml.safe_load(text))
    assert (p.start, p.end, p.jobs, p.met_time, p.insitu, p.insitu_max_dt_min, p.points_format) == ("2024-06-01", "2024-06-02", 2, "daily_mean", False, 30, "csv")
    assert p.areas[0].ew_km == 0.5 and p.product("tides", "bay")["sources"] == ["eo_tides"] and [(c.name, c.stat) for c in p.channels] == [("mur_sst", ("nearest",)), ("mur_sst_gapfilled", ("nanmean", "count_valid")), ("landcover_water", ("max",))]
    assert set(p.idle) == {"auth", "datacube.chunks", "grid.resampling_continuous", "mur.access"}
    run(spark, p)
    csv = spark.read.option("header", True).csv(f"{tmp_path}/nested/bay/points_csv").where("variable = 'mur_sst' AND day = '2024-06-01'").collect()
    assert [(r["point_id"], r["value"]) for r in csv] == [("p1", "284.0")]
    bad = text.replace("resolution_m: 100", "resolutoin_m: 100").replace("center_lat", "centre_lat")
    with pytest.raises(SettingsError) as e:
        parse(yaml.safe_load(bad))
    assert "did you mean 'resolution_m'" in str(e.value) and "did you mean 'center_lat'" in str(e.value)
    assert parse(yaml.safe_load(text.replace("enabled: true", "enabled: false"))).steps == {}
