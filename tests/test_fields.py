"""What channels were made from, and run reports."""

import pytest

from skerry.plans.fields import inputs_of, is_derived, merge_reports, with_inputs

CASES = {
    "eco_sst_v002": ["ecostress"], "eco_sst": ["ecostress"], "lst_valid": ["landsat"], "modis_hour_terra": ["modis"], "modisref_footprint_id": ["modis_ref"], "eco_sst_clean_cloudfiltered": ["ecostress"],
    "eco_insitu_dt_min": ["insitu", "ecostress"], "eco_airtemp_hrrr": ["met_overpass", "ecostress"], "lst_tide_eo_tides": ["tides", "landsat"], "eco_water_class": ["bathymetry", "tides", "ecostress"],
    "eco_scene_cloud_pct_hrrr": ["met_overpass", "ecostress"], "eco_georef_dy": ["ecostress", "landcover"], "eco_sst_v002_georef_corrected_clean": ["ecostress", "landcover"], "airtemp_hrrr": ["met"], "wind_speed_era5": ["met"],
    "tide_range_eo_tides": ["tides"], "tide_coops": ["tides"], "elevation_cudem": ["bathymetry"], "depth_p25_gmrt": ["bathymetry"], "mur_sst": ["mur"], "mur_sst_gapfilled": ["mur"], "cmems_thetao_0m_my_global": ["cmems"],
    "landcover_water": ["landcover"], "insitu_station": ["insitu"], "doy_sin": [], "something": None, "ecosst": None,
}


@pytest.mark.parametrize("name", CASES)
def test_inputs(name):
    assert inputs_of(name) == CASES[name]


def test_inputs_as_expressions(spark):
    df = with_inputs(spark.createDataFrame([(c,) for c in CASES], "field string"))
    assert {r["field"]: r["inputs"] for r in df.collect()} == CASES


def test_derived():
    assert [c for c in CASES if is_derived(c)] == ["eco_sst_clean_cloudfiltered", "eco_water_class", "eco_scene_cloud_pct_hrrr", "eco_georef_dy", "eco_sst_v002_georef_corrected_clean", "mur_sst_gapfilled"]


def test_reports_of_one_product_are_one(spark):
    rows = [("insitu", 1, 3, 1, 2, 5, {"ioos": 3}, ["a: x", "b: y"], 0, "first", 1.5), ("insitu", 2, 2, 0, 1, None, {"csv": 1, "ioos": 1}, ["c: z"], 4, "", 0.5), ("mur", 1, 1, 0, 0, None, None, None, None, None, 2.0)]
    df = spark.createDataFrame(rows, "product string, part int, written long, skipped long, failed long, expected long, sources map<string,bigint>, failures array<string>, dropped long, note string, elapsed_s double")
    got = {r["product"]: r.asDict() for r in merge_reports(df, most=2).collect()}
    assert got["insitu"] == {"product": "insitu", "written": 5, "skipped": 1, "failed": 3, "expected": 5, "sources": {"csv": 1, "ioos": 4}, "failures": ["a: x", "b: y"], "dropped": 5, "note": "first", "elapsed_s": 2.0, "ok": False}
    assert (got["mur"]["ok"], got["mur"]["expected"], got["mur"]["failures"], got["mur"]["dropped"]) == (True, None, [], 0)
