"""Scalar functions, images and grids in closed form."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from skerry.functions import geo, images, times, values
from skerry.operators import cube, filters, match, neighbourhood, rasters, reduce, scenes
from skerry.sources import files


def one(spark, column):
    return spark.range(1).select(column.alias("v")).collect()[0]["v"]


def test_missing_rules(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", None), ("b", None), ("c", 4.0), ("c", 6.0)], "k string, v double")
    got = {r["k"]: r for r in df.groupBy("k").agg(*(values.statistic(s, F.col("v")).alias(s) for s in ("mean", "nanmean", "nansum", "sum", "count", "count_valid", "std", "p25", "nanstd"))).collect()}
    assert got["a"]["mean"] is None and got["a"]["nanmean"] == 1.5 and got["a"]["p25"] == 1.25 and got["a"]["nanstd"] == 0.5
    assert got["b"]["nansum"] == 0 and got["b"]["nanmean"] is None and got["b"]["count"] == 1 and got["b"]["count_valid"] == 0
    assert got["c"]["mean"] == 5 and got["c"]["std"] == 1 and got["c"]["sum"] == 10
    with pytest.raises(ValueError):
        values.statistic("p101", F.col("v"))
    nan = spark.createDataFrame([(float("nan"), 1), (None, 2), (3.0, 3)], "v double, i int")
    assert [r["v"] for r in values.null_nan(nan).orderBy("i").collect()] == [None, None, 3.0]


def test_times(spark):
    assert one(spark, times.solar_hour(F.lit("2024-01-01 01:00:00").cast("timestamp"), F.lit(-30.0))) == pytest.approx(23.0)
    assert [one(spark, times.in_window(F.lit(h), 19, 5)) for h in (19.0, 4.9, 5.0, 12.0)] == [True, True, False, False]
    at = lambda lon, h: str(one(spark, times.reference_instant(F.lit("2024-03-01").cast("date"), F.lit(lon), h)))
    assert at(0.0, 10.5) == "2024-03-01 10:00:00" and at(0.0, 11.5) == "2024-03-01 12:00:00" and at(170.0, 10.5) == "2024-02-29 23:00:00"
    assert times.clock_hours("10:30") == 10.5
    with pytest.raises(ValueError):
        times.clock_hours("25:00")
    assert one(spark, times.model_cycle(F.lit(23), 3)) == 21


def test_utm_known_point(spark):
    # a well-known landmark: 43.642567 N, 79.387139 W lies at 630084 E, 4833438 N in zone 17
    e, n = geo.utm_forward(F.lit(43.642567), F.lit(-79.387139), F.lit(17), F.lit(False))
    assert one(spark, e) == pytest.approx(630_084, abs=1) and one(spark, n) == pytest.approx(4_833_438.6, abs=1)
    assert one(spark, geo.utm_epsg(F.lit(-10.0), F.lit(180.0))) == 32761


def test_distance_transform_is_exact():
    rng = np.random.default_rng(3)
    for _ in range(20):
        m = rng.random((rng.integers(1, 25), rng.integers(1, 25))) < 0.1
        d, r, c = images.nearest_true(m)
        ys, xs = np.nonzero(m)
        for y in range(m.shape[0]):
            for x in range(m.shape[1]):
                if not ys.size:
                    assert np.isinf(d[y, x])
                    continue
                want = min(((y - a) ** 2 + (x - b) ** 2, a, b) for a, b in zip(ys, xs, strict=True))
                assert (d[y, x], r[y, x], c[y, x]) == want


def test_georeference_finds_a_known_shift(spark):
    h = 60
    yy, xx = np.mgrid[:h, :h]
    water = (yy - 30) ** 2 + (xx - 30) ** 2 < 400
    rng = np.random.default_rng(1)
    rule = rasters.GeorefRule(tol_m=100, max_shift_m=1000, min_coast=50, min_edges=30, z_min=2, lift_min=1.5, ok_shift_m=100, windows_m=(500.0, 1000.0))
    for dy, dx in ((0, 0), (3, -2), (-4, 1)):
        sst = images.shifted(np.where(water, 280.0, 290.0) + rng.normal(0, 0.01, (h, h)), -dy, -dx, 290.0)
        got = rasters.judge_scene(sst, water, 100.0, rule)
        assert (got["dy"], got["dx"]) == (dy, dx)
        assert got["verdict"] == ("ok" if (dy, dx) == (0, 0) else "displaced")
    assert rasters.judge_scene(np.full((h, h), np.nan), water, 100.0, rule)["verdict"] == "insufficient_signal"


def test_disc_edges_and_mask(spark, rows):
    g = geo.Grid(0.0, 1000.0, 100.0, 10, 10)
    p = spark.createDataFrame([("in", 450.0, 550.0), ("corner", 1.0, 999.0), ("out", -0.5, 500.0)], "point_id string, x double, y double")
    d = neighbourhood.disc_cells(p, g, 100.0).collect()
    assert sorted((r["row"], r["col"]) for r in d if r["point_id"] == "in") == [(3, 4), (4, 3), (4, 4), (4, 5), (5, 4)]
    assert {r["clipped"] for r in d if r["point_id"] == "corner"} == {True} and not [r for r in d if r["point_id"] == "out"]
    cells = spark.createDataFrame([(1, r, c, float(r) if r != 3 else None) for r in range(10) for c in range(10)], "day int, row int, col int, value double")
    mask = spark.createDataFrame([(r, c, int(c != 4)) for r in range(10) for c in range(10)], "row int, col int, mask int")
    e = {(r["point_id"], r["stat"]): r["value"] for r in neighbourhood.extract(p, cells, g, radius_m=100.0, stats=["nearest", "mean", "nanmean", "count", "count_valid"], mask=mask).collect()}
    assert e["in", "nearest"] == 4.0 and e["in", "mean"] == 4.0 and e["in", "count"] == 2
    e = {(r["point_id"], r["stat"]): r["value"] for r in neighbourhood.extract(p, cells, g, radius_m=100.0, stats=["mean", "nanmean", "count", "count_valid"]).collect()}
    assert e["in", "mean"] is None and e["in", "nanmean"] == pytest.approx(4.25) and e["in", "count"] == 5 and e["in", "count_valid"] == 4


def test_mosaic_against_the_sequential_rule(spark):
    import random
    from datetime import datetime, timedelta

    for seed in range(6):
        rnd = random.Random(seed)
        data, want = [], {}
        for day in range(8):
            n, cells = rnd.randint(1, 5), 6
            order = [(datetime(2024, 1, 1) + timedelta(days=day, hours=rnd.randint(0, 2)), f"g{k}") for k in range(n)]
            px = {g: {c: (rnd.choice([None, float(rnd.randint(0, 99))]), rnd.choice([0, 1, None]), rnd.random() < 0.5) for c in range(cells)} for _, g in order}
            px = {g: {c: (v, cl, ok and v is not None) for c, (v, cl, ok) in x.items()} for g, x in px.items()}
            for t, g in order:
                data += [(day, g, t, 0, c, *px[g][c]) for c in range(cells)]
            count = {g: sum(px[g][c][2] for c in range(cells)) for _, g in order}
            top, records = -1, []
            for t, g in sorted(order):
                if count[g] > top:
                    top = count[g]
                    records.append(g)
            base = min(order, key=lambda x: (-count[x[1]], x))[1]
            for c in range(cells):
                ok = sorted((-count[g], t, g) for t, g in order if px[g][c][2])
                rec = sorted((-count[g], t, g) for t, g in order if px[g][c][0] is not None and g in records)
                rest = sorted((0, t, g) for t, g in order if px[g][c][0] is not None)
                g = (ok or rec or rest or [(0, 0, base)])[0][2]
                want[day, c] = (px[g][c][0], px[g][c][1] or 0, px[g][c][2])
        df = spark.createDataFrame(data, "day int, granule string, ts timestamp, row int, col int, sst double, cloud int, valid boolean")
        got = {(r["day"], r["col"]): (r["sst"], r["cloud"], r["valid"]) for r in scenes.mosaic(df).collect()}
        assert got == want


def test_brackets_over_blocks(spark, rows):
    s = spark.createDataFrame([("a", f"2024-01-{d:02d} 00:00:00", float(d)) for d in (1, 3, 20)] + [("a", "2024-01-10 00:00:00", None)], "k string, t string, v double").withColumn("t", F.col("t").cast("timestamp"))
    q = spark.createDataFrame([("q1", "a", "2024-01-02 00:00:00"), ("q2", "a", "2024-01-12 00:00:00"), ("q3", "a", "2023-12-31 00:00:00"), ("q4", "a", "2024-01-20 00:00:00"), ("q5", "b", "2024-01-02 00:00:00")], "id string, k string, t string").withColumn("t", F.col("t").cast("timestamp"))
    for block in (1, 3, 400):
        got = dict(rows(match.value_between(q, s, key="k", target_id="id", at="t", time="t", value="v", block_days=block), "id", "value"))
        assert got == {"q1": 2.0, "q2": pytest.approx(12.0), "q3": None, "q4": 20.0, "q5": None}


def test_brackets_in_one_long_block(spark):
    n = 150_000
    s = spark.range(n).select(F.lit("a").alias("k"), F.timestamp_seconds(10 * F.col("id")).alias("t"), F.when(F.col("id") % 7 > 0, F.col("id") % 1000).cast("double").alias("v"))
    q = spark.range(0, 10 * n, 37).select(F.col("id").cast("string").alias("id"), F.lit("a").alias("k"), F.timestamp_seconds("id").alias("t"))
    names = {"key": "k", "target_id": "id", "at": "t", "time": "t", "value": "v", "block_days": 400}
    frames = match.bracket(q, s, **names)._jdf.queryExecution().optimizedPlan().toString()
    assert "unboundedfollowing" not in frames  # such a frame takes the square of the block's rows
    got = {int(r["id"]): r["value"] for r in match.value_between(q, s, **names).toLocalIterator()}
    have = [i for i in range(n) if i % 7]
    want = np.interp(range(0, 10 * n, 37), [10 * i for i in have], [i % 1000 for i in have], left=np.nan, right=np.nan)
    assert len(got) == len(want)
    for t, v in zip(range(0, 10 * n, 37), want):
        assert got[t] is None if np.isnan(v) else got[t] == pytest.approx(v)


def test_pooled_fit_of_one_row(spark):
    df = spark.createDataFrame([("x", 1.0, "2024-01-01"), ("y", None, "2024-01-01")], "k string, v double, d string").withColumn("d", F.to_date("d"))
    assert filters.sigma_fit(df, keys=["k"], value="v", day="d").collect()[0]["b0"] is None
    r = filters.sigma_fit(df, keys=[], value="v", day="d").collect()[0]
    assert r["b0"] == 1.0 and r["sigma"] == 0.0


def test_order_of_parts():
    part = lambda n, *d: cube.Contributor(n, lambda f: None, (), tuple(d))
    assert [p.name for p in cube.in_order([part("a", "c"), part("b"), part("c")])] == ["b", "c", "a"]
    for bad in ([part("a", "b"), part("b", "a")], [part("a", "x")], [part("a"), part("a")]):
        with pytest.raises(ValueError):
            cube.in_order(bad)


def test_small_rules(spark, rows):
    assert [files.overview_level(10, m) for m in (5, 10, 19, 20, 45, 500)] == [None, None, 0, 0, 1, 3]
    d = spark.createDataFrame([("a", 0.1), ("a", 0.2), ("a", 0.3), ("a", 0.2), ("a", 99_999.0), ("b", 0.1)], "k string, v double")
    assert rows(reduce.datum_offset(d, key="k", value="v", least=4), "k", "offset_m", "status") == [("a", pytest.approx(0.2), "resolved"), ("b", None, "too few")]
    with pytest.raises(ValueError):
        cube.same_schema(d, d.withColumn("x", F.lit(1)))
    assert math.isclose(one(spark, geo.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0))), math.pi * 6371, rel_tol=1e-9)
