"""Regular grid and fault detection against plain loops."""

import random
from collections import defaultdict
from datetime import UTC, datetime, timedelta

import numpy as np
import pytest

from skerry.operators.faults import FaultRule, implausible_readings, median_step, outside_ellipsoids
from skerry.operators.regular import hours_without_reading, regular_grid, validity_intervals

SCHEMA = "obs_id long, station_id string, time timestamp, value double, qc int, k string, block int, n int"
T0 = datetime(2024, 3, 1, tzinfo=UTC)


def series(seed, stations=3, n=400, days=90):
    """Irregular readings with spikes, frozen stretches, resent rows, missing values and columns whose names clash."""
    rnd = random.Random(seed)
    out, i = [], 0
    for s in range(stations):
        t, v = T0, 10.0
        for j in range(n):
            t += timedelta(seconds=rnd.choice([0, 600, 600, 900, 7200, 3 * 86400 if rnd.random() < 0.02 else 600]))
            v = round(v + rnd.choice([-0.1, 0.0, 0.1, 0.2, -0.2]), 2)
            x = v
            if rnd.random() < 0.03:
                x = v + rnd.choice([8, -9, 60, -30])
            if j > 100 and j % 150 < rnd.choice([0, 0, 50]):
                x = 12.5
            if rnd.random() < 0.03:
                x = rnd.choice([None, float("nan"), float("inf")])
            i += 1
            row = (i, f"s{s}", t, x, 1, "a", 7, 3)
            out += [row] * (2 if rnd.random() < 0.05 else 1)
    out += [(None, "s0", T0, 1.0, 1, "", 1, 1), (9001, None, T0, 1.0, 1, "", 1, 1), (9002, "s0", None, 1.0, 1, "", 1, 1), (9003, "lonely", T0, 99.0, 1, "", 1, 1)]
    rnd.shuffle(out)
    return out


def clean(data):
    by = defaultdict(dict)
    for i, s, t, v, *_ in data:
        if i is not None and s is not None and t is not None and v is not None and np.isfinite(v):
            by[s][i] = (t, i, v)
    return {s: sorted(d.values()) for s, d in by.items()}


def brute_faults(data):
    spike, stuck, impossible = set(), set(), set()
    for x in clean(data).values():
        ids, v = [r[1] for r in x], [r[2] for r in x]
        n = len(v)
        impossible |= {i for i, y in zip(ids, v, strict=True) if y < -5 or y > 45}
        step = max(float(np.median(np.abs(np.diff(v)))) if n > 1 else 0.0, 0.001)
        for k in (1, 2, 3):
            for a in range(3, n - k - 2):
                b, c, w = sorted(v[a - 3 : a])[1], sorted(v[a + k : a + k + 3])[1], v[a : a + k]
                for out in (min(w) - max(b, c), min(b, c) - max(w)):
                    if out - 10 * step > 1e-9 and out - abs(b - c) > 1e-9:
                        spike |= set(ids[a : a + k])
        runs, s = [], 0
        for j in range(1, n + 1):
            if j == n or v[j] != v[s]:
                runs.append((s, j - s))
                s = j
        longest = max((r for _, r in runs if r < 15), default=0)
        for s, r in runs:
            if r >= 15 and r >= 3 * longest:
                stuck |= set(ids[s : s + r])
    return spike, stuck, impossible


@pytest.mark.parametrize("seed,block", [(1, 300), (2, 7), (3, 20_000), (4, 1)])
def test_faults_equal_the_exact_rule_however_blocked(spark, seed, block):
    data = series(seed)
    got = implausible_readings(spark.createDataFrame(data, SCHEMA), FaultRule(block_rows=block)).collect()
    assert len({r["obs_id"] for r in got}) == len(got)
    spike, stuck, impossible = brute_faults(data)
    assert {r["obs_id"] for r in got if r["spike"]} == spike
    assert {r["obs_id"] for r in got if r["stuck"]} == stuck
    assert {r["obs_id"] for r in got if r["impossible"]} == impossible
    assert spike and impossible


def test_a_frozen_run_over_many_blocks_is_one_run(spark):
    data = [(j, "a", T0 + timedelta(hours=20 * j), 5.0 if 30 <= j < 70 else 5.0 + (j % 7) / 10, 1, "", 1, 1) for j in range(100)]
    got = implausible_readings(spark.createDataFrame(data, SCHEMA), FaultRule(block_rows=2)).where("stuck").collect()
    assert {r["obs_id"] for r in got} == brute_faults(data)[1]
    assert len(got) >= 40


def test_no_reading_beyond_reach_is_inside_an_ellipsoid():
    rnd = np.random.default_rng(0)
    for _ in range(30):
        x = np.cumsum(rnd.normal(0, 0.1, 300))
        for _ in range(rnd.integers(1, 20)):
            a = rnd.integers(5, 290)
            x[a : a + rnd.integers(1, 4)] += rnd.choice([-1, 1]) * rnd.uniform(1.0, 30)
        limit = 10 * np.median(np.abs(np.diff(x)))
        flags = outside_ellipsoids(x, limit, 4)
        for k in (1, 2, 3):
            for a in range(3, 300 - k - 2):
                b, c, w = np.median(x[a - 3 : a]), np.median(x[a + k : a + k + 3]), x[a : a + k]
                if max(w.min() - max(b, c), min(b, c) - w.max()) > limit:
                    assert flags[a : a + k].all()


def spiky(rnd, n):
    x = np.round(np.cumsum(rnd.choice([-0.1, 0.0, 0.1, 0.2], n)) + 10, 2)
    for a in rnd.integers(0, n, 1 + n // 8):
        x[a : a + rnd.integers(1, 4)] += rnd.choice([8, -9, 30])
    return x.tolist()


def test_spikes_of_short_series_and_blocks(spark):
    rnd, data = np.random.default_rng(6), []

    def add(station, *blocks):
        for b, n in enumerate(blocks):
            data.extend([(len(data) + j, station, T0 + timedelta(days=30 * b, minutes=j), x, 1, "", 1, 1) for j, x in enumerate(spiky(rnd, n))])

    for k in range(20):
        for n in range(8, 21):
            add(f"whole {n} {k}", n)
        for n in range(1, 12):
            add(f"parts {n} {k}", n, 30, n, 30, n)
    spike = brute_faults(data)[0]
    df = spark.createDataFrame(data, SCHEMA)
    for rows in (20_000, 12, 5):
        assert {r["obs_id"] for r in implausible_readings(df, FaultRule(block_rows=rows)).where("spike").collect()} == spike
    by = {i: s.rsplit(" ", 1)[0] for i, s, *_ in data}
    assert {by[i] for i in spike} >= {f"whole {n}" for n in range(12, 18)}


def test_a_departure_of_exactly_ten_steps_is_no_spike(spark):
    """In decimal figures: doubles put some such departures a little above the limit."""
    data = []
    for k in range(300):
        level, step = (500 + 37 * k) / 100, (3 + k % 9) / 100
        line = [level + step * (j % 2) for j in range(12)]
        for j, more in ((5, 0.0), (6, 0.0), (7, 0.0)):
            line[j] = level
        line[6] = round(level + 10 * step, 2) if k % 2 else round(level + 10 * step + 0.01, 2)
        data.extend([(len(data) + j, f"s{k}", T0 + timedelta(hours=j), round(x, 2), 1, "", 1, 1) for j, x in enumerate(line)])
    got = {r["station_id"] for r in implausible_readings(spark.createDataFrame(data, SCHEMA)).where("spike").collect()}
    exact = set()
    for s, x in clean(data).items():
        v = [round(r[2] * 100) for r in x]
        step = float(np.median(np.abs(np.diff(v))))
        for k in (1, 2, 3):
            for a in range(3, len(v) - k - 2):
                b, c, w = sorted(v[a - 3 : a])[1], sorted(v[a + k : a + k + 3])[1], v[a : a + k]
                if any(o > 10 * step and abs(b - c) < o for o in (min(w) - max(b, c), min(b, c) - max(w))):
                    exact.add(s)
    assert got == exact and 0 < len(exact) < 300


def test_median_step_is_exact(spark):
    rnd = random.Random(5)
    data = [(k, round(rnd.expovariate(3), rnd.choice([0, 2, 6])), rnd.randint(1, 5)) for k in "abc" for _ in range(200)] + [("z", 0.0, 4), ("one", 2.5, 1)]
    got = {r["k"]: r["step"] for r in median_step(spark.createDataFrame(data, "k string, d double, n long"), 0.001).collect()}
    for k in got:
        flat = [d for kk, d, n in data for _ in range(n) if kk == k]
        assert got[k] == pytest.approx(max(float(np.median(flat)), 0.001), abs=1e-12)


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert implausible_readings(none).count() == 0
    assert regular_grid(none).count() == 0


@pytest.mark.parametrize("block", [1, 30])
def test_hours_and_weighted_means(spark, block):
    data = series(11, n=150)
    df = spark.createDataFrame(data, SCHEMA)
    hours = {(r["station_id"], r["hour_s"]) for r in hours_without_reading(df, block_days=block).collect()}
    want = set()
    for s, x in clean(data).items():
        have = {int(t.timestamp()) // 3600 for t, _, _ in x} | ({int(T0.timestamp()) // 3600} if s == "s0" else set())  # a reading without an id is one
        want |= {(s, h * 3600) for h in range(min(have), max(have)) if h not in have}
    assert hours == want
    grid = regular_grid(df, block_days=block).where("station_id = 's1'").collect()
    x = clean(data)["s1"]
    inst = defaultdict(list)
    for t, _, v in x:
        inst[t.timestamp()].append(v)
    pts = sorted((t, float(np.mean(v))) for t, v in inst.items())
    for r in grid:
        lo, hi = r["cell_s"], r["cell_s"] + 3600
        got = w = 0.0
        for j, (t, v) in enumerate(pts):
            end = min(pts[j + 1][0] if j + 1 < len(pts) else (t // 3600 + 1) * 3600, t + 3600)
            part = max(0.0, min(end, hi) - max(t, lo))
            got, w = got + part * v, w + part
        assert r["coverage"] == pytest.approx(w / 3600, abs=1e-9)
        if w:
            assert r["mean"] == pytest.approx(got / w, abs=1e-9)
        assert (r["status"] == "missing") == (w == 0 and r["n"] == 0)


def test_intervals_meet_end_to_end(spark):
    data = series(4, stations=1, n=80)
    iv = sorted((r["t"], r["until"]) for r in validity_intervals(spark.createDataFrame(data, SCHEMA), block_days=2).where("k = 's0'").collect())
    assert all(a[1] == b[0] for a, b in zip(iv, iv[1:], strict=False))
    assert iv[-1][1] is None
