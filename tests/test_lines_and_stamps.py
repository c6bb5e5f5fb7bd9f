"""Loading lines and normalising stamps."""

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from skerry.functions import zones
from skerry.operators.stamps import NONE, StampRule, _cost, normalise_stamps, readings_of, unambiguous_instants
from skerry.sources.lines import loaded_lines, parse_observation_lines, rejected_lines

GOOD = "A-1,2024-05-01T10:00:00Z,10.5,20,1.5,2,1,name"


@pytest.mark.parametrize(
    "line,reasons",
    [
        (GOOD, []),
        (GOOD + "\r", []),
        ('"A","2024-05-01 10:00","1","2"," +1.5e1 ","","","say ""hi"", all"', []),
        ('A,2024-05-01 10:00,1,2,3,,,"open', ["quoting"]),
        ('A,2024-05-01 10:00,1,2,3,,,"in "the" middle"', ["quoting"]),
        ('A,2024-05-01 10:00,1,2,3,,, "late"', ["quoting"]),
        ('A,2024-05-01 10:00,1,2,3",,,x', ["quoting"]),
        ("", ["columns"]),
        (None, ["columns"]),
        ("a,b", ["columns"]),
        (",,,,,,,,", ["columns"]),
        (",,,,,,,", ["time", "latitude", "value"]),
        ("A,2024-02-30 10:00,91,2,nan,,,x", ["time", "latitude", "value"]),
        ("A,2024-05-01 24:00,1,2,1e999,,,x", ["time", "value"]),
        ("A,2024-05-01 10:00:00.1234567890,1,2,3,,,x", ["time"]),
        ("A,2024-05-01T10:00+14:00,1,2,3,,,x", []),
        ("A,2024-05-01T10:00+1401,1,2,3,,,x", ["time"]),
        ("A,2024-05-01T10:00.5,1,2,3,,,x", ["time"]),
        ("A,2024-05-01T10:00,1_0,2,0x1F,,,x", ["latitude", "value"]),
        ("A,2024-05-01T10:00,١,2,3 ,,,x", ["latitude", "value"]),
        ("A,\t2024-05-01T10:00 , -.5e1\t,2,5.,,,x", []),
        ("A,2024-05-01T10:00,.,2,-,,,x", ["latitude", "value"]),
        ("A\nB,2024-05-01T10:00,1,2,3,,,x\ry", []),
    ],
)
def test_reasons(spark, line, reasons):
    df = spark.createDataFrame([(7, line, "extra")], "line_id long, line string, reasons string")
    assert parse_observation_lines(df).collect()[0]["reasons"] == reasons


def test_typed_fields_and_ids_stay_together(spark, rows):
    lines = [(1, GOOD), (2, "bad"), (3, 'B,2024-05-01 00:30:15.1234567-01:30,-90,x,0,,3.5,"a,b"'), (None, "bad"), (2, "bad"), (4, "x" * 2_000_000)]
    df = spark.createDataFrame(lines, "line_id long, line string")
    got = rows(loaded_lines(df), "line_id", "station_id", "latitude", "longitude", "value", "z", "qc", "station_name")
    assert got == [(1, "A-1", 10.5, 20.0, 1.5, 2.0, 1, "name"), (3, "B", -90.0, None, 0.0, None, None, "a,b")]
    assert [r["time"].isoformat() for r in loaded_lines(df).orderBy("line_id").collect()] == ["2024-05-01T10:00:00", "2024-05-01T02:00:15.123456"]
    assert rows(rejected_lines(df)) == [(2, "columns"), (2, "columns"), (4, "columns"), (None, "columns")]
    assert rejected_lines(spark.createDataFrame([], "line_id long, line string")).count() == 0


def one(stamp, zone=None, order=None):
    code, us = readings_of(pa.array([stamp], pa.string()), np.array([zone or "UTC"], object), np.array([order or ""], object))
    return sorted(int(u) for u in us[0] if u != NONE)


S = 1_000_000


@pytest.mark.parametrize(
    "stamp,zone,order,want",
    [
        (" 1700000000\t", None, None, [1700000000 * S]),
        ("1700000000123", None, None, [1700000000123000]),
        ("170000000012", None, None, []),
        ("45292.5", "Asia/Tokyo", None, [1704078000 * S]),
        ("2024-060T00:00:00", None, None, [1709164800 * S]),
        ("2023-366T00:00:00", None, None, []),
        ("03/04/2024 1:05 PM", None, "DMY", [1712149500 * S]),
        ("03/04/2024 1:05 PM", None, "MDY", [1709557500 * S]),
        ("03/04/2024 1:05 PM", None, None, [1709557500 * S, 1712149500 * S]),
        ("03/04/2024 13:05 PM", None, "DMY", []),
        ("04/13/2024 10:00", None, "DMY", []),
        ("2024-03-10 02:30:00", "America/New_York", None, []),
        ("2024-11-03 01:30:00", "America/New_York", None, [1730611800 * S, 1730615400 * S]),
        ("2024-11-03 01:30:00 EST", "America/New_York", None, [1730615400 * S]),
        ("2024-11-03 01:30:00 EST", "Asia/Tokyo", None, []),
        ("2024-11-03T01:30:00.123456789-03:30", "Asia/Tokyo", None, [1730610000123456]),
        ("20240101T000000+0530", None, None, [1704047400 * S]),
        ("01-Feb-2024 00:00:00", None, None, [1706745600 * S]),
        ("Feb 1, 2024 12:00 AM", None, None, [1706745600 * S]),
        ("2024-05", None, None, []),
        ("2024-05-01 10:00:00", "Mars/Base", None, []),
        ("2024-05-01 10:00:00Z", "Mars/Base", None, [1714557600 * S]),
        ("10:30:00", None, None, []),
        ("", None, None, []),
        (None, None, None, []),
        ("2024-01-01 00:00:60", None, None, []),
    ],
)
def test_readings(stamp, zone, order, want):
    assert one(stamp, zone, order) == want


def test_zone_periods_agree_with_the_standard_library():
    from datetime import UTC, datetime
    from zoneinfo import ZoneInfo

    rnd = random.Random(1)
    for name in ("America/St_Johns", "Australia/Lord_Howe", "Pacific/Chatham", "Europe/London", "Asia/Kathmandu"):
        at = np.array([rnd.randrange(-1_000_000_000, 2_000_000_000) for _ in range(300)])
        want = [int(datetime.fromtimestamp(int(t), UTC).astimezone(ZoneInfo(name)).utcoffset().total_seconds()) for t in at]
        assert zones.offsets(name, at).tolist() == want


def test_viterbi_over_blocks_is_the_cheapest_path(spark):
    rnd = random.Random(3)
    stamps = []
    for i in range(60):
        d, m = rnd.randint(1, 12), rnd.randint(1, 12)
        stamps.append(f"{d:02d}/{m:02d}/2024 10:00" if rnd.random() < 0.8 else f"2024-{m:02d}-{d:02d} 10:00:00")
    data = [(i, "f", s) for i, s in enumerate(stamps)]
    rows = spark.createDataFrame(data + data[:5], "row_id long, feed_id string, time string")
    feeds = spark.createDataFrame([("f", None, None)], "feed_id string, time_zone string, date_order string")
    code, us = readings_of(pa.array(stamps), np.array(["UTC"] * 60, object), np.array([""] * 60, object))
    m = (us != NONE).sum(1)

    def total(rule, picks):
        return sum(_cost(rule, code[i, p : p + 1], us[i, p : p + 1], code[i + 1, q : q + 1], us[i + 1, q : q + 1])[0, 0] for i, (p, q) in enumerate(itertools.pairwise(picks)))

    cost, n = np.zeros(m[0]), StampRule()
    for i in range(59):
        cost = (cost[:, None] + _cost(n, code[i, : m[i]], us[i, : m[i]], code[i + 1, : m[i + 1]], us[i + 1, : m[i + 1]])).min(0)
    for block in (1, 7, 1000):
        rule = StampRule(block=block)
        got = normalise_stamps(rows, feeds, rule).orderBy("row_id").collect()
        assert [r["readings"] for r in got] == m.tolist()
        picks = [us[i, : m[i]].tolist().index(r["time_us"]) for i, r in enumerate(got)]
        assert total(rule, picks) == pytest.approx(cost.min())


def test_rows_of_any_kind(spark, rows):
    data = [(1, "f", "1700000000"), (1, "f", "1700000000"), (2, None, "2024-01-01 00:00:00"), (3, "unknown", "2024-01-01 00:00:00"), (4, "f", None), (None, "f", "1700000000"), (5, "f", "2024-03-31 02:30:00")]
    df = spark.createDataFrame([(*r, "x", 9) for r in data], "row_id long, feed_id string, time string, block string, k int")
    feeds = spark.createDataFrame([("f", "Europe/Oslo", "DMY"), (None, "Asia/Tokyo", None)], "feed_id string, time_zone string, date_order string")
    assert rows(unambiguous_instants(df, feeds)) == [(1, 1700000000 * S), (2, 1704067200 * S), (3, 1704067200 * S)]
    assert normalise_stamps(df, feeds).count() == 5
    assert unambiguous_instants(df.limit(0), feeds.limit(0)).count() == 0


def sequential(rule, code, us, m, first, last):
    """The Viterbi algorithm row by row."""
    from skerry.operators.stamps import _cost

    cost = np.where(np.arange(m[0]) == first, 0.0, np.inf)
    back = []
    for i in range(m.size - 1):
        step = cost[:, None] + _cost(rule, code[i, : m[i]], us[i, : m[i]], code[i + 1, : m[i + 1]], us[i + 1, : m[i + 1]])
        back.append(step.argmin(0))
        cost = step.min(0)
    pick = [last]
    for p in reversed(back):
        pick.append(int(p[pick[-1]]))
    return np.array(pick[::-1]), cost


@pytest.mark.parametrize("n,share", [(1, 1), (2, 1), (3, 0.5), (17, 1), (40, 0.3), (500, 1), (2000, 0.6), (2000, 0.02)])
def test_viterbi_in_blocks_is_that_of_row_by_row(n, share):
    from skerry.operators.stamps import StampRule, _decode, _transfer

    rnd, rule = np.random.default_rng(n), StampRule()
    for _ in range(5):
        m = np.where(rnd.random(n) < share, rnd.integers(1, 5, n), 1)
        code = rnd.integers(0, 3, (n, 4)).astype(np.int16)
        us = rnd.integers(0, 50, (n, 4)) + np.arange(n)[:, None]
        for a in range(m[0]):
            through = _transfer(rule, code, us, m)
            for b in range(m[-1]):
                if n == 1 and a != b:
                    continue
                want, cost = sequential(rule, code, us, m, a, b)
                assert (_decode(rule, code, us, m, a, b) == want).all()
                assert np.isclose(through[a] - through[a].min(), cost - cost.min()).all() or n == 1


def test_choices_among_several_readings(spark):
    """The hour that occurs twice is told by the record order, an unknown order of day and month by the rows beside it."""
    rows = {
        "zone": ["2024-10-27 01:50:00", "2024-10-27 02:10:00", "2024-10-27 02:40:00", "2024-10-27 02:10:00", "2024-10-27 02:40:00", "2024-10-27 03:10:00"],
        "order": ["11/04/2024 10:00", "12/04/2024 10:00", "13/04/2024 10:00", "14/04/2024 10:00", "01/05/2024 10:00"],
        "month first": ["04/28/2024 10:00", "05/01/2024 10:00", "05/02/2024 10:00"],
    }
    want = {
        "zone": ["2024-10-26T23:50", "2024-10-27T00:10", "2024-10-27T00:40", "2024-10-27T01:10", "2024-10-27T01:40", "2024-10-27T02:10"],
        "order": ["2024-04-11T10:00", "2024-04-12T10:00", "2024-04-13T10:00", "2024-04-14T10:00", "2024-05-01T10:00"],
        "month first": ["2024-04-28T10:00", "2024-05-01T10:00", "2024-05-02T10:00"],
    }
    data = [(100 * k + j, f, t) for k, (f, ts) in enumerate(rows.items()) for j, t in enumerate(ts)]
    feeds = spark.createDataFrame([("zone", "Europe/Oslo", "DMY"), ("order", None, None), ("month first", "UTC", None)], "feed_id string, time_zone string, date_order string")
    df = spark.createDataFrame(data, "row_id long, feed_id string, time string")
    for block in (1 << 17, 2):
        got = normalise_stamps(df, feeds, StampRule(block=block)).orderBy("row_id").collect()
        assert [np.datetime64(r["time_us"], "us").astype("datetime64[m]").item().strftime("%Y-%m-%dT%H:%M") for r in got] == [x for f in rows for x in want[f]]
        assert [r["readings"] for r in got] == [1, 2, 2, 2, 2, 1, 2, 2, 1, 1, 2, 1, 2, 2]
