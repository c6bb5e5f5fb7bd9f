"""Nearest-time matching against plain loops."""

import random
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from skerry.llm.nearest import match_nearest
from skerry.operators.regular import finite

T0 = datetime(2024, 3, 1, tzinfo=UTC)
LEFT = "overpass_id long, station_id string, time timestamp, k string, block int, g int"
RIGHT = "obs_id long, station_id string, time timestamp, value double, i int, t int"


def us(t):
    return round(t.timestamp() * 1e6)


@pytest.mark.parametrize("seed,block,groups", [(1, 10_000, None), (2, 1, 3), (3, 40, 1)])
def test_equals_plain_search(spark, rows, seed, block, groups):
    rnd = random.Random(seed)
    right = [(rnd.randrange(900), rnd.choice("ABBBBB"), T0 + timedelta(minutes=10 * rnd.randrange(3000)), rnd.choice([1.0, 2.0, None, float("nan")]), 0, 0) for _ in range(900)]
    left = [(i, rnd.choice(["A", " B", "B\t", "C"]), T0 + timedelta(minutes=5 * rnd.randrange(6000)), "k", 1, 1) for i in range(300)]
    left += left[:20] + [(None, "A", T0, "k", 1, 1), (901, None, T0, "k", 1, 1), (902, "A", None, "k", 1, 1)]
    right += right[:50] + [(None, "A", T0, 1.0, 0, 0), (5, None, T0, 1.0, 0, 0), (6, "A", None, 1.0, 0, 0)]
    got = match_nearest(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), right_ok=finite(F.col("value")), block_rows=block, groups=groups)
    want = {}
    for i, s, t, *_ in left:
        if i is None or s is None or t is None:
            continue
        best = min(((abs(us(rt) - us(t)), us(rt), ri) for ri, rs, rt, v, *_ in right if None not in (ri, rs, rt, v) and v == v and rs == s.strip() and abs(us(rt) - us(t)) <= 3_600_000_000), default=None)
        if best:
            want[i] = (i, best[2], best[1] - us(t))
    assert rows(got) == sorted(want.values())
    assert len(want) > 100


def test_limits_and_ties(spark, rows):
    left = spark.createDataFrame([(1, "A", T0), (2, "A", T0 + timedelta(hours=5))], "overpass_id long, station_id string, time timestamp")
    h = timedelta(hours=1)
    right = spark.createDataFrame([(9, "A", T0 + h), (8, "A", T0 - h), (7, "A", T0 - h), (6, "A", T0 + 6 * h + timedelta(microseconds=1))], "obs_id long, station_id string, time timestamp")
    assert rows(match_nearest(left, right)) == [(1, 7, -3_600_000_000)]
    assert match_nearest(left.limit(0), right).count() == 0
    assert match_nearest(left, right.limit(0)).count() == 0
