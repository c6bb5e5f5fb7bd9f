"""Properties of plans: no pairs of everything with everything, columns pruned, results alike however partitioned."""

import importlib
import os

import pytest

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
QUERIES = importlib.import_module("__spark_entry__").queries()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, DATA))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_scans_read_what_they_need(spark):
    text = plan(QUERIES["p4_found"](spark, DATA))
    assert "ReadSchema: struct<obs_id:bigint,station_id:string,time:timestamp_ntz,value:double>" in text or "received_at" not in text
    assert "PushedFilters: [" in text and "IsNotNull(station_id)" in text


@pytest.mark.parametrize("name", ["p1_found", "p3_found", "p4_hourly", "p5_found", "mosaic_fill", "lerp_at_time", "nn_fill"])
def test_partitions_do_not_matter(spark, rows, name):
    got = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n, adaptive in (("1", "true"), ("7", "false")):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            spark.conf.set("spark.sql.adaptive.enabled", adaptive)
            got.append(sorted(map(str, QUERIES[name](spark, DATA).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert got[0] == got[1]
