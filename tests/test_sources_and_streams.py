"""File sources, writing, and streams."""

import pytest
from pyspark.sql import functions as F

from skerry.sources import files, store
from skerry.streaming import readings


def test_points(spark, rows, tmp_path):
    p = tmp_path / "spots.csv"
    p.write_text("Station,Latitude,LONGITUDE\n a ,1.5,2\nb,x,2\nc,3,\nd,-4,5\n")
    assert rows(files.read_points(spark, str(p))) == [("a", 1.5, 2.0), ("d", -4.0, 5.0)]
    p.write_text("lat,lon\n1,2\n3,4\n")
    assert rows(files.read_points(spark, str(p))) == [("spots_0001", 1.0, 2.0), ("spots_0002", 3.0, 4.0)]
    for text in ("id,lat,lon\na,1,2\na,1,2\n", "id,lat,lon\na,91,2\n", "id,lat,latitude,lon\na,1,1,2\n", "id,a,b\n1,1,1\n"):
        p.write_text(text)
        with pytest.raises(ValueError):
            files.read_points(spark, str(p))
    assert files.resolve_paths(str(tmp_path)) == [str(p)]
    with pytest.raises(FileNotFoundError):
        files.resolve_paths(str(tmp_path / "none*"))


def test_observations(spark, rows):
    raw = spark.createDataFrame([("a", "2024-03-31 02:30:00", "10"), ("a", "2024-03-31 12:00:00", "50"), ("a", "2024-03-31T12:00:00Z", "68"), ("a", "never", "1"), ("a", "2024-03-31 12:00:00", "x")], "s string, w string, v string")
    o = files.observations(raw, columns={"station_id": "s", "time": "w", "value": "v"}, units=F.lit("degF"), zone=F.lit("Europe/Oslo"))
    assert rows(o.select(F.date_format("time", "HH:mm"), F.round("value", 3), "suspect")) == [("10:00", 10.0, False), ("12:00", 20.0, False)]
    with pytest.raises(ValueError):
        files.observations(raw, columns={"station_id": "s"}, units=F.lit("K"), zone=F.lit("UTC"))


def test_write_swap_and_scan(spark, tmp_path):
    at = str(tmp_path / "t")
    store.write_table(spark.range(3), at)
    store.write_table(spark.range(5), at)
    assert spark.read.parquet(at).count() == 5
    bad = spark.range(3).select(F.raise_error(F.lit("broken")).alias("x"))
    with pytest.raises(Exception, match="broken"):
        store.write_table(bad, at)
    assert spark.read.parquet(at).count() == 5
    assert store.is_complete(spark, at, ("id",), deep=True) and not store.is_complete(spark, at, ("other",)) and not store.is_complete(spark, at + "x")
    found = store.scan(spark, str(tmp_path))
    assert found["complete"] == ["t"] and len(found["scratch"]) == 1
    with pytest.raises(ValueError):
        store.write_table(spark.range(1), at, "xls")


def test_blocks_written_again_change_nothing(spark, rows, tmp_path):
    at = str(tmp_path / "blocks")
    df = spark.createDataFrame([("d1", 1), ("d2", 2)], "day string, v int")
    store.append_blocks(df, at, by="day")
    store.append_blocks(df.where("day = 'd2'").withColumn("v", F.lit(9)), at, by="day")
    store.append_blocks(df.where("day = 'd2'").withColumn("v", F.lit(9)), at, by="day")
    assert rows(spark.read.parquet(at), "day", "v") == [("d1", 1), ("d2", 9)]


def test_streams(spark, rows, tmp_path):
    src = str(tmp_path / "in")
    df = spark.createDataFrame([(1, "a", "2024-01-01 00:10:00", 1.0), (1, "a", "2024-01-01 00:10:00", 1.0), (2, "a", "2024-01-01 00:50:00", 3.0), (3, "a", "2024-01-01 01:10:00", float("nan")), (4, "b", "2024-01-01 01:20:00", 5.0)], "obs_id long, station_id string, time string, value double").withColumn("time", F.col("time").cast("timestamp"))
    df.write.parquet(src)
    out = readings.drain(readings.windowed(readings.stream_of(spark, src, df.schema)), ["station_id", "start"])
    assert rows(out.select("station_id", F.hour("start"), "n", "mean")) == [("a", 0, 2, 2.0), ("b", 1, 1, 5.0)]
    s = readings.stream_of(spark, src, df.schema).withColumn("day", F.to_date("time").cast("string"))
    for k in range(2):  # a new checkpoint does all batches again
        readings.keep_blocks(s, str(tmp_path / "out"), str(tmp_path / f"cp{k}"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5
