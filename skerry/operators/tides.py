"""Harmonic tide prediction and water level at an instant."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skerry.functions import astronomy


def predict_harmonics(constituents: DataFrame, *, start: str, end: str, step_s: int = 3600) -> DataFrame:
    """``station_id, ts, value``: the tide relative to mean sea level from published constituents (``station_id, number, amplitude,
    phase_deg``: the number in :data:`skerry.functions.astronomy.NAMES` from 1, the phase against Greenwich), with node factors,
    for every step from start to the end of the last day, the end left out.

    Unknown numbers and rows with a missing value are left out; a station without any known constituent gives no rows. Each
    station's few constituents come as one array; the astronomical arguments are the same for all and are worked out
    once a task.
    """
    first, after = (int(np.datetime64(d, "s").astype(np.int64)) for d in (start, end))
    seconds = np.arange(first, after + 86_400, step_s)
    known = constituents.where(F.col("number").between(1, len(astronomy.NAMES)) & F.col("amplitude").isNotNull() & F.col("phase_deg").isNotNull())
    c = known.groupBy("station_id").agg(F.sort_array(F.collect_list(F.struct(F.col("number").cast("int").alias("n"), F.col("amplitude").cast("double").alias("a"), F.col("phase_deg").cast("double").alias("g")))).alias("c"))
    ident = c.schema["station_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f, v = astronomy.tide_arguments(seconds)
        ts = pa.array(seconds * 1_000_000, pa.timestamp("us", "UTC"))
        for b in batches:
            for k, own in zip(b.column(0), b.column(1).to_pylist(), strict=True):
                n = np.array([x["n"] - 1 for x in own])
                a, g = np.array([x["a"] for x in own]), np.array([x["g"] for x in own])
                height = (a[:, None] * f[n] * np.cos(np.radians(v[n] - g[:, None]))).sum(0)
                yield pa.RecordBatch.from_arrays([pa.array([k.as_py()] * seconds.size, k.type), ts, pa.array(height)], names=["station_id", "ts", "value"])

    return c.mapInArrow(run, f"station_id {ident}, ts timestamp, value double")


def predict(stations: DataFrame, constituents: DataFrame, *, start: str, end: str, step_s: int = 3600) -> DataFrame:
    """``station_id, ts, value``: the sum of a station's constituents (``station_id, amplitude, speed_deg_h, phase_deg``) for every step
    from start to the end of the last day, the end left out. Phases refer to 1970-01-01 UTC; any speeds, so
    no node factors (see :func:`predict_harmonics`).

    A station's constituents are a short array beside it, summed in place for each instant."""
    c = constituents.groupBy("station_id").agg(F.sort_array(F.collect_list(F.struct("speed_deg_h", "amplitude", "phase_deg"))).alias("c"))
    lo, hi = F.unix_timestamp(F.lit(start).cast("timestamp")), F.unix_timestamp(F.lit(end).cast("timestamp")) + 86_400
    s = stations.select("station_id").join(c, "station_id").withColumn("s", F.explode(F.sequence(lo, hi - step_s, F.lit(step_s).cast("long"))))
    term = lambda x: x["amplitude"] * F.cos(F.radians(x["speed_deg_h"] * (F.col("s") / 3600.0) - x["phase_deg"]))
    return s.select("station_id", F.timestamp_seconds("s").alias("ts"), F.aggregate("c", F.lit(0.0), lambda acc, x: acc + term(x)).alias("value"))
