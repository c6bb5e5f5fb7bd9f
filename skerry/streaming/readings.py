"""Readings as a stream: late and repeated rows, windows, and idempotent blocks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from skerry.operators.regular import finite
from skerry.runtime import ensure_checkpoint_dir
from skerry.sources.store import append_blocks


def stream_of(spark: SparkSession, path: str, schema: StructType, *, files_per_trigger: int = 100) -> DataFrame:
    """Parquet files of a folder (or pattern) as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def windowed(readings: DataFrame, *, late: str = "7 days", window: str = "1 hour", slide: str | None = None, key: str = "station_id", time: str = "time", value: str = "value", ident: str = "obs_id") -> DataFrame:
    """``key, start, n, mean, low, high`` a window; readings sent again within the lateness count once, missing values don't."""
    r = readings.where(finite(F.col(value))).withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).dropDuplicates([ident, time])
    w = F.window(time, window, slide) if slide else F.window(time, window)
    g = r.groupBy(key, w.alias("w")).agg(F.count("*").alias("n"), F.avg(value).alias("mean"), F.min(value).alias("low"), F.max(value).alias("high"))
    return g.select(key, F.col("w.start").alias("start"), "n", "mean", "low", "high")


def drain(stream: DataFrame, keys: list[str], *, path: str | None = None) -> DataFrame:
    """Run an aggregated stream over all that is there now, and return its last rows, one for each of ``keys``.

    Each micro-batch writes the rows that it changed (update mode) as its own block of a table, and one done again replaces
    its block; nothing gathers in the driver, and the state is bounded by the watermark. Table and progress lie below ``path``, by default
    a new folder in the session's shared checkpoint folder.
    """
    path = path or f"{ensure_checkpoint_dir(stream.sparkSession)}/stream-{uuid.uuid4().hex}"

    def keep(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/rows/batch={batch}")

    stream.sparkSession.createDataFrame([], stream.schema).write.parquet(f"{path}/rows/batch=-1")  # so that there is a table without input
    q = stream.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{path}/progress").trigger(availableNow=True).start()
    q.awaitTermination()
    rows = stream.sparkSession.read.schema(StructType([*stream.schema.fields, StructField("batch", LongType())])).parquet(f"{path}/rows")
    rest = [c for c in stream.columns if c not in keys]
    last = F.max_by(F.struct(*rest), "batch").alias("r")
    return rows.groupBy(*keys).agg(last).select(*keys, *(F.col(f"r.{c}").alias(c) for c in rest)).select(*stream.columns)


def keep_blocks(stream: DataFrame, path: str, checkpoint: str, *, by: str = "day") -> None:
    """Write each micro-batch as whole blocks of a table; a batch that is done again replaces its own blocks."""
    q = stream.writeStream.foreachBatch(lambda df, _: append_blocks(df, path, by=by)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
