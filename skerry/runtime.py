"""Session helpers shared by operators and queries."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FEW = 200_000  # keys, counted, whose numbers are broadcast


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` below ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; a folder of our own only where none is set and Spark is local."""
    sc = spark.sparkContext
    have = sc.getCheckpointDir()
    if have:
        return have
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf is None:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf = os.path.join(tempfile.gettempdir(), "skerry-checkpoints")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once into the shared checkpoint folder, so that later stages don't compute it again."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores where a scan of its size would not fill them, for costly work row by row.

    An input of enough bytes, or of a file for every other core, keeps the scan's own partitions and is not shuffled: only a few
    files, whose row groups can't be split, are dealt out, evenly whatever their values. Spark orders the rows before dealing
    them, so that a task that runs again gets the same.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    full = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    if size >= cores * full or 2 * len(df.inputFiles()) >= cores:
        return df
    return df.repartition(2 * cores)


def block_lengths(times: DataFrame, rows: int, least: int = 1) -> DataFrame:
    """``k, n, size`` from ``k, t``: the rows of each key, and a length of time in which it has ``rows`` rows on average (at
    least ``least``). Computed once, a row a key."""
    span = (F.max("t") - F.min("t") + 1) / F.count("*")
    return cut(times.groupBy("k").agg(F.count("*").alias("n"), F.greatest(F.ceil(span * rows), F.lit(least)).cast("long").alias("size")))


def beside_key(df: DataFrame, numbers: DataFrame) -> DataFrame:
    """``df`` with the numbers of its key ``k``: broadcast where the keys, counted, are few; else an equi-join that adaptive execution
    may split at hot keys. Rows whose key has none are dropped."""
    return df.join(F.broadcast(numbers) if numbers.count() <= FEW else numbers, "k")
