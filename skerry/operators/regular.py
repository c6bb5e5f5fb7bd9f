"""Irregular readings onto a regular grid of time cells, by validity intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

DAY_US = 86_400_000_000


def finite(value: Column) -> Column:
    """True where ``value`` is neither NULL, NaN nor infinite (never NULL)."""
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))


def _instants(readings: DataFrame, key: str, time: str, value: str, ident: str | None, block_days: int) -> DataFrame:
    """One row for each key and instant: ``k, block, t (us), v, n``. Rows sent again (same ident) count once."""
    cols = [F.col(key).alias("k"), F.unix_micros(F.col(time).cast("timestamp")).alias("t"), F.col(value).cast("double").alias("v")]
    if ident:
        cols.append(F.col(ident).alias("i"))
    r = readings.select(*cols).where(F.col("k").isNotNull() & F.col("t").isNotNull() & finite(F.col("v")))
    r = r.withColumn("block", F.floor(F.col("t") / F.lit(block_days * DAY_US))).repartition("k", "block")
    if ident:
        r = r.dropDuplicates(["k", "block", "t", "i", "v"])
    return r.groupBy("k", "block", "t").agg(F.avg("v").alias("v"), F.count("*").alias("n"))


def validity_intervals(readings: DataFrame, *, key: str = "station_id", time: str = "time", value: str = "value", ident: str | None = "obs_id", block_days: int = 30) -> DataFrame:
    """Readings as a step function: ``k, t, until, v, n`` with microseconds; a reading holds until the next one of its key.

    ``until`` of a key's last reading is NULL. Readings with a missing value, time or key give no interval; several at one
    instant give one with their mean; rows sent again (same ``ident``, key and instant) count once. A key of any size is
    worked on in blocks of ``block_days``; only each block's first and last instants meet across blocks.
    """
    one = _instants(readings, key, time, value, ident, block_days)
    inside = one.withColumn("until", F.lead("t").over(W.partitionBy("k", "block").orderBy("t")))
    ends = one.groupBy("k", "block").agg(F.min("t").alias("first"), F.max("t").alias("t"), F.max_by("v", "t").alias("v"), F.max_by("n", "t").alias("n"))
    ends = ends.withColumn("until", F.lead("first").over(W.partitionBy("k").orderBy("block")))
    cols = ["k", "t", "until", "v", "n"]
    return inside.where(F.col("until").isNotNull()).select(*cols).unionByName(ends.select(*cols))


def regular_grid(readings: DataFrame, *, step_s: int = 3600, hold_s: int = 3600, key: str = "station_id", time: str = "time", value: str = "value", ident: str | None = "obs_id", block_days: int = 30) -> DataFrame:
    """One row for each key and time cell from the cell of the key's first reading to that of its last.

    Columns ``key, cell_s (start, seconds since 1970), n (readings in the cell), mean (time-weighted), coverage (0..1),
    status``. A reading is valid until the next one, at most ``hold_s``; each validity interval is cut at the cells it
    meets. ``status`` is ``read`` (n > 0), ``held`` (covered by an earlier reading only) or ``missing`` (mean NULL). The last
    reading is valid to the end of its cell. A cell covered for no time at all (readings in its last microsecond only) has
    their plain mean. Keys without a usable reading give no row; an empty table gives none.
    """
    step, hold = F.lit(step_s * 1_000_000), F.lit(hold_s * 1_000_000)
    iv = validity_intervals(readings, key=key, time=time, value=value, ident=ident, block_days=block_days)
    c0 = F.floor(F.col("t") / step)
    # the interval also has to name the cells in which the reading no longer holds: they are the gaps
    last = F.when(F.col("until").isNull(), c0).otherwise(F.floor((F.col("until") - 1) / step))
    cells = iv.select("k", "t", "v", "n", c0.alias("c0"), F.least(F.coalesce("until", (c0 + 1) * step), F.col("t") + hold).alias("valid_to"), F.explode(F.sequence(c0, F.greatest(c0, last))).alias("cell"))
    lo, hi = F.greatest(F.col("t"), F.col("cell") * step), F.least(F.col("valid_to"), (F.col("cell") + 1) * step)
    here = F.greatest(hi - lo, F.lit(0)).cast("double")
    starts = F.col("cell") == F.col("c0")
    g = cells.groupBy("k", "cell").agg(
        F.sum(F.when(starts, F.col("n")).otherwise(0)).alias("n"),
        F.sum(here).alias("us"),
        F.sum(here * F.col("v")).alias("vus"),
        F.avg(F.when(starts, F.col("v"))).alias("plain"),
    )
    return g.select(
        F.col("k").alias(key),
        (F.col("cell") * step_s).alias("cell_s"),
        F.col("n").cast("long").alias("n"),
        F.when(F.col("us") > 0, F.col("vus") / F.col("us")).otherwise(F.col("plain")).alias("mean"),
        (F.col("us") / (step_s * 1e6)).alias("coverage"),
        F.when(F.col("n") > 0, "read").when(F.col("us") > 0, "held").otherwise("missing").alias("status"),
    )


def hours_without_reading(readings: DataFrame, **how) -> DataFrame:
    """The hours between a station's first and last reading in which it has none: ``station_id, hour_s``."""
    g = regular_grid(readings, step_s=3600, **how)
    key = how.get("key", "station_id")
    return g.where(F.col("n") == 0).select(F.col(key).alias("station_id"), F.col("cell_s").cast("long").alias("hour_s"))
