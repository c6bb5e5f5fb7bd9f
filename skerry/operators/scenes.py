"""Overpass scenes: validity, ranking, the clearest scene of a day and the mosaic of all.

A scene table has ``day, granule, ts, row, col, sst`` and, after :func:`with_validity`, ``valid``; layers that a sensor lacks are
NULL columns.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skerry.functions.values import digital_number, flag, normalised_difference, any_bit, water_by_layer


@dataclass(frozen=True)
class SensorRule:
    """How a sensor's layers make a pixel valid."""

    water_is_land: bool = False
    use_cloud: bool = True
    qc_levels: tuple[int, ...] | None = None
    trust_valid: bool = False


def with_validity(scenes: DataFrame, rule: SensorRule) -> DataFrame:
    """Column ``valid``. Trusted sensors: the file's own flag (``file_valid``) and a value. Others: a value over water, not cloudy
    (a missing cloud flag is cloudy) where the sensor has a cloud gate, and low quality bits among the levels (missing fails).
    A missing water layer makes a pixel invalid."""
    has = F.col("sst").isNotNull()
    if rule.trust_valid:
        return scenes.withColumn("valid", has & flag(F.col("file_valid")))
    ok = has & water_by_layer(F.col("water"), F.lit(rule.water_is_land))
    if rule.use_cloud:
        ok = ok & flag(F.col("cloud") == 0)
    if rule.qc_levels is not None:
        ok = ok & flag(F.col("quality").bitwiseAND(F.lit(3)).isin(*rule.qc_levels))
    return scenes.withColumn("valid", ok)


def decode_scene(dn: DataFrame, *, scale: float, offset: float, water_threshold: float, cloud_bits: tuple[int, ...] = (1, 3, 4), cloud_distance: float = 0.0) -> DataFrame:
    """Raw digital numbers (``thermal, green, nir, qa, cloud_km``) into ``sst`` (Celsius), ``water``, ``cloud``, ``valid``.

    Water is where the normalised difference of green and near infrared is at least the threshold; cloud is where a quality bit is
    set or the distance to cloud is below the limit; missing layers give neither.
    """
    out = dn.withColumns(
        {
            "sst": digital_number(F.col("thermal"), scale, offset, celsius=True),
            "water": flag(normalised_difference(F.col("green"), F.col("nir")) >= water_threshold),
            "cloud": flag(any_bit(F.col("qa"), *cloud_bits)) | flag(F.col("cloud_km") < cloud_distance),
        }
    )
    return out.withColumn("valid", F.col("sst").isNotNull() & F.col("water") & ~F.col("cloud"))


def granules(scenes: DataFrame) -> DataFrame:
    """One row a granule: ``day, granule, ts, n_valid, rank`` (most valid pixels first; of equals the earlier, then the name) and
    ``record`` (more valid pixels than every earlier granule of its day)."""
    g = scenes.groupBy("day", "granule").agg(F.min("ts").alias("ts"), F.sum(F.col("valid").cast("long")).alias("n_valid"))
    w = W.partitionBy("day").orderBy("ts", "granule")
    earlier = F.max("n_valid").over(w.rowsBetween(W.unboundedPreceding, -1))
    return g.withColumn("record", F.coalesce(F.col("n_valid") > earlier, F.lit(True))).withColumn("rank", F.row_number().over(W.partitionBy("day").orderBy(F.desc("n_valid"), "ts", "granule")))


def clearest(scenes: DataFrame) -> DataFrame:
    """The whole clearest granule of each day: ``day, granule, ts, hour, row, col, sst, cloud, valid``; missing cloud is 0."""
    best = granules(scenes).where("rank = 1").select("day", "granule", F.col("ts").alias("base_ts"))
    s = scenes.join(best, ["day", "granule"])
    hour = F.hour("base_ts") + F.minute("base_ts") / 60.0
    return s.select("day", "granule", F.col("base_ts").alias("ts"), hour.alias("hour"), "row", "col", "sst", F.coalesce("cloud", F.lit(0)).alias("cloud"), "valid")


def mosaic(scenes: DataFrame) -> DataFrame:
    """One row for each day and cell that any granule has: ``day, row, col, sst, cloud, valid, source, hour``.

    Where a granule is valid, that of most valid pixels (of equals the earlier) counts. Elsewhere granules that set a record of
    valid pixels come first, by that number, then the earliest other with a value. Cells without any value keep the base granule's
    cloud. ``hour`` is the base granule's; missing cloud is 0.
    """
    # the base granule of the day beside each granule: a window over a few rows, so that the scenes are joined once
    top = F.first(F.struct("granule", "ts")).over(W.partitionBy("day").orderBy("rank").rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    g = granules(scenes).withColumn("_top", top)
    g = g.select("day", "granule", "n_valid", "record", F.col("ts").alias("gts"), F.col("_top.granule").alias("base"), (F.hour("_top.ts") + F.minute("_top.ts") / 60.0).alias("hour"))
    s = scenes.select("day", "granule", "row", "col", "sst", "cloud", "valid").join(g, ["day", "granule"])
    has = F.col("sst").isNotNull()
    ranked = F.col("valid") | F.col("record")
    order = [F.when(has, 0).otherwise(1), F.when(F.col("valid"), 0).otherwise(1), F.when(ranked, 0).otherwise(1), F.when(ranked, -F.col("n_valid")), F.when(~has, F.when(F.col("granule") == F.col("base"), 0).otherwise(1)), F.col("gts"), F.col("granule")]
    # the best row by one aggregate: partial results before the shuffle, and no sort of a cell's granules
    best = F.min_by(F.struct("sst", "cloud", "valid", "granule", "hour"), F.struct(*(F.coalesce(c, F.lit(0)) if k == 3 or k == 4 else c for k, c in enumerate(order))))
    out = s.groupBy("day", "row", "col").agg(best.alias("b"))
    return out.select("day", "row", "col", "b.sst", F.coalesce("b.cloud", F.lit(0)).alias("cloud"), (F.col("b.valid") & F.col("b.sst").isNotNull()).alias("valid"), F.col("b.granule").alias("source"), "b.hour")


def multi_granule_days(scenes: DataFrame) -> DataFrame:
    """``multi, any``: days with more than one granule, and with any."""
    n = scenes.groupBy("day").agg(F.countDistinct("granule").alias("n"))
    return n.agg(F.coalesce(F.sum((F.col("n") > 1).cast("long")), F.lit(0)).alias("multi"), F.count("*").alias("any"))


def layer_present(scenes: DataFrame, layer: str) -> DataFrame:
    """``present``: whether any row of the whole window has the layer."""
    return scenes.agg(F.coalesce(F.max(F.col(layer).isNotNull()), F.lit(False)).alias("present"))


def water_polarity(scenes: DataFrame, land: DataFrame, *, sample: int = 8, least: int = 500, sure: float = 0.65) -> DataFrame:
    """``code, agreement, cells, binary`` of a water layer held against a land cover (``row, col, water``).

    At most ``sample`` granules (every n-th by time and name) are compared where both are known. ``land-coded`` where a share of at
    least ``sure`` of (layer < 0.5) agrees with water, ``water-coded`` at 1 - sure or less, else ``ambiguous``; ``too few`` below
    ``least`` cells. ``agreement`` is the larger share; ``binary`` tells that the layer looks like 0 and 1.
    """
    g = scenes.groupBy("granule").agg(F.min("ts").alias("ts")).withColumn("_day", F.to_date("ts"))
    # ranks over all granules: those within a day, after the number of the days before (one row a day of the calendar)
    days = g.groupBy("_day").agg(F.count("*").alias("m"))
    before = F.sum("m").over(W.orderBy("_day").rowsBetween(W.unboundedPreceding, -1))
    days = days.select("_day", F.coalesce(before, F.lit(0)).alias("before"), F.sum("m").over(W.partitionBy()).alias("n"))
    g = g.join(days, g["_day"].eqNullSafe(days["_day"])).select("granule", (F.col("before") + F.row_number().over(W.partitionBy(g["_day"]).orderBy("ts", "granule"))).alias("k"), F.greatest(F.floor(F.col("n") / sample), F.lit(1)).alias("stride"))
    pick = g.where(((F.col("k") - 1) % F.col("stride") == 0) & ((F.col("k") - 1) / F.col("stride") < sample)).select("granule")
    s = scenes.join(pick, "granule", "left_semi").where("water IS NOT NULL").join(land.where("water IS NOT NULL").select("row", "col", F.col("water").alias("land_water")), ["row", "col"])
    agg = s.agg(F.avg(((F.col("water") < 0.5) == (F.col("land_water") > 0.5)).cast("double")).alias("f"), F.count("*").alias("cells"), F.countDistinct("water").alias("kinds"), F.min("water").alias("lo"), F.max("water").alias("hi"))
    code = F.when(F.col("cells") < least, "too few").when(F.col("f") >= sure, "land-coded").when(F.col("f") <= 1 - sure, "water-coded").otherwise("ambiguous")
    binary = flag((F.col("kinds") <= 2) & (F.col("lo") >= -0.1) & (F.col("hi") <= 1.1)) | (F.col("cells") == 0)
    return agg.select(code.alias("code"), F.greatest(F.col("f"), 1 - F.col("f")).alias("agreement"), "cells", binary.alias("binary"))


def preferred(column_of: dict[str, Column], preference: list[str]) -> Column:
    """The first value present over sources: the preferred ones in their order, then the others by name."""
    order = [t for t in preference if t in column_of] + sorted(t for t in column_of if t not in preference)
    return F.coalesce(*(column_of[t] for t in order))


def whole_window_variant(daily: DataFrame, wanted: str) -> DataFrame:
    """Rows of one variant for the whole window: the wanted one if it has any row, else the first other by name. One choice for
    all days, never day by day."""
    best = daily.agg(F.min(F.struct(F.when(F.col("variant") == wanted, 0).otherwise(1).alias("o"), F.col("variant").alias("variant"))).alias("b"))
    chosen = best.select(F.col("b.variant").alias("variant")).where("variant IS NOT NULL")
    return daily.join(F.broadcast(chosen), "variant", "left_semi")  # one row


def first_class(tiles: DataFrame) -> DataFrame:
    """``row, col, class``: the first class other than 0 over tiles in the order of ``tile``; 0 where all are 0."""
    return tiles.groupBy("row", "col").agg(F.coalesce(F.min_by(F.when(F.col("class") != 0, F.col("class")), F.when(F.col("class") != 0, F.col("tile"))), F.lit(0)).alias("class"))
