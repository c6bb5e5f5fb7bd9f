"""From a DEM's vertical datum to mean sea level: the offset of each area, by the best evidence there is."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skerry.operators.match import nearest_place

#: The vertical datum of each DEM, and the tidal regions asked for a place, those west of a longitude first.
DEM_DATUM = {"cudem": "NAVD88", "gmrt": "MSL_APPROX"}
REGIONS = (("westcoast", -115.0), ("contiguous", None))


@dataclass(frozen=True)
class DatumRule:
    """Limits of the resolution. least: samples that make a median trusted. The others are metres or kilometres."""

    least: int = 5
    plausible_m: float = 5.0
    spread_warn_m: float = 0.15
    spread_fail_m: float = 0.5
    gauge_km: float = 30.0
    gauge_warn_km: float = 10.0
    crosscheck_m: float = 0.15
    sentinel: float = 10_000.0


def resolve_datum(areas: DataFrame, samples: DataFrame, gauges: DataFrame, rule: DatumRule = DatumRule()) -> DataFrame:
    """``area, datum, datum_offset_m, method, status, samples, spread_m, region, gauge_id, gauge_km, gauge_offset_m, crosscheck_m, warning``.

    ``areas(area, dem_source, lat, lon, fallback_m)``; ``samples(area, region, t_z)`` are heights of the DEM's zero over mean sea level at
    points of the waterline (beyond the sentinel: out of coverage); ``gauges(place_id, lat, lon, msl, navd88, units)``.

    A DEM that already refers to sea level has offset 0. One on NAVD88 has the median of minus its samples, of the first region that
    answers for the area; a median that isn't plausible counts as none, and samples that lie too far apart refuse the area.
    The nearest gauge with both datums in metres is held against it, and stands in where there are no samples. What remains has
    the area's fallback, else 0 with the status ``unresolved_assumed_zero``. A resolved value always wins over the fallback.
    """
    a = areas.select("area", "dem_source", "lat", "lon", "fallback_m").withColumn("datum", F.coalesce(*(F.when(F.col("dem_source") == s, F.lit(d)) for s, d in DEM_DATUM.items()), F.lit("UNKNOWN")))
    rank = F.coalesce(*(F.when((F.col("region") == r) & (F.lit(True) if west is None else F.col("lon") < west), F.lit(k)) for k, (r, west) in enumerate(REGIONS)))
    s = samples.join(a.select("area", "lon"), "area").withColumn("rank", rank).where(F.col("rank").isNotNull() & (F.abs("t_z") <= rule.sentinel))
    per = s.groupBy("area", "rank").agg(F.first("region").alias("region"), F.median(-F.col("t_z")).alias("off"), (F.max("t_z") - F.min("t_z")).alias("spread_m"), F.count("*").alias("samples"))
    pinned = per.groupBy("area").agg(F.min_by(F.struct("region", "off", "spread_m", "samples"), "rank").alias("v")).select("area", "v.*")
    tie = F.col("msl") - F.col("navd88")
    usable = tie.isNotNull() & (F.abs(tie) <= rule.plausible_m) & (F.coalesce(F.lower("units"), F.lit("")).isin("") | F.lower("units").startswith("meter"))
    near = nearest_place(a.select(F.col("area").alias("point_id"), "lat", "lon"), gauges, within_km=rule.gauge_km, usable=usable)
    near = near.join(gauges.select("place_id", tie.alias("tie")), "place_id").select(F.col("point_id").alias("area"), F.col("place_id").alias("gauge_id"), F.col("km").alias("gauge_km"), F.col("tie").alias("gauge_off"))
    j = a.join(pinned, "area", "left").join(near, "area", "left")
    navd = F.col("datum") == "NAVD88"
    known = navd & (F.abs("off") <= rule.plausible_m)
    apart = known & (F.col("spread_m") > rule.spread_fail_m)
    gauge = navd & F.col("gauge_off").isNotNull()
    method = F.when(F.col("datum") == "MSL_APPROX", "gmrt_msl_assumed").when(~navd, "unknown_dem_datum").when(apart, "vdatum_spread_too_large").when(known, "vdatum_navd88_to_lmsl").when(gauge, "coops_msl_minus_navd88").otherwise("none")
    j = j.withColumns({"how": method, "_known": F.coalesce(known, F.lit(False)), "_apart": F.coalesce(apart, F.lit(False))})
    open_ = F.col("how").isin("unknown_dem_datum", "vdatum_spread_too_large", "none")
    fallen = open_ & F.col("fallback_m").isNotNull()
    value = F.when(F.col("how") == "vdatum_navd88_to_lmsl", F.round("off", 3)).when(F.col("how") == "coops_msl_minus_navd88", F.round("gauge_off", 3)).when(fallen, F.col("fallback_m")).otherwise(F.lit(0.0))
    both = F.col("_known") & ~F.col("_apart") & F.col("gauge_off").isNotNull()
    told = (F.col("how") == "coops_msl_minus_navd88") | both
    cross = F.when(both, F.round(F.abs(F.col("off") - F.col("gauge_off")), 3))
    warning = F.array_join(
        F.filter(
            F.array(
                F.when(F.col("_known") & (F.col("samples") < rule.least), "few samples"),
                F.when(F.col("_known") & ~F.col("_apart") & (F.col("spread_m") > rule.spread_warn_m), "samples vary"),
                F.when(told & (F.col("gauge_km") > rule.gauge_warn_km), "gauge is far"),
                F.when(F.abs(F.col("off") - F.col("gauge_off")) > rule.crosscheck_m, F.when(both, F.lit("gauge disagrees"))),
            ),
            lambda x: x.isNotNull(),
        ),
        ", ",
    )
    return j.select(
        "area", "datum", value.alias("datum_offset_m"), F.when(fallen, "config_fallback").otherwise(F.col("how")).alias("method"),
        F.when(fallen, "regional_default").when(open_, "unresolved_assumed_zero").otherwise("ok").alias("status"),
        *(F.when(F.col("_known"), F.col(c)).alias(c) for c in ("samples", "spread_m", "region")),
        *(F.when(told, F.col(c)).alias(c) for c in ("gauge_id", "gauge_km")), F.when(told, F.round("gauge_off", 3)).alias("gauge_offset_m"), cross.alias("crosscheck_m"), warning.alias("warning"),
    )
