"""What a cube's channels were made from, which of them are derived, and run reports folded together."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skerry.plans.products import PREFIX

MET_VARIABLES = "airtemp|wind_u|wind_v|wind_speed|swrad|cloud_cover"
SENSOR = f"(?:{'|'.join(sorted(PREFIX.values(), key=len, reverse=True))})"
#: Channel pattern -> products it was made from (``*``: that of the sensor whose prefix it has); the first that matches.
RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    (r"doy_(sin|cos)", ()),
    (r"landcover_water", ("landcover",)),
    (r"insitu_(sst|dt_min|n|station)", ("insitu",)),
    (r"cmems_.+", ("cmems",)),
    (r"mur_.+", ("mur",)),
    (r"(elevation|depth|depth_p25|depth_p75)_.+", ("bathymetry",)),
    (rf"{SENSOR}_.*georef.*", ("*", "landcover")),
    (rf"{SENSOR}_(sst|cloud|valid|hour|footprint)(_.+)?", ("*",)),
    (rf"{SENSOR}_insitu.*", ("insitu", "*")),
    (rf"{SENSOR}_({MET_VARIABLES})_.+", ("met_overpass", "*")),
    (rf"{SENSOR}_tide_.+", ("tides", "*")),
    (rf"{SENSOR}_water_.+", ("bathymetry", "tides", "*")),
    (rf"{SENSOR}_scene_cloud_pct.*", ("met_overpass", "*")),
    (rf"({MET_VARIABLES})_.+", ("met",)),
    (r"tide_.+", ("tides",)),
)
#: Endings of channels that a step made.
DERIVED = ("_clean", "_georef_corrected", "_gapfilled", "_filled", "filtered", "_water_elev", "_water_class", "_georef_applied")


def _sensor(name: str) -> str | None:
    return next((p for p, prefix in sorted(PREFIX.items(), key=lambda kv: -len(kv[1])) if name.startswith(f"{prefix}_")), None)


def inputs_of(name: str) -> list[str] | None:
    """The products that a channel was made from; None for a channel that no rule knows."""
    for pattern, products in RULES:
        if re.fullmatch(pattern, name):
            return [_sensor(name) if p == "*" else p for p in products]
    return None


def with_inputs(fields: DataFrame, field: str = "field") -> DataFrame:
    """``fields`` with ``inputs``, the products of each (NULL where no rule knows it): the rules as expressions."""
    own: Column = F.lit(None).cast("string")
    for product, prefix in PREFIX.items():
        own = F.when(F.col(field).startswith(f"{prefix}_"), product).otherwise(own)
    out: Column = F.lit(None).cast("array<string>")
    for pattern, products in reversed(RULES):
        made = F.array(*(own if p == "*" else F.lit(p) for p in products)).cast("array<string>")
        out = F.when(F.col(field).rlike(f"^(?:{pattern})$"), made).otherwise(out)
    return fields.withColumn("inputs", out)


def is_derived(name: str) -> bool:
    """Whether a step made the channel, not the assembly."""
    return name.endswith(DERIVED) or "_georef_" in name or "_scene_cloud_pct_" in name


def merge_reports(reports: DataFrame, *, most: int = 20) -> DataFrame:
    """``product, written, skipped, failed, expected, sources, failures, dropped, note, elapsed_s, ok``: run reports of one product folded into
    one. Counts and seconds add up, also those of each source (a map); of the failures, in the order of ``part``, ``most`` are
    kept and the others counted; what was expected is missing only where no part knows it.

    ``reports`` has a row for each part: ``product, part, written, skipped, failed, expected, sources map<string,bigint>, failures
    array<string>, dropped, note, elapsed_s``.
    """
    count = reports.select("product", F.explode("sources").alias("source", "n")).groupBy("product", "source").agg(F.sum("n").alias("n"))
    sources = count.groupBy("product").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("source", "n")))).alias("sources"))
    parts = F.array_sort(F.collect_list(F.struct("part", F.coalesce("failures", F.array().cast("array<string>")).alias("f"), F.coalesce("note", F.lit("")).alias("note"))))
    g = reports.groupBy("product").agg(*(F.sum(c).alias(c) for c in ("written", "skipped", "failed", "expected", "elapsed_s")), F.sum(F.coalesce("dropped", F.lit(0))).alias("_d"), parts.alias("_p"))
    every = F.flatten(F.transform("_p", lambda x: x["f"]))
    g = g.withColumns({"failures": F.slice(every, 1, most), "dropped": F.col("_d") + F.greatest(F.size(every) - most, F.lit(0)), "note": F.array_join(F.filter(F.transform("_p", lambda x: x["note"]), lambda n: n != ""), "; ")})
    j = g.join(sources, "product", "left")
    return j.select("product", "written", "skipped", "failed", "expected", "sources", "failures", "dropped", "note", "elapsed_s", (F.col("failed") == 0).alias("ok"))
