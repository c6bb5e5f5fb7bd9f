"""Baseline fits and the filters built on them. Filters compose: each drops from the running result, raw columns stay."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skerry.functions.values import flag

TINY = 1e-9


def design(day: Column, harmonic: bool) -> list[Column]:
    """The regressors: 1, and with a season the sine and cosine of the day of the year."""
    if not harmonic:
        return [F.lit(1.0)]
    a = F.dayofyear(day) * (2 * math.pi / 365.25)
    return [F.lit(1.0), F.sin(a), F.cos(a)]


def season_shows(days: DataFrame, day: str = "day") -> DataFrame:
    """``harmonic``: whether the whole window lets a season be fitted: days of the year span 60 or more, and sine and cosine vary."""
    d = days.select(F.col(day).alias("d")).distinct()
    a = F.dayofyear("d") * (2 * math.pi / 365.25)
    s = d.agg((F.max(F.dayofyear("d")) - F.min(F.dayofyear("d")) >= 60).alias("span"), F.stddev_pop(F.sin(a)).alias("s"), F.stddev_pop(F.cos(a)).alias("c"))
    return s.select(flag(F.col("span") & ~((F.col("s") < 1e-3) & (F.col("c") < 1e-3))).alias("harmonic"))


def beside(df: DataFrame, single: DataFrame) -> DataFrame:
    """``df`` with the columns of a frame of one row (the result of an aggregate without keys), by a scalar subquery."""
    one = single.select(F.struct(*single.columns).alias("_s")).scalar()
    return df.select("*", one.alias("_s")).select(*df.columns, *(F.col("_s")[c].alias(c) for c in single.columns))


def sigma_fit(values: DataFrame, *, keys: list[str], value: str, day: str, harmonic: bool = False) -> DataFrame:
    """``*keys, n, b0[, b1, b2], sigma``: least squares of the value on the design for each group (no keys: pooled).

    Coefficients are NULL where the normal equations are singular (|determinant| < 1e-9), and for groups with no more rows
    than coefficients; a pooled fit keeps them and divides by at least 1. sigma = sqrt(residual squares / (n - k)). Missing values
    are skipped. Two partial-then-final aggregations; the sums combine before the shuffle.
    """
    x = design(F.col("_d"), harmonic)
    k = len(x)
    v = values.select(*keys, F.col(value).cast("double").alias("_v"), F.col(day).alias("_d")).where("_v IS NOT NULL AND _d IS NOT NULL")
    v = v.select(*keys, "_v", *(c.alias(f"_x{i}") for i, c in enumerate(x)))
    sums = [F.sum(F.col(f"_x{i}") * F.col(f"_x{j}")).alias(f"m{i}{j}") for i in range(k) for j in range(i, k)]
    rhs = [F.sum(F.col(f"_x{i}") * F.col("_v")).alias(f"r{i}") for i in range(k)]
    g = v.groupBy(*keys).agg(F.count("*").alias("n"), *sums, *rhs)
    m = lambda i, j: F.col(f"m{min(i, j)}{max(i, j)}")
    if k == 1:
        det, solved = m(0, 0), [F.col("r0")]
    else:

        def det3(cols: list[list[Column]]) -> Column:
            a, b, c = cols
            return a[0] * (b[1] * c[2] - b[2] * c[1]) - b[0] * (a[1] * c[2] - a[2] * c[1]) + c[0] * (a[1] * b[2] - a[2] * b[1])

        full = [[m(i, j) for i in range(3)] for j in range(3)]
        right = [F.col(f"r{i}") for i in range(3)]
        det, solved = det3(full), [det3([right if c == j else full[c] for c in range(3)]) for j in range(3)]
    enough = F.lit(True) if not keys else F.col("n") > k
    g = g.withColumn("_det", det)
    g = g.select(*keys, "n", *(F.when(enough & (F.abs("_det") >= TINY), s / F.col("_det")).alias(f"b{i}") for i, s in enumerate(solved)))
    fitted = sum((F.col(f"_x{i}") * F.col(f"b{i}") for i in range(1, k)), F.col("_x0") * F.col("b0"))
    joined = v.join(g, keys) if keys else beside(v, g)
    res = joined.groupBy(*keys).agg(F.sum(F.pow(F.col("_v") - fitted, 2)).alias("_ssr"))
    g = g.join(res, keys) if keys else beside(g, res)
    return g.withColumn("sigma", F.sqrt(F.col("_ssr") / F.greatest(F.col("n") - k, F.lit(1)))).drop("_ssr")


def cutoff(n_sigma: float, day: Column, harmonic: bool, pre: str = "") -> Column:
    """Fitted value less ``n_sigma`` sigma, from columns b0.. and sigma (with ``pre`` before their names)."""
    x = design(day, harmonic)
    return sum((c * F.col(f"{pre}b{i}") for i, c in enumerate(x[1:], 1)), x[0] * F.col(f"{pre}b0")) - n_sigma * F.col(f"{pre}sigma")


def fold_drop(df: DataFrame, dropped: Column, name: str, *, value: str = "sst", valid: str = "valid", mask: bool = True) -> DataFrame:
    """A drop folded into the running result: ``<value>_clean`` and ``<valid>_clean`` (seeded from the raw columns once) and the
    flag column ``name`` (0 or 1). A comparison with a missing value drops nothing."""
    drop = flag(dropped)
    seed = {c: F.col(f"{c}_clean") if f"{c}_clean" in df.columns else F.col(c) for c in (value, valid)}
    out = {name: drop.cast("int"), f"{valid}_clean": flag(seed[valid]) & ~drop}
    out[f"{value}_clean"] = F.when(~drop, seed[value]) if mask else seed[value]
    return df.withColumns(out)


def offset_filter(df: DataFrame, *, baseline: str = "baseline", threshold: float = 5.0, cloud: str | None = None, value: str = "sst") -> DataFrame:
    """Drop pixels colder than the baseline by more than the threshold (0 or less: none), or flagged in a cloud layer."""
    drop = F.col(baseline) - F.col(value) > threshold if threshold > 0 else F.lit(False)
    return fold_drop(df, flag(drop) | flag(F.col(cloud) > 0) if cloud else drop, "cold_flag", value=value)


def sigma_filter(df: DataFrame, fit: DataFrame, *, keys: list[str], n_sigma: float = 3.0, day: str = "day", harmonic: bool = False, value: str = "sst") -> DataFrame:
    """Drop pixels below the cutoff of their group's baseline fit; groups without a fit drop none."""
    betas = [c for c in fit.columns if c in ("b0", "b1", "b2", "sigma")]
    j = df.join(fit.select(*keys, *betas), keys, "left") if keys else beside(df, fit.select(*betas))
    return fold_drop(j, F.col(value) < cutoff(n_sigma, F.col(day), harmonic), "sigma_flag", value=value).drop(*betas)


def scene_cover(df: DataFrame, *, pct: str, water: str | None, keys: tuple[str, ...] = ("day",)) -> DataFrame:
    """``*keys, scene_cloud_pct``: mean cloud over water, over all cells where no cell of the scene is water or there is no mask."""
    on_water = F.col(water) > 0 if water else F.lit(True)
    mean = df.groupBy(*keys).agg(F.avg(F.when(flag(on_water), F.col(pct))).alias("_w"), F.avg(pct).alias("_a"), F.max(flag(on_water)).alias("_any"))
    return mean.select(*keys, F.when(F.col("_any"), F.col("_w")).otherwise(F.col("_a")).alias("scene_cloud_pct"))


def cover_gate(df: DataFrame, *, pct: str = "cloud_pct", scene_max: float | None = 30.0, pixel_max: float | None = 80.0, water: str | None = "water", keys: tuple[str, ...] = ("day",), value: str = "sst") -> DataFrame:
    """Drop whole scenes whose mean cloud over water (over all cells where no cell of the scene is water) is above ``scene_max``, and
    pixels above ``pixel_max``; None or 100 and more disables a gate. Emits ``scene_cloud_pct``.

    The scene mean is a small aggregate that is joined back, not a window over whole scenes.
    """
    mean = scene_cover(df, pct=pct, water=water, keys=keys)
    off = lambda g: g is None or g >= 100
    scene = F.lit(False) if off(scene_max) else flag(F.col("scene_cloud_pct") > scene_max)
    pixel = F.lit(False) if off(pixel_max) else flag(F.col(pct) > pixel_max)
    return fold_drop(df.join(mean, list(keys), "left"), scene | pixel, "cover_flag", value=value)


def land_cloud_filter(df: DataFrame, *, air: str = "airtemp", water: str = "water", threshold: float = 5.0, value: str = "sst") -> DataFrame:
    """Drop land pixels (a missing land cover is water) colder than the air by more than the threshold."""
    land = F.coalesce(F.col(water), F.lit(1)) < 0.5
    return fold_drop(df, land & (F.col(air) - F.col(value) > threshold), "land_cloud_flag", value=value)


def water_line(df: DataFrame, *, elevation: str = "elevation", tide: str = "tide", datum_offset_m: float = 0.0) -> DataFrame:
    """``water_elev`` (elevation less datum offset less tide) and ``water_class``: 1 exposed (above 0), 0 submerged, 255 unknown."""
    e = F.col(elevation) - datum_offset_m - F.col(tide)
    return df.withColumns({"water_elev": e, "water_class": F.when(e.isNull(), 255).when(e > 0, 1).otherwise(0)})
