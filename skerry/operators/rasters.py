"""Operators on whole scenes: nearest fill, geolocation check and correction, swaths and latitude-longitude fields onto a grid.

Only the image steps run in Python, one scene at a time: a scene has a fixed number of cells, so a group can't grow with the data.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skerry.functions import images
from skerry.functions.geo import Grid
from skerry.functions.values import flag
from skerry.operators.filters import beside


def dense(pdf: pd.DataFrame, column: str, height: int, width: int) -> np.ndarray:
    out = np.full((height, width), np.nan)
    out[pdf["row"].to_numpy(), pdf["col"].to_numpy()] = pdf[column].to_numpy(float)
    return out


def fill_nearest(field: DataFrame, water: DataFrame, grid: Grid, *, keys: list[str], value: str = "value") -> DataFrame:
    """``*keys, row, col, value, filled``: missing water cells get the value of the nearest finite cell of their scene.

    The source may be any finite cell; of equal distances the smaller row, then column. Scenes without any finite cell, and an
    empty or missing water mask, fill nothing. Cells that remain missing are left out.
    """
    height, width = grid.height, grid.width
    f = field.select(*keys, "row", "col", F.col(value).cast("double").alias("value"))
    w = water.where("water > 0").select("row", "col")
    # the cells to fill come as rows without a value, so a scene is complete in its group
    scenes = f.select(*keys).distinct()
    holes = scenes.withColumn("row", F.explode(F.sequence(F.lit(0), F.lit(height - 1)))).withColumn("col", F.explode(F.sequence(F.lit(0), F.lit(width - 1)))).join(w, ["row", "col"], "left_semi")
    both = f.withColumn("want", F.lit(False)).unionByName(holes.withColumns({"value": F.lit(None).cast("double"), "want": F.lit(True)}))
    schema = f.select(*keys, "row", "col", "value").schema.add("filled", "boolean")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        have = pdf[~pdf["want"] & pdf["value"].notna()]
        a = dense(have, "value", height, width)
        known = np.isfinite(a)
        want = np.zeros_like(known)
        own = pdf[pdf["want"]]
        want[own["row"], own["col"]] = True
        _, r, c = images.nearest_true(known)
        gaps = want & ~known & (r >= 0)
        a[gaps] = a[r[gaps], c[gaps]]
        y, x = np.nonzero(known | gaps)
        out = pd.DataFrame({k: [pdf[k].iloc[0]] * y.size for k in keys})
        return out.assign(row=y, col=x, value=a[y, x], filled=gaps[y, x])

    return both.groupBy(*keys).applyInPandas(run, schema)


@dataclass(frozen=True)
class GeorefRule:
    """Thresholds of the geolocation check; lengths in metres."""

    tol_m: float = 200.0
    max_shift_m: float = 10_000.0
    stride: int = 4
    refine: int = 8
    min_coast: int = 500
    min_valid_pct: float = 2.0
    min_edges: int = 300
    z_min: float = 4.5
    lift_min: float = 2.5
    gain_min: float = 0.10
    ok_shift_m: float = 300.0
    max_move: int = 2
    sigma: float = 1.5
    low_pct: float = 80.0
    high_pct: float = 97.0
    windows_m: tuple[float, ...] = (5_000.0, 10_000.0, 20_000.0, 30_000.0)


GEOREF = "dy int, dx int, shift_m double, agree double, agree0 double, z double, n_edge long, coast_obs long, valid_frac double, contrast double, stable boolean, verdict string"


def judge_scene(sst: np.ndarray, water: np.ndarray, res: float, rule: GeorefRule) -> dict:
    """The displacement of a scene's edges from the coast, and the verdict.

    ``insufficient_signal`` without enough coast cells under data, valid cells or edges; then, in this order, ``unstable`` (in some search
    window the peak lies elsewhere), ``unrecoverable`` (no lift above the surface), ``ok`` (a small shift that stands out), ``displaced``
    (one that stands out, with a clear gain), ``suspect``. The contrast of land and water decides nothing.
    """
    coast = images.shoreline(water)
    ok = np.isfinite(sst)
    land, sea = sst[ok & ~water], sst[ok & water]
    out = {"coast_obs": int((ok & coast).sum()), "valid_frac": float(ok.mean()), "dy": 0, "dx": 0, "shift_m": 0.0, "agree": None, "agree0": None, "z": None, "stable": None}
    out["contrast"] = abs(float(land.mean()) - float(sea.mean())) if land.size and sea.size else None
    ys, xs = np.nonzero(images.edges(sst, rule.sigma, rule.low_pct, rule.high_pct)) if ok.any() else (np.empty(0, int), np.empty(0, int))
    out["n_edge"] = int(ys.size)
    if out["coast_obs"] < rule.min_coast or 100 * out["valid_frac"] < rule.min_valid_pct or ys.size < rule.min_edges:
        return out | {"verdict": "insufficient_signal"}
    dist = np.sqrt(images.nearest_true(coast)[0])

    def peak(reach_m: float) -> dict[str, float]:
        return images.best_shift(ys, xs, dist, round(reach_m / res), rule.tol_m / res, rule.stride, rule.refine)

    best = peak(rule.max_shift_m)
    others = (peak(w) for w in rule.windows_m if round(w / res) > 0)
    stable = all(max(abs(p["dy"] - best["dy"]), abs(p["dx"] - best["dx"])) <= rule.max_move for p in others)
    shift = math.hypot(best["dy"], best["dx"]) * res
    stands_out = best["z"] >= rule.z_min
    if not stable:
        verdict = "unstable"
    elif not best["agree"] >= rule.lift_min * best["median"]:
        verdict = "unrecoverable"
    elif stands_out and shift <= rule.ok_shift_m:
        verdict = "ok"
    elif stands_out and best["agree"] - best["agree0"] >= rule.gain_min:
        verdict = "displaced"
    else:
        verdict = "suspect"
    return out | {k: best[k] for k in ("dy", "dx", "agree", "agree0", "z")} | {"shift_m": shift, "stable": stable, "verdict": verdict}


def check_georeference(scenes: DataFrame, water: DataFrame, grid: Grid, rule: GeorefRule = GeorefRule(), *, keys: list[str], value: str = "sst") -> DataFrame:
    """One row a scene with the shift that puts it on the coast and the verdict of :func:`judge_scene`; dy and dx in cells.

    A cell of the water mask (``row, col, water``) is water above a half; a missing cell is water. With a mask of one class only
    there is no coast, so every scene has ``insufficient_signal``."""
    mask = np.ones((grid.height, grid.width), bool)
    # at most one row a cell of the grid: its size is fixed by the configuration
    land = water.where("water <= 0.5").where(grid.inside(F.col("row"), F.col("col"))).select("row", "col").distinct().toPandas()
    mask[land["row"], land["col"]] = False
    height, width, res = grid.height, grid.width, grid.res
    s = scenes.select(*keys, "row", "col", F.col(value).cast("double").alias("v"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in s.select(*keys).schema.fields) + ", " + GEOREF
    names = [c.split()[0] for c in GEOREF.split(", ")]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        got = judge_scene(dense(pdf, "v", height, width), mask, res, rule)
        return pd.DataFrame([{**{k: pdf[k].iloc[0] for k in keys}, **{n: got[n] for n in names}}])

    return s.groupBy(*keys).applyInPandas(run, schema)


def correct_georeference(scenes: DataFrame, verdicts: DataFrame, grid: Grid, *, keys: list[str], fills: dict[str, float | None]) -> DataFrame:
    """Scenes with the named fields moved by the shift where the verdict is ``displaced``, else as they are (``<field>_corrected``).

    Content moved off the grid is lost; cells that nothing moved to get the fill (None: missing)."""
    v = verdicts.where("verdict = 'displaced'").select(*keys, "dy", "dx")
    moved = scenes.join(v, keys, "left").fillna(0, ["dy", "dx"])
    moved = moved.select(*keys, (F.col("row") + F.col("dy")).alias("row"), (F.col("col") + F.col("dx")).alias("col"), *(F.col(f).alias(f"{f}_corrected") for f in fills))
    moved = moved.where(grid.inside(F.col("row"), F.col("col"))).withColumn("_here", F.lit(True))
    out = scenes.join(moved, [*keys, "row", "col"], "left")
    for f, fill in fills.items():
        if fill is not None:
            out = out.withColumn(f"{f}_corrected", F.when(F.col("_here"), F.col(f"{f}_corrected")).otherwise(F.lit(fill)))
    return out.drop("_here")


def swath_to_grid(pixels: DataFrame, grid: Grid, radius_m: float, *, keys: list[str], value: str = "value") -> DataFrame:
    """``*keys, row, col, value, pixel``: each cell gets the swath pixel (``pixel, x, y``) nearest to its centre within the radius; of equal
    distances the smaller pixel. A pixel goes to the cells that its radius can reach, so no pairs beyond these are formed."""
    reach = math.ceil(radius_m / grid.res)
    row, col = grid.cell(F.col("x"), F.col("y"))
    steps = F.sequence(F.lit(-reach), F.lit(reach))
    p = pixels.where(F.col(value).isNotNull()).withColumns({"r0": row, "c0": col}).withColumn("dr", F.explode(steps)).withColumn("dc", F.explode(steps))
    p = p.withColumns({"row": F.col("r0") + F.col("dr"), "col": F.col("c0") + F.col("dc")}).where(grid.inside(F.col("row"), F.col("col")))
    cx, cy = grid.centre(F.col("row"), F.col("col"))
    p = p.withColumn("d2", F.pow(cx - F.col("x"), 2) + F.pow(cy - F.col("y"), 2)).where(F.col("d2") <= radius_m**2)
    best = p.groupBy(*keys, "row", "col").agg(F.min(F.struct("d2", "pixel", F.col(value).alias("value"))).alias("b"))
    return best.select(*keys, "row", "col", "b.value", "b.pixel")


def bilinear(targets: DataFrame, field: DataFrame, *, lat0: float, lon0: float, step: float, keys: list[str]) -> DataFrame:
    """``target_id, *keys, value``: bilinear interpolation of a regular field (``*keys, i, j, value`` at lat0 + i step, lon0 + j step) at targets
    (``target_id, lat, lon``); missing where one of the four neighbours that count is missing."""
    y, x = (F.col("lat") - lat0) / step, (F.col("lon") - lon0) / step
    t = targets.select("target_id", F.floor(y).alias("i0"), F.floor(x).alias("j0"), (y - F.floor(y)).alias("fy"), (x - F.floor(x)).alias("fx"))
    corner = F.explode(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (0, 1) for b in (0, 1))))
    t = t.withColumn("q", corner).select("target_id", (F.col("i0") + F.col("q.a")).alias("i"), (F.col("j0") + F.col("q.b")).alias("j"), (F.when(F.col("q.a") == 1, F.col("fy")).otherwise(1 - F.col("fy")) * F.when(F.col("q.b") == 1, F.col("fx")).otherwise(1 - F.col("fx"))).alias("w"))
    need = t.where("w > 0").groupBy("target_id").agg(F.count("*").alias("need"))
    j = t.where("w > 0").join(field.where("value IS NOT NULL"), ["i", "j"]).groupBy("target_id", *keys).agg(F.sum(F.col("w") * F.col("value")).alias("v"), F.count("*").alias("n"))
    return j.join(need, "target_id").select("target_id", *keys, F.when(F.col("n") == F.col("need"), F.col("v")).alias("value"))


def coast_cells(water: DataFrame, grid: Grid) -> DataFrame:
    """``row, col`` of the cells next to land (eight neighbours) that are not land (``row, col, water`` of a half or less); the grid's border is
    no land. Each land cell is sent to its neighbours, so no pairs of cells are formed."""
    land = water.where("water <= 0.5").select("row", "col").distinct()
    steps = F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (-1, 0, 1) for b in (-1, 0, 1) if a or b))
    beside_land = land.withColumn("q", F.explode(steps)).select((F.col("row") + F.col("q.a")).alias("row"), (F.col("col") + F.col("q.b")).alias("col"))
    return beside_land.where(grid.inside(F.col("row"), F.col("col"))).distinct().join(land, ["row", "col"], "left_anti")


def scene_quality(scenes: DataFrame, water: DataFrame, grid: Grid, *, keys: list[str], value: str = "sst") -> DataFrame:
    """``*keys, valid_frac, coast_obs, coast_obs_frac, contrast``: share of the grid's cells with a value, coast cells under a value and
    their share of all coast cells, and the absolute difference of the means over land and over water (missing without both)."""
    coast = coast_cells(water, grid).withColumn("_coast", F.lit(True))
    total = coast.agg(F.count("*").alias("_n"))
    land = water.where("water <= 0.5").select("row", "col", F.lit(True).alias("_land")).distinct()
    j = scenes.join(land, ["row", "col"], "left").join(coast, ["row", "col"], "left").withColumn("_v", F.when(~F.isnan(value), F.col(value)))
    on_water = F.col("_land").isNull()
    g = j.groupBy(*keys).agg(
        (F.count("_v") / (grid.height * grid.width)).alias("valid_frac"),
        F.count(F.when(F.col("_coast"), F.col("_v"))).alias("coast_obs"),
        F.abs(F.avg(F.when(~on_water, F.col("_v"))) - F.avg(F.when(on_water, F.col("_v")))).alias("contrast"),
    )
    return beside(g, total).select(*keys, "valid_frac", "coast_obs", (F.col("coast_obs") / F.greatest(F.col("_n"), F.lit(1))).alias("coast_obs_frac"), "contrast")
