"""Values of cells around points, with explicit rules for missing values."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skerry.functions.geo import Grid
from skerry.functions.values import PERCENTILE, statistic

EDGE_M = 1e-6


def disc_cells(points: DataFrame, grid: Grid, radius_m: float, *, mask: DataFrame | None = None) -> DataFrame:
    """``point_id, row, col, home, clipped``: the cells in a disc round each point (``point_id, x, y``).

    The disc is centred on the exact point, its edge included (within a micrometre), over the cells at most
    floor(radius / resolution) rows and columns from the containing cell, which is always in. Points outside the grid have no
    cells; ``clipped`` tells that part of the box lies outside it. A mask (``row, col, mask``) keeps cells above 0 and also
    drops the containing cell; cells without a mask value are out.
    """
    reach = math.floor(radius_m / grid.res)
    row, col = grid.cell(F.col("x"), F.col("y"))
    p = points.withColumns({"r0": row, "c0": col}).where(grid.inside(F.col("r0"), F.col("c0")))
    p = p.withColumn("clipped", (F.col("r0") < reach) | (F.col("c0") < reach) | (F.col("r0") >= grid.height - reach) | (F.col("c0") >= grid.width - reach))
    steps = F.sequence(F.lit(-reach), F.lit(reach))
    p = p.withColumn("dr", F.explode(steps)).withColumn("dc", F.explode(steps))
    p = p.withColumns({"row": F.col("r0") + F.col("dr"), "col": F.col("c0") + F.col("dc")}).where(grid.inside(F.col("row"), F.col("col")))
    cx, cy = grid.centre(F.col("row"), F.col("col"))
    home = (F.col("dr") == 0) & (F.col("dc") == 0)
    near = F.pow(cx - F.col("x"), 2) + F.pow(cy - F.col("y"), 2) <= (radius_m + EDGE_M) ** 2
    p = p.where(near | home).select("point_id", "row", "col", home.alias("home"), "clipped")
    if mask is not None:
        p = p.join(mask.where(F.col("mask") > 0).select("row", "col"), ["row", "col"], "left_semi")
    return p


def extract(points: DataFrame, cube: DataFrame, grid: Grid, *, radius_m: float, stats: list[str], mask: DataFrame | None = None, keys: tuple[str, ...] = ("day",), value: str = "value") -> DataFrame:
    """Long table ``point_id, *keys, stat, radius_m, value`` of a channel (``*keys, row, col, value``) round points.

    ``nearest`` is the value of the containing cell, whatever the mask and the radius (its radius_m is 0); the other statistics
    are those of :func:`statistic` over the cells of the disc. A cell without a row in the cube counts as missing. A point has a
    row for each key at which the cube has a row for any cell of its disc; an assembled cube is dense, so that is every day.
    """
    near, names = "nearest" in stats, [s for s in stats if s != "nearest"]
    cells = disc_cells(points, grid, radius_m if names else 0.0)
    if mask is None:
        cells = cells.withColumn("_in", F.lit(True))
    else:
        cells = cells.join(mask.where(F.col("mask") > 0).select("row", "col", F.lit(True).alias("_in")), ["row", "col"], "left").withColumn("_in", F.coalesce("_in", F.lit(False)))
    if not (near and names):
        cells = cells.where("home" if near else "_in")
    # the size of a disc is known without the cube: cells without a row are missing values
    size = cells.where("_in").groupBy("point_id").agg(F.count("*").alias("_cells"))
    cells = cells.where(F.col("home") | F.col("_in")).select("point_id", "row", "col", "home", "_in").join(size, "point_id", "left")
    have = cells.join(cube.select(*keys, "row", "col", F.col(value).alias("_v")), ["row", "col"])
    by = ["point_id", *keys]
    v = F.when(F.col("_in"), F.col("_v"))
    # all percentiles of one disc come from one buffer of its values
    shares = {s: 0.5 if s in ("median", "nanmedian") else float(s[1:]) / 100 for s in names if s in ("median", "nanmedian") or PERCENTILE.match(s)}
    made = [statistic(s, v, rows=F.max("_cells")).cast("double").alias(f"s{k}") for k, s in enumerate(names) if s not in shares]
    if shares:
        made += [F.percentile(v, F.array(*map(F.lit, sorted(set(shares.values()))))).alias("_p"), F.count(v).alias("_n"), F.max("_cells").alias("_m")]
    agg = have.groupBy(*by).agg(F.max("_in").alias("_any"), F.max("home").alias("_home"), F.max(F.when(F.col("home"), F.col("_v"))).alias("_at"), *made)
    order = sorted(set(shares.values()))
    of = {s: F.col("_p")[order.index(p)] for s, p in shares.items()}
    if "median" in of:
        of["median"] = F.when(F.col("_n") == F.col("_m"), of["median"])
    cols = [F.struct(F.lit(s).alias("stat"), F.lit(float(radius_m)).alias("radius_m"), (of[s] if s in of else F.col(f"s{k}")).cast("double").alias("value")) for k, s in enumerate(names)]
    disc = F.when(F.col("_any"), F.array(*cols)) if cols else None
    home = F.when(F.col("_home"), F.array(F.struct(F.lit("nearest").alias("stat"), F.lit(0.0).alias("radius_m"), F.col("_at").cast("double").alias("value")))) if near else None
    none = F.array().cast("array<struct<stat:string,radius_m:double,value:double>>")
    parts = [F.coalesce(x, none) for x in (disc, home) if x is not None]
    return agg.select(*by, F.explode(F.concat(*parts)).alias("s")).select(*by, "s.stat", "s.radius_m", "s.value")


def edge_points(points: DataFrame, grid: Grid, max_radius_m: float) -> DataFrame:
    """``point_id, free_m, near_edge``: free distance to the grid's edge in whole cells, and whether the radius passes it."""
    row, col = grid.cell(F.col("x"), F.col("y"))
    p = points.withColumns({"row": row, "col": col}).where(grid.inside(F.col("row"), F.col("col")))
    free = F.least("row", "col", grid.height - 1 - F.col("row"), grid.width - 1 - F.col("col")) * grid.res
    return p.select("point_id", free.cast("double").alias("free_m")).withColumn("near_edge", F.col("free_m") < max_radius_m)
