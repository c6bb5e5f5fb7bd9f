"""Points near other points, and the regions that contain points."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skerry.functions import triangles as T
from skerry.runtime import cut

EARTH_M = 6_371_000.0
TRIANGLE = "region string, " + ", ".join(f"{c}{k} double" for k in range(3) for c in "xy")
CORNERS = [f"{c}{k}" for k in range(3) for c in "xy"]


def positions(sites: DataFrame, *, ident: str = "id", lat: str = "lat", lon: str = "lon") -> DataFrame:
    """``id, lat, lon`` of each id with a position, once; longitudes in -180..180 (180 itself becomes -180).

    Usable are a latitude within -90..90 and a longitude within -180..360, neither NULL nor NaN. Of rows of one id that
    disagree the least latitude counts, then the least longitude. Rows with a NULL id are dropped.
    """
    y, x = F.col(lat).cast("double"), F.col(lon).cast("double")
    r = sites.select(F.col(ident).cast("string").alias("id"), y.alias("lat"), F.when(x >= 180, x - 360).otherwise(x).alias("lon"), x.alias("raw"))
    r = r.where(F.col("id").isNotNull() & F.col("lat").between(-90, 90) & F.col("raw").between(-180, 360))  # NaN is above all
    best = r.groupBy("id").agg(F.min(F.struct("lat", "lon")).alias("p"))
    return best.select("id", F.col("p.lat").alias("lat"), F.col("p.lon").alias("lon"))


def great_circle_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Haversine distance in metres on a sphere of radius 6371.0 km."""
    dy, dx = F.radians(lat2 - lat1) / 2, F.radians(lon2 - lon1) / 2
    h = F.pow(F.sin(dy), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dx), 2)
    return F.lit(2 * EARTH_M) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def _columns_of(band: Column, height: float) -> Column:
    """Number of cells round the globe in a band of latitude; about as wide as high."""
    middle = F.radians((band + 0.5) * height - 90)
    return F.greatest(F.lit(1), F.floor(F.lit(360 / height) * F.greatest(F.cos(middle), F.lit(0.0)))).cast("long")


def near_pairs(points: DataFrame, radius_m: float) -> DataFrame:
    """``a, b, metres`` of all pairs of points (``id, lat, lon``, ids once) at most ``radius_m`` apart; a < b.

    Each point has one home cell on a grid twice the radius high; it also looks into every cell that its circle meets (about
    two on average, across 180 degrees and the poles alike). A pair meets in the home cell of the smaller id only, so
    the join is on one key, needs no distinct, and adaptive execution may split a hot cell's partition. Cells are so small that
    the pairs compared in one are a small multiple of those found.
    """
    reach = math.degrees(radius_m / EARTH_M) * (1 + 1e-9) + 1e-9
    height = 2 * reach
    band = F.floor((F.col("lat") + 90) / height)
    cell = lambda b, c: b * F.lit(1 << 32) + c
    turn = (F.col("lon") + 180) / 360
    home = points.withColumn("band", band).withColumn("n", _columns_of(F.col("band"), height))
    home = home.select("id", "lat", "lon", cell(F.col("band"), F.least(F.floor(turn * F.col("n")), F.col("n") - 1)).alias("cell"))

    looks = points.withColumn("band", F.explode(F.sequence(F.floor((F.col("lat") - reach + 90) / height), F.floor((F.col("lat") + reach + 90) / height))))
    looks = looks.withColumn("n", _columns_of(F.col("band"), height))
    polar = F.abs("lat") + reach >= 90
    dlon = F.degrees(F.asin(F.least(F.lit(math.sin(math.radians(reach))) / F.cos(F.radians("lat")), F.lit(1.0)))) + 1e-9
    lo = F.when(polar, F.lit(0)).otherwise(F.floor((turn - dlon / 360) * F.col("n"))).cast("long")
    hi = F.when(polar, F.col("n") - 1).otherwise(F.floor((turn + dlon / 360) * F.col("n"))).cast("long")
    hi = F.least(hi, lo + F.col("n") - 1)
    looks = looks.withColumn("c", F.explode(F.sequence(lo, hi))).select(F.col("id").alias("id2"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"), cell(F.col("band"), F.pmod("c", "n")).alias("cell"))
    near = (F.abs(F.col("lat") - F.col("lat2")) <= reach) & (F.col("id") < F.col("id2"))
    pairs = home.join(looks, (home["cell"] == looks["cell"]) & near)
    d = great_circle_m(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2"))
    return pairs.select(F.col("id").alias("a"), F.col("id2").alias("b"), d.alias("metres")).where(F.col("metres") <= radius_m)


def _triangles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        names, parts = [], []
        for region, wkt in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            try:
                made = [T.wrapped(T.triangulate(polygon)) for polygon in T.parse_wkt(wkt)]
            except ValueError as e:
                raise ValueError(f"region {region!r}: {e}") from e
            for tri in made:
                names += [region] * len(tri)
                parts.append(tri.reshape(-1, 6))
        flat = np.concatenate(parts) if parts else np.empty((0, 6))
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *(pa.array(flat[:, k]) for k in range(6))], names=["region", *CORNERS])


def triangles_of(regions: DataFrame, *, region: str = "aoi", wkt: str = "wkt") -> DataFrame:
    """The triangles of each region's polygons (``region, x0, y0 .. y2``), by ear clipping. NULL regions or areas give none; an
    area that isn't a polygon, or whose rings cross each other, is an error that names the region."""
    return regions.select(F.col(region).cast("string").alias("region"), F.col(wkt).cast("string").alias("wkt")).where("region IS NOT NULL AND wkt IS NOT NULL").mapInArrow(_triangles, TRIANGLE)


def _corners(t: pa.Table) -> np.ndarray:
    return np.stack([t.column(c).to_numpy() for c in CORNERS], axis=1).reshape(-1, 3, 2)


def _locate(tri: np.ndarray, names: list[str]):
    """A map over batches (id, lat, lon) to (id, region)."""
    order = sorted(set(names))
    at = {x: k for k, x in enumerate(order)}
    region = np.array([at[x] for x in names], np.int64)
    tree = T.Boxes.build(T.tri_boxes(tri))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = pa.array(order, pa.string())
        for b in batches:
            p, r = T.containing(tree, tri, region, b.column(2).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(p)), text.take(pa.array(r))], names=["id", "region"])

    return run


def containing_regions(points: DataFrame, regions: DataFrame, *, region: str = "aoi", wkt: str = "wkt", small: int = 100_000, per_block: int = 20_000, per_task: int = 500_000) -> DataFrame:
    """``id, region``: each region that holds a point (``id, lat, lon``; longitudes in -180..180), each pair once.

    Areas are in degrees, holes excluded; those beyond 180 or -180 degrees are met modulo 360. The triangles of the areas go into
    a bounding-volume hierarchy and the triangles in the leaves reached are tested exactly, edges included; a point on an
    edge common to two triangles of a region is assigned once. With at most ``small`` triangles (counted) the hierarchy goes
    to every task and the points are not shuffled. Beyond, the triangles are put in blocks along a space-filling curve, the
    hierarchy of the blocks' boxes (``per_block`` triangles each, so few) sends each point to the blocks it meets, and each
    block has its own hierarchy; a block with many points is spread over several tasks.
    """
    tri = cut(triangles_of(regions, region=region, wkt=wkt))
    count = tri.count()
    pts = points.select("id", "lat", "lon")
    if count <= small:
        t = tri.toArrow()
        return pts.mapInArrow(_locate(_corners(t), t.column("region").to_pylist()), "id string, region string")
    return _by_blocks(pts, tri, -(-count // per_block), per_task)


def _morton(x: Column, y: Column) -> Column:
    """Interleaved bits of 16-bit cell numbers."""

    def spread(c: Column) -> Column:
        for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
            c = c.bitwiseOR(F.shiftleft(c, shift)).bitwiseAND(F.lit(mask).cast("long"))
        return c

    part = lambda v, lo, size: F.least(F.greatest(F.floor((v - lo) / size * 65536), F.lit(0)), F.lit(65535)).cast("long")
    return spread(part(x, -360, 720)).bitwiseOR(F.shiftleft(spread(part(y, -90, 180)), 1))


def _by_blocks(points: DataFrame, tri: DataFrame, blocks: int, per_task: int) -> DataFrame:
    middle = [(F.col(f"{c}0") + F.col(f"{c}1") + F.col(f"{c}2")) / 3 for c in "xy"]
    tri = cut(tri.repartitionByRange(blocks, _morton(*middle)).withColumn("block", F.spark_partition_id()))
    lo, hi = (lambda c: F.least(*(F.col(f"{c}{k}") for k in range(3)))), (lambda c: F.greatest(*(F.col(f"{c}{k}") for k in range(3))))
    # one box a block: as many rows as there are blocks
    boxes = tri.groupBy("block").agg(F.min(lo("x")), F.min(lo("y")), F.max(hi("x")), F.max(hi("y"))).orderBy("block").toPandas().to_numpy(float)
    top = T.Boxes.build(boxes[:, 1:])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            y, x = b.column(1).to_numpy(zero_copy_only=False), b.column(2).to_numpy(zero_copy_only=False)
            for p, items in top.meet(x, y):
                for i in items:
                    w, s, e, n = boxes[i, 1:]
                    own = p[(x[p] >= w) & (x[p] <= e) & (y[p] >= s) & (y[p] <= n)]
                    if own.size:
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(own.size, int(boxes[i, 0]), np.int32)), *(b.column(k).take(pa.array(own)) for k in range(3))], names=["block", "id", "lat", "lon"])

    sent = cut(points.mapInArrow(send, "block int, id string, lat double, lon double"))
    tasks = sent.groupBy("block").agg(F.ceil(F.count("*") / per_task).cast("int").alias("tasks"))
    salted = sent.join(tasks, "block").withColumn("salt", F.pmod(F.xxhash64("id"), "tasks").cast("int")).drop("tasks")
    times = tasks.select((F.col("block") + 0).alias("block"), (F.col("tasks") - 1).alias("last"))
    copies = tri.join(times, "block").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("last")))).drop("last")

    def test(p: pa.Table, t: pa.Table) -> pa.Table:
        out = pa.schema([("id", pa.string()), ("region", pa.string())])
        if not p.num_rows or not t.num_rows:
            return out.empty_table()
        run = _locate(_corners(t), t.column("region").to_pylist())
        return pa.Table.from_batches(run(p.select(["id", "lat", "lon"]).combine_chunks().to_batches()), out)

    found = salted.groupBy("block", "salt").cogroup(copies.groupBy("block", "salt")).applyInArrow(test, "id string, region string")
    return found.distinct()


def near_or_inside(sites: DataFrame, regions: DataFrame, radius_m: float = 250.0, **how) -> DataFrame:
    """``relation, a, b``: pairs of sites near each other (``near``, a < b) and sites within regions (``inside``, site, region)."""
    p = positions(sites)
    near = near_pairs(p, radius_m).select(F.lit("near").alias("relation"), "a", "b")
    inside = containing_regions(p, regions, **how).select(F.lit("inside").alias("relation"), F.col("id").alias("a"), F.col("region").alias("b"))
    return near.unionByName(inside)
