"""Neighbouring points and containing regions against brute force."""

import math
import random

import numpy as np
import pytest

from skerry.functions import triangles as T
from skerry.operators.places import containing_regions, near_or_inside, near_pairs, positions

SITES = "id string, lat double, lon double, kind string, cell string, a int"


def metres(p, q):
    (y1, x1), (y2, x2) = (tuple(map(math.radians, v)) for v in (p, q))
    h = math.sin((y2 - y1) / 2) ** 2 + math.cos(y1) * math.cos(y2) * math.sin((x2 - x1) / 2) ** 2
    return 2 * 6_371_000 * math.asin(min(1.0, math.sqrt(h)))


def test_near_everywhere_on_the_globe(spark, rows):
    rnd = random.Random(2)
    pts = []
    for y0, x0 in ((0, 0), (45, 179.9995), (45, -180), (-60.2, 10), (89.9995, 30), (-89.9999, -20), (90, 0), (51.5, 359.9)):
        for _ in range(40):
            y = max(-90.0, min(90.0, y0 + rnd.uniform(-0.004, 0.004)))
            x = x0 + rnd.uniform(-0.006, 0.006) / max(math.cos(math.radians(y)), 1e-4)
            pts.append((y, (x + 180) % 360 - 180))
    data = [(f"p{i:04d}", y, x, "k", "c", 1) for i, (y, x) in enumerate(pts)]
    near = near_pairs(positions(spark.createDataFrame(data, SITES)), 250.0)
    want = [(data[i][0], data[j][0]) for i in range(len(pts)) for j in range(i + 1, len(pts)) if metres(pts[i], pts[j]) <= 250]
    assert rows(near, "a", "b") == sorted(want)
    assert len(want) > 200


def star(cx, cy, n, r0, r1, rnd):
    radii = [rnd.uniform(r0, r1) for _ in range(n)]
    return [(cx + r * math.cos(2 * math.pi * k / n), cy + r * math.sin(2 * math.pi * k / n)) for k, r in enumerate(radii)]


def wkt(polygon):
    ring = lambda r: "(" + ", ".join(f"{x!r} {y!r}" for x, y in [*r, r[0]]) + ")"
    return "(" + ", ".join(map(ring, polygon)) + ")"


def inside(polygon, x, y):
    odd = False
    for r in polygon:
        for (ax, ay), (bx, by) in zip(r, r[1:] + r[:1], strict=True):
            if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
                odd = not odd
    return odd


def regions(rnd):
    out = {}
    for k in range(6):
        cx, cy = rnd.uniform(-20, 20), rnd.uniform(-20, 20)
        p = [star(cx, cy, 24, 4, 8, rnd), star(cx, cy, 9, 0.5, 1.0, rnd), star(cx + 2.2, cy, 7, 0.3, 0.8, rnd)]
        out[f"r{k}"] = [[r[:: rnd.choice([1, -1])] for r in p]]
    out["two"] = [[star(30, 30, 12, 2, 4, rnd)], [star(45, 30, 12, 2, 4, rnd)]]
    out["line"] = [[star(180, 10, 16, 2, 4, rnd)]]
    out["west"] = [[star(-181, -10, 16, 2, 4, rnd)]]
    out["far"] = [[star(365, 0, 16, 2, 4, rnd)]]
    return out


@pytest.mark.parametrize("small", [100_000, 10])
def test_containing_regions_both_ways(spark, rows, small):
    rnd = random.Random(9)
    reg = regions(rnd)
    frame = spark.createDataFrame([(n, ("MULTIPOLYGON (" + ", ".join(map(wkt, p)) + ")") if len(p) > 1 else "POLYGON " + wkt(p[0])) for n, p in reg.items()] + [("none", None), (None, "POLYGON ((0 0, 1 0, 1 1, 0 0))"), ("empty", "POLYGON EMPTY")], "aoi string, wkt string")
    pts = [(f"p{i}", rnd.uniform(-35, 40), rnd.choice([rnd.uniform(-30, 50), rnd.uniform(174, 186), rnd.uniform(-186, -174)])) for i in range(1500)]
    pts = [(i, y, (x + 180) % 360 - 180) for i, y, x in pts]
    got = containing_regions(spark.createDataFrame(pts, "id string, lat double, lon double"), frame, small=small, per_block=40, per_task=100)
    want = sorted({(i, n) for i, y, x in pts for n, polygons in reg.items() for p in polygons for k in (-720, -360, 0, 360) if inside(p, x + k, y)})
    assert rows(got) == want
    assert len(want) > 100


def test_points_on_inner_edges_belong_once(spark, rows):
    square = spark.createDataFrame([("s", "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0))")], "aoi string, wkt string")
    pts = [(f"{k}", v, v) for k, v in enumerate((0.5, 1.0, 2.0, 3.0, 3.7))] + [("x", 1.0, 3.0), ("y", 3.0, 1.0), ("out", 5.0, 5.0)]
    got = rows(containing_regions(spark.createDataFrame(pts, "id string, lat double, lon double"), square))
    assert got == sorted((p[0], "s") for p in pts[:-1])


def test_triangles_cover_polygons():
    rnd = random.Random(4)
    for _ in range(150):
        p = [star(0, 0, rnd.randint(5, 40), 3, 8, rnd)]
        for k in range(rnd.randint(0, 3)):
            p.append(star(1.2 * math.cos(2.1 * k), 1.2 * math.sin(2.1 * k), 6, 0.2, 0.5, rnd))
        T.triangulate(p)  # checks the area itself
    tri = T.triangulate(T.parse_wkt("POLYGON ((0 0, 2 0, 4 0, 4 4, 4 4, 0 4, 0 2, 0 0), (1 1, 1 2, 2 2, 2 1, 1 1))")[0])
    assert len(tri) >= 8
    with pytest.raises(ValueError):
        T.parse_wkt("LINESTRING (0 0, 1 1)")


def test_orientation_is_exact():
    a, b = (0.1, 0.1), (0.3, 0.3)
    assert T.orient(a, b, (0.2, 0.2)) == T.orient(b, (0.2, 0.2), a)
    assert T.orient((0.0, 0.0), (1e16, 1e16), (1.0, np.nextafter(1.0, 2))) == 1


def test_sites_of_any_kind(spark, rows):
    nan = float("nan")
    sites = [("b", 10.0, 370.0), ("a", 10.0, 10.0), ("c", 10.001, -350.0), ("c", 10.001, 10.0), ("a", 10.0, 10.0), ("a", None, 10.0), ("d", nan, 10.0), ("e", 10.0, None), ("f", 91.0, 10.0), (None, 10.0, 10.0), ("g", 10.0, 359.9999), ("h", 10.0, -0.0002), ("i", 10.0, 180.0), ("j", 10.0, -180.0)]
    df = spark.createDataFrame([(*s, "k", "c", 1) for s in sites], SITES)
    area = spark.createDataFrame([("box", "POLYGON ((9 9, 11 9, 11 11, 9 11, 9 9))", "x")], "aoi string, wkt string, id string")
    assert rows(near_or_inside(df, area)) == [("inside", "a", "box"), ("inside", "c", "box"), ("near", "a", "c"), ("near", "g", "h"), ("near", "i", "j")]
    assert near_or_inside(df.limit(0), area).count() == 0
    assert rows(near_or_inside(df, area.limit(0))) == [("near", "a", "c"), ("near", "g", "h"), ("near", "i", "j")]
