"""Polygons from WKT into triangles by ear clipping; bounding-volume hierarchies; exact point tests."""

from __future__ import annotations

import math
import re
from collections.abc import Iterable
from dataclasses import dataclass
from fractions import Fraction

import numpy as np

Point = tuple[float, float]
Ring = list[Point]
#: relative error of a 2 x 2 determinant in doubles
ERR = (3 + 16 * 2.0**-53) * 2.0**-53


def parse_wkt(wkt: str | None) -> list[list[Ring]]:
    """The polygons of a POLYGON or MULTIPOLYGON, each a list of rings (outer first), without closing or repeated points.

    NULL, blank and EMPTY give no polygon; any other geometry raises ValueError.
    """
    text = (wkt or "").strip().upper()
    if not text or text.endswith("EMPTY"):
        return []
    if not re.match(r"^(MULTI)?POLYGON\b", text):
        raise ValueError(f"not a polygon: {text[:40]}")
    body = text[text.index("(") :]
    depth_of_ring = 3 if text.startswith("MULTI") else 2
    polygons: list[list[Ring]] = []
    depth, start = 0, 0
    for i, ch in enumerate(body):
        if ch == "(":
            depth += 1
            if depth == depth_of_ring - 1:
                polygons.append([])
            start = i + 1
        elif ch == ")":
            if depth == depth_of_ring:
                points = [tuple(map(float, p.split()[:2])) for p in body[start:i].split(",")]
                ring = [p for k, p in enumerate(points) if p != points[k - 1] or k == 0]
                if len(ring) > 1 and ring[0] == ring[-1]:
                    ring.pop()
                if len(ring) >= 3:
                    polygons[-1].append(ring)
            depth -= 1
    return [p for p in polygons if p]


def orient(a: Point, b: Point, c: Point) -> int:
    """Sign of the turn a, b, c: 1 to the left, exact."""
    left, right = (b[0] - a[0]) * (c[1] - a[1]), (b[1] - a[1]) * (c[0] - a[0])
    det = left - right
    if abs(det) > ERR * (abs(left) + abs(right)):
        return 1 if det > 0 else -1
    (ax, ay), (bx, by), (cx, cy) = (tuple(map(Fraction, p)) for p in (a, b, c))
    det = (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)
    return (det > 0) - (det < 0)


def area2(ring: Ring) -> float:
    """Twice the signed area."""
    x, y = np.array(ring).T
    return float(np.sum(x * np.roll(y, -1) - np.roll(x, -1) * y))


def _crosses(a: Point, b: Point, c: Point, d: Point) -> bool:
    """Whether the segments meet at more than common end points."""
    o1, o2, o3, o4 = orient(a, b, c), orient(a, b, d), orient(c, d, a), orient(c, d, b)
    if o1 * o2 < 0 and o3 * o4 < 0:
        return True
    on = lambda p, q, r: p not in (q, r) and min(q[0], r[0]) <= p[0] <= max(q[0], r[0]) and min(q[1], r[1]) <= p[1] <= max(q[1], r[1])
    return (o1 == 0 and on(c, a, b)) or (o2 == 0 and on(d, a, b)) or (o3 == 0 and on(a, c, d)) or (o4 == 0 and on(b, c, d))


def _inside_corner(before: Point, at: Point, after: Point, to: Point) -> bool:
    """Whether the direction to ``to`` leads into a counter-clockwise ring at the corner ``at``."""
    if orient(before, at, after) > 0:
        return orient(before, at, to) > 0 and orient(at, after, to) > 0
    return not (orient(before, at, to) <= 0 and orient(at, after, to) <= 0)


def _join_holes(outer: Ring, holes: list[Ring]) -> Ring:
    """One ring with each hole cut in through a bridge that crosses no edge."""
    ring = list(outer)
    waiting = sorted(holes, key=lambda h: -max(h)[0])
    while waiting:
        hole = waiting.pop(0)
        ends = [np.array(r) for r in (ring, hole, *waiting)]
        edges = np.concatenate([np.concatenate([np.roll(e, 1, axis=0), e], axis=1) for e in ends])
        lo, hi = np.minimum(edges[:, :2], edges[:, 2:]), np.maximum(edges[:, :2], edges[:, 2:])

        def free(p: Point, h: Point, edges=edges, lo=lo, hi=hi) -> bool:
            """Whether no edge is crossed; only those whose boxes meet the bridge's are looked at."""
            met = np.flatnonzero(np.all((lo <= np.maximum(p, h)) & (hi >= np.minimum(p, h)), axis=1))
            return not any(_crosses(p, h, (x0, y0), (x1, y1)) for x0, y0, x1, y1 in edges[met].tolist())

        bridge = None
        for m in sorted(range(len(hole)), key=lambda k: (-hole[k][0], hole[k][1])):
            h = hole[m]
            for v in np.argsort(((ends[0] - h) ** 2).sum(1), kind="stable").tolist():
                p = ring[v]
                if p == h or (_inside_corner(ring[v - 1], p, ring[(v + 1) % len(ring)], h) and free(p, h)):
                    bridge = v, m
                    break
            if bridge:
                break
        if bridge is None:
            raise ValueError("a hole can't be joined to its ring")
        v, m = bridge
        ring = ring[: v + 1] + hole[m:] + hole[: m + 1] + ring[v:]
    return ring


def _clip(p: Ring) -> list[tuple[Point, Point, Point]]:
    """Triangles of a counter-clockwise ring by ear clipping. A corner is an ear if no corner that isn't convex lies in its
    triangle; these corners are kept in square cells, so only those about the triangle are looked at."""
    n = len(p)
    before, after = [i - 1 for i in range(n)], [(i + 1) % n for i in range(n)]
    before[0] = n - 1
    corner = np.array(p)
    west, south = corner.min(0)
    size = float(np.ptp(corner, axis=0).max()) / max(1, math.isqrt(n)) or 1.0
    turn = [orient(p[before[i]], p[i], p[after[i]]) for i in range(n)]
    hollow = {i for i in range(n) if turn[i] <= 0}
    cells: dict[tuple[int, int], set[int]] = {}
    where = [(int((x - west) / size), int((y - south) / size)) for x, y in p]
    for i in hollow:
        cells.setdefault(where[i], set()).add(i)

    def about(i: int, j: int, k: int) -> Iterable[int]:
        (x0, y0), (x1, y1), (x2, y2) = where[i], where[j], where[k]
        columns, rows = range(min(x0, x1, x2), max(x0, x1, x2) + 1), range(min(y0, y1, y2), max(y0, y1, y2) + 1)
        if len(columns) * len(rows) > len(hollow):
            return hollow
        return (q for x in columns for y in rows for q in cells.get((x, y), ()))

    def holds(a: Point, b: Point, c: Point, s: Point) -> bool:
        return s not in (a, b, c) and orient(a, b, s) >= 0 and orient(b, c, s) >= 0 and orient(c, a, s) >= 0

    out = []
    j, left, idle = 0, n, 0
    while left > 3:
        i, k = before[j], after[j]
        a, b, c = p[i], p[j], p[k]
        if turn[j] < 0 or turn[j] > 0 and any(holds(a, b, c, p[q]) for q in about(i, j, k)):
            j, idle = k, idle + 1
            if idle > left:
                raise ValueError("the polygon's rings cross each other")
            continue
        if turn[j] > 0:
            out.append((a, b, c))
        for q in (j, i, k):
            if q in hollow:
                hollow.discard(q)
                cells[where[q]].discard(q)
        after[i], before[k] = k, i
        left, idle = left - 1, 0
        for q in (i, k):
            turn[q] = orient(p[before[q]], p[q], p[after[q]])
            if turn[q] <= 0:
                hollow.add(q)
                cells.setdefault(where[q], set()).add(q)
        j = after[k]  # not its neighbour: every other corner goes first, so that triangles stay small while there are many
    a, b, c = p[before[j]], p[j], p[after[j]]
    if orient(a, b, c) > 0:
        out.append((a, b, c))
    return out


def triangulate(polygon: list[Ring]) -> np.ndarray:
    """Triangles (n, 3, 2), counter-clockwise, of a polygon with holes, by ear clipping. Rings may run either way round."""
    outer = polygon[0] if area2(polygon[0]) > 0 else polygon[0][::-1]
    holes = [h if area2(h) < 0 else h[::-1] for h in polygon[1:]]
    want = area2(outer) + sum(map(area2, holes))
    tri = np.array(_clip(_join_holes(outer, holes)), float).reshape(-1, 3, 2)
    got = float(np.sum((tri[:, 1, 0] - tri[:, 0, 0]) * (tri[:, 2, 1] - tri[:, 0, 1]) - (tri[:, 1, 1] - tri[:, 0, 1]) * (tri[:, 2, 0] - tri[:, 0, 0])))
    if abs(got - want) > 1e-9 * max(1.0, abs(want)):
        raise ValueError("the triangles don't cover the polygon")
    return tri


def wrapped(tri: np.ndarray) -> np.ndarray:
    """The triangles and their copies shifted by whole turns, as far as they meet the longitudes -180 to 180."""
    lo, hi = tri[:, :, 0].min(1), tri[:, :, 0].max(1)
    parts = []
    for k in range(int(np.floor((-180 - hi.max()) / 360)), int(np.ceil((180 - lo.min()) / 360)) + 1) if len(tri) else ():
        own = (hi + 360.0 * k >= -180) & (lo + 360.0 * k <= 180)
        if own.any():
            parts.append(tri[own] + np.array([360.0 * k, 0.0]))
    return np.concatenate(parts) if parts else tri[:0]


@dataclass
class Boxes:
    """A bounding-volume hierarchy: nodes' boxes (west, south, east, north), children (-1: leaf), and the items of leaves."""

    box: np.ndarray
    child: np.ndarray
    items: list[np.ndarray]

    @staticmethod
    def build(item_box: np.ndarray, leaf: int = 4) -> Boxes:
        box, child, items = [], [], []

        def add(own: np.ndarray) -> int:
            at = len(box)
            b = item_box[own]
            box.append([b[:, 0].min(), b[:, 1].min(), b[:, 2].max(), b[:, 3].max()])
            child.append([-1, -1])
            items.append(own)
            return at

        todo = [add(np.arange(len(item_box)))] if len(item_box) else []
        mid = (item_box[:, :2] + item_box[:, 2:]) / 2
        while todo:
            at = todo.pop()
            own = items[at]
            if own.size <= leaf:
                continue
            axis = int(np.argmax(np.ptp(mid[own], axis=0)))
            order = own[np.argsort(mid[own, axis], kind="stable")]
            child[at] = [add(order[: own.size // 2]), add(order[own.size // 2 :])]
            items[at] = own[:0]
            todo += child[at]
        return Boxes(np.array(box, float).reshape(-1, 4), np.array(child, np.int64).reshape(-1, 2), items)

    def meet(self, x: np.ndarray, y: np.ndarray):
        """(points, items) of each leaf whose box holds points; both as index arrays."""
        todo = [(0, np.arange(x.size))] if len(self.box) and x.size else []
        while todo:
            at, p = todo.pop()
            w, s, e, n = self.box[at]
            p = p[(x[p] >= w) & (x[p] <= e) & (y[p] >= s) & (y[p] <= n)]
            if not p.size:
                continue
            if self.child[at, 0] < 0:
                yield p, self.items[at]
            else:
                todo += [(c, p) for c in self.child[at]]


def tri_boxes(tri: np.ndarray) -> np.ndarray:
    return np.concatenate([tri.min(1), tri.max(1)], axis=1) if len(tri) else np.empty((0, 4))


def in_triangle(tri: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which points lie in a counter-clockwise triangle, its edges included; exact."""
    ok = np.ones(x.size, bool)
    for k in range(3):
        (ax, ay), (bx, by) = tri[k], tri[(k + 1) % 3]
        left, right = (bx - ax) * (y - ay), (by - ay) * (x - ax)
        det = left - right
        side = det >= 0
        for i in np.flatnonzero(ok & (np.abs(det) <= ERR * (np.abs(left) + np.abs(right)))):
            side[i] = orient((ax, ay), (bx, by), (float(x[i]), float(y[i]))) >= 0
        ok &= side
    return ok


def containing(tree: Boxes, tri: np.ndarray, region: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(points, regions) such that the point lies in a triangle of the region; each pair once, also on shared edges."""
    points, regions = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for p, items in tree.meet(x, y):
        for t in items:
            hit = p[in_triangle(tri[t], x[p], y[p])]
            points.append(hit)
            regions.append(np.full(hit.size, region[t]))
    pairs = np.unique(np.stack([np.concatenate(points), np.concatenate(regions)], axis=1), axis=0)
    return pairs[:, 0], pairs[:, 1]
