"""Image steps on one scene, in NumPy: distance transform, edges, search for a shift."""

from __future__ import annotations

import numpy as np


def nearest_true(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Squared distance to, row and column of the nearest True cell; ties go to the smaller row, then column. Infinite without any.

    Two passes, along columns then along rows, each the exact minimum over the line's parabolas."""
    h, w = mask.shape
    far = 4.0 * (h * h + w * w)  # beyond any distance on the grid
    if not mask.any():
        return np.full((h, w), np.inf), np.full((h, w), -1), np.full((h, w), -1)
    # along a column: the nearest True row, the smaller on ties
    rows = np.arange(h)[:, None]
    up = np.maximum.accumulate(np.where(mask, rows, -(10**9)), axis=0)
    down = np.minimum.accumulate(np.where(mask, rows, 10**9)[::-1], axis=0)[::-1]
    near = np.where(rows - up <= down - rows, up, down)
    g = np.where((near >= 0) & (near < h), (rows - near).astype(float) ** 2, far)
    dist, col = np.empty((h, w)), np.empty((h, w), int)
    x = np.arange(w)
    cost = (x[:, None] - x[None, :]).astype(float) ** 2
    for r in range(h):
        d = g[r][None, :] + cost
        best = d.min(1)
        # of equal distances the smaller row, then the smaller column
        rank = np.where(d == best[:, None], near[r][None, :] * (w + 1) + x[None, :], 10**12)
        dist[r], col[r] = best, rank.argmin(1)
    return dist, near[rows, col], col


def smooth(a: np.ndarray, sigma: float) -> np.ndarray:
    """Gaussian smoothing over the finite cells (normalised convolution); NaN where too little weight is finite."""
    reach = int(4 * sigma + 0.5)
    k = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    k /= k.sum()

    def blur(z: np.ndarray) -> np.ndarray:
        for axis in (0, 1):
            pad = [(reach, reach) if i == axis else (0, 0) for i in (0, 1)]
            p = np.pad(z, pad, mode="edge")
            z = sum(w * np.take(p, np.arange(i, i + z.shape[axis]), axis) for i, w in enumerate(k))
        return z

    ok = np.isfinite(a)
    num, den = blur(np.where(ok, a, 0.0)), blur(ok.astype(float))
    return np.where(den > 1e-3, num / np.maximum(den, 1e-12), np.nan)


def edges(a: np.ndarray, sigma: float = 1.5, low: float = 80.0, high: float = 97.0) -> np.ndarray:
    """Edges of a field: smoothed gradient, thinned along its direction, kept from the low percentile where joined to the high one.

    Cells whose eight neighbours aren't all known (also those at the grid's border) have no gradient, so that the rim of a hole
    is no edge. The two diagonal directions are thinned along each other, as results are to equal those of existing cubes.
    """
    s = smooth(a, sigma)
    known = np.isfinite(s)
    p = np.pad(np.where(known, s, 0.0), 1, mode="edge")
    h, w = a.shape
    near = [(dy, dx) for dy in (-1, 0, 1) for dx in (-1, 0, 1)]

    def at(z: np.ndarray, dy: int, dx: int) -> np.ndarray:
        return z[1 + dy : 1 + dy + h, 1 + dx : 1 + dx + w]

    gx = (at(p, -1, 1) + 2 * at(p, 0, 1) + at(p, 1, 1)) - (at(p, -1, -1) + 2 * at(p, 0, -1) + at(p, 1, -1))
    gy = (at(p, 1, -1) + 2 * at(p, 1, 0) + at(p, 1, 1)) - (at(p, -1, -1) + 2 * at(p, -1, 0) + at(p, -1, 1))
    q = np.pad(known, 1)
    whole = np.all([at(q, dy, dx) for dy, dx in near], axis=0)
    mag = np.where(whole, np.hypot(gx, gy), 0.0)
    sector = (np.round(np.degrees(np.arctan2(gy, gx)) % 180 / 45).astype(int)) % 4
    m = np.pad(mag, 1)
    thin = np.zeros_like(known)
    for k, (dy, dx) in enumerate(((0, 1), (-1, 1), (-1, 0), (-1, -1))):
        thin |= (sector == k) & (mag >= at(m, dy, dx)) & (mag >= at(m, -dy, -dx))
    thin &= whole
    if not thin.any():
        return thin
    lo, hi = np.percentile(mag[thin], [low, high])
    weak, out = thin & (mag >= lo), thin & (mag >= hi)
    while True:  # grow the strong edges into the weak ones next to them
        q = np.pad(out, 1)
        grown = weak & np.any([at(q, dy, dx) for dy, dx in near], axis=0)
        if (grown == out).all():
            return out
        out = grown | out


def shoreline(water: np.ndarray) -> np.ndarray:
    """Water cells next to land (eight neighbours); the grid's edge is not land."""
    q = np.pad(~water, 1)
    h, w = water.shape
    return water & np.any([q[1 + dy : 1 + dy + h, 1 + dx : 1 + dx + w] for dy in (-1, 0, 1) for dx in (-1, 0, 1)], axis=0)


def agreement(ys: np.ndarray, xs: np.ndarray, dist: np.ndarray, dy: int, dx: int, tol: float) -> float:
    """Share of the edge cells that lie nearer to the coast than the tolerance after a shift; those off the grid miss."""
    y, x = ys + dy, xs + dx
    ok = (y >= 0) & (y < dist.shape[0]) & (x >= 0) & (x < dist.shape[1])
    return float((dist[y[ok], x[ok]] < tol).sum()) / ys.size


def best_shift(ys: np.ndarray, xs: np.ndarray, dist: np.ndarray, reach: int, tol: float, stride: int = 4, refine: int = 8) -> dict[str, float]:
    """The shift of best agreement: a coarse search by strides, then every shift within a stride of the best few.

    A later shift has to be better, so ties go to the first coarse one by row and column, then to the refined ones as tried. ``z``
    tells how far the best lies above the median of the coarse surface, in its standard deviations. Without edge cells
    everything but the shift (0, 0) is missing.
    """
    if not ys.size:
        return {"dy": 0, "dx": 0, "agree": np.nan, "agree0": np.nan, "median": np.nan, "z": np.nan}
    steps = range(-reach, reach + 1, stride)
    coarse = [(dy, dx) for dy in steps for dx in steps]
    scores = {c: agreement(ys, xs, dist, *c, tol) for c in coarse}
    surface = np.array(list(scores.values()))
    best = coarse[int(surface.argmax())]
    around = range(-stride, stride + 1)
    for k in np.argsort(surface)[-refine:]:
        for c in ((coarse[k][0] + a, coarse[k][1] + b) for a in around for b in around):
            if c not in scores:
                scores[c] = agreement(ys, xs, dist, *c, tol)
            if scores[c] > scores[best]:
                best = c
    med, sd = float(np.median(surface)), float(surface.std())
    return {"dy": best[0], "dx": best[1], "agree": scores[best], "agree0": agreement(ys, xs, dist, 0, 0, tol), "median": med, "z": (scores[best] - med) / max(sd, 1e-9)}


def shifted(a: np.ndarray, dy: int, dx: int, fill: float = np.nan) -> np.ndarray:
    """Content moved by whole cells without wrapping; vacated cells are filled."""
    out = np.full(a.shape, fill, float)
    h, w = a.shape
    y0, y1, x0, x1 = max(dy, 0), min(h + dy, h), max(dx, 0), min(w + dx, w)
    if y0 < y1 and x0 < x1:
        out[y0:y1, x0:x1] = a[y0 - dy : y1 - dy, x0 - dx : x1 - dx]
    return out
