"""Positions: great circles, boxes, UTM by the Krüger series, grids and cells."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0
KM_PER_DEGREE = 111.0
#: WGS 84 semi-major axis and flattening, UTM scale and false easting.
WGS84_A, WGS84_F, UTM_K0, UTM_E0 = 6_378_137.0, 1 / 298.257223563, 0.9996, 500_000.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    dy, dx = F.radians(lat2 - lat1) / 2, F.radians(lon2 - lon1) / 2
    h = F.pow(F.sin(dy), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dx), 2)
    return F.lit(2 * EARTH_KM) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def wrap_lon(lon: Column) -> Column:
    """A longitude in -180 (included) to 180 (excluded)."""
    return F.pmod(lon + 180, F.lit(360.0)) - 180


def bbox(lat: Column, lon: Column, ns_km: Column, ew_km: Column) -> dict[str, Column]:
    """West, south, east, north around a centre; clamped at the poles, longitudes wrapped."""
    dy = ns_km / KM_PER_DEGREE
    dx = ew_km / (F.lit(KM_PER_DEGREE) * F.greatest(F.cos(F.radians(lat)), F.lit(1e-9)))
    return {"west": wrap_lon(lon - dx), "south": F.greatest(lat - dy, F.lit(-90.0)), "east": wrap_lon(lon + dx), "north": F.least(lat + dy, F.lit(90.0))}


def boxes_overlap(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """Whether two (west, south, east, north) boxes overlap; touching edges do not."""
    return (a[0] < b[2]) & (b[0] < a[2]) & (a[1] < b[3]) & (b[1] < a[3])


def utm_zone(lon: Column) -> Column:
    return (F.floor((lon + 180) / 6) + 1).cast("int")


def utm_epsg(lat: Column, lon: Column) -> Column:
    """EPSG code of the UTM zone. A longitude of exactly 180 gives zone 61, as the plain formula does."""
    return F.when(lat >= 0, 32600 + utm_zone(lon)).otherwise(32700 + utm_zone(lon))


def utm_forward(lat: Column, lon: Column, zone: Column, south: Column) -> tuple[Column, Column]:
    """Easting and northing in metres, by the Krüger series to the sixth order in n (sub-millimetre within a zone)."""
    x, y = _utm(lat, lon - (zone * 6 - 183), F)
    return x, F.when(south, F.lit(10_000_000.0)).otherwise(F.lit(0.0)) + y


def utm_point(lat: float, lon: float, epsg: int) -> tuple[float, float]:
    """Easting and northing of one place in a UTM zone given by its EPSG code."""
    x, y = _utm(lat, lon - (epsg % 100 * 6 - 183), math)
    return x, y + (10_000_000.0 if epsg // 100 == 327 else 0.0)


def _utm(lat, lam_deg, fn):
    """Easting and northing north of the equator, of columns (``fn``: Spark's functions) or numbers (``math``)."""
    n = WGS84_F / (2 - WGS84_F)
    a_r = WGS84_A / (1 + n) * (1 + n**2 / 4 + n**4 / 64 + n**6 / 256)
    # coefficients of the series in powers of the third flattening
    alpha = (
        n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180 - 127 * n**5 / 288 + 7891 * n**6 / 37800,
        13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440 + 281 * n**5 / 630 - 1983433 * n**6 / 1935360,
        61 * n**3 / 240 - 103 * n**4 / 140 + 15061 * n**5 / 26880 + 167603 * n**6 / 181440,
        49561 * n**4 / 161280 - 179 * n**5 / 168 + 6601661 * n**6 / 7257600,
        34729 * n**5 / 80640 - 3418889 * n**6 / 1995840,
        212378941 * n**6 / 319334400,
    )
    phi, lam = fn.radians(lat), fn.radians(lam_deg)
    e = math.sqrt(WGS84_F * (2 - WGS84_F))
    t = fn.sinh(fn.atanh(fn.sin(phi)) - e * fn.atanh(e * fn.sin(phi)))
    xi, eta = fn.atan2(t, fn.cos(lam)), fn.atanh(fn.sin(lam) / fn.sqrt(1 + t * t))
    x, y = eta, xi
    for k, c in enumerate(alpha, 1):
        y = y + c * fn.sin(2 * k * xi) * fn.cosh(2 * k * eta)
        x = x + c * fn.cos(2 * k * xi) * fn.sinh(2 * k * eta)
    return UTM_E0 + UTM_K0 * a_r * x, UTM_K0 * a_r * y


@dataclass(frozen=True)
class Grid:
    """A grid of square cells: top-left corner, cell size, rows and columns; y falls with the row."""

    x0: float = 0.0
    y0: float = 0.0
    res: float = 100.0
    height: int = 1
    width: int = 1

    def cell(self, x: Column, y: Column) -> tuple[Column, Column]:
        """Row and column of the cell that holds a point (floor, so that points outside stay outside)."""
        return F.floor((F.lit(self.y0) - y) / self.res).cast("int"), F.floor((x - F.lit(self.x0)) / self.res).cast("int")

    def inside(self, row: Column, col: Column) -> Column:
        return (row >= 0) & (row < self.height) & (col >= 0) & (col < self.width)

    def centre(self, row: Column, col: Column) -> tuple[Column, Column]:
        """x and y of a cell's centre."""
        return F.lit(self.x0) + (col + 0.5) * self.res, F.lit(self.y0) - (row + 0.5) * self.res


def snapped_grid(west: float, south: float, east: float, north: float, res: float) -> Grid:
    """The grid that covers a projected box, its edges moved outward to multiples of the cell size."""
    x0, x1 = math.floor(west / res) * res, math.ceil(east / res) * res
    y0, y1 = math.ceil(north / res) * res, math.floor(south / res) * res
    return Grid(x0, y0, res, round((y0 - y1) / res), round((x1 - x0) / res))


def area_grid(lat: float, box: tuple[float, float, float, float], res: float, *, epsg: int | None = None, snap: bool = True) -> tuple[int, Grid]:
    """EPSG code and grid of an area: its box (west, south, east, north) projected by its corners into the UTM zone of its middle (or
    the one given), the edges moved outward to multiples of the cell size. A box across 180 degrees has no one zone: an error."""
    west, south, east, north = box
    if west > east:
        raise ValueError("the area crosses 180 degrees, so no one UTM zone holds it")
    if epsg is None:
        epsg = (32600 if lat >= 0 else 32700) + math.floor(((west + east) / 2 + 180) / 6) + 1
    if epsg // 100 not in (326, 327):
        raise ValueError(f"not a UTM zone: EPSG {epsg}")
    corners = [utm_point(y, x, epsg) for y in (south, north) for x in (west, east)]
    xs, ys = zip(*corners, strict=True)
    if snap:
        return epsg, snapped_grid(min(xs), min(ys), max(xs), max(ys), res)
    return epsg, Grid(min(xs), max(ys), res, round((max(ys) - min(ys)) / res), round((max(xs) - min(xs)) / res))
