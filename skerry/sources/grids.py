"""Gridded files: NetCDF (classic, 64-bit offsets) a block of days, GeoTIFF a day and channel; written where the data are.

Both formats are written from their published layouts, without other libraries. A block of days, or one day of one channel, has as many
values as the configured grid, so a task's memory is bounded. Files appear under their names when whole.
"""

from __future__ import annotations

import os
import struct
import uuid
from collections.abc import Callable
from datetime import date

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skerry.functions.geo import Grid
from skerry.sources.store import write_table

#: The formats' numbers of types and tags.
NC_TYPES = {"i1": 1, "S1": 2, "i2": 3, "i4": 4, "f4": 5, "f8": 6}
DIMENSION, VARIABLE, ATTRIBUTE = 10, 11, 12
#: How a column is stored: NumPy type and fill value.
ENCODINGS = {"double": ("f4", np.nan), "float": ("f4", np.nan), "int": ("i4", -9999), "bigint": ("i4", -9999), "smallint": ("i2", -9999), "tinyint": ("i1", -128), "boolean": ("i1", -128)}


def encodings(df: DataFrame, keys: tuple[str, ...] = ("day", "row", "col")) -> dict[str, tuple[str, float]]:
    """Type and fill value of each channel of a cube; other column types can't be gridded."""
    kinds = {c: t for c, t in df.dtypes if c not in keys}
    if bad := [c for c, t in kinds.items() if t not in ENCODINGS]:
        raise ValueError(f"can't be gridded: {', '.join(bad)}")
    return {c: ENCODINGS[t] for c, t in kinds.items()}


def _pad(data: bytes) -> bytes:
    return data + b"\0" * (-len(data) % 4)


def _name(text: str) -> bytes:
    raw = text.encode()
    return struct.pack(">i", len(raw)) + _pad(raw)


def _attributes(attrs: dict) -> bytes:
    if not attrs:
        return struct.pack(">ii", 0, 0)
    out = struct.pack(">ii", ATTRIBUTE, len(attrs))
    for k, v in attrs.items():
        if isinstance(v, str):
            raw = v.encode()
            out += _name(k) + struct.pack(">ii", NC_TYPES["S1"], len(raw)) + _pad(raw)
        else:
            a = np.atleast_1d(np.asarray(v))
            a = a.astype(f">{a.dtype.kind}{min(a.dtype.itemsize, 4 if a.dtype.kind == 'i' else 8)}")
            out += _name(k) + struct.pack(">ii", NC_TYPES[a.dtype.str[1:]], a.size) + _pad(a.tobytes())
    return out


def netcdf(dims: dict[str, int], variables: dict[str, tuple[tuple[str, ...], np.ndarray, dict]], attrs: dict) -> bytes:
    """A NetCDF file (classic format, 64-bit offsets) of fixed dimensions."""
    order = list(dims)
    head = b"CDF\2" + struct.pack(">i", 0)
    head += struct.pack(">ii", DIMENSION, len(dims)) + b"".join(_name(d) + struct.pack(">i", n) for d, n in dims.items()) + _attributes(attrs)
    raw = {k: _pad(np.ascontiguousarray(a, f">{a.dtype.str[1:]}").tobytes()) for k, (_, a, _) in variables.items()}
    entries = [(_name(k) + struct.pack(f">i{len(d)}i", len(d), *(order.index(x) for x in d)) + _attributes(at) + struct.pack(">ii", NC_TYPES[a.dtype.str[1:]], len(raw[k])), raw[k]) for k, (d, a, at) in variables.items()]
    at = len(head) + 8 + sum(len(e) + 8 for e, _ in entries)
    out = head + struct.pack(">ii", VARIABLE, len(entries))
    for e, r in entries:
        out += e + struct.pack(">q", at)
        at += len(r)
    return out + b"".join(raw.values())


def geotiff(a: np.ndarray, grid: Grid, epsg: int) -> bytes:
    """A GeoTIFF of one band (floats with NaN where missing, or integers), uncompressed."""
    height, width = a.shape
    a = np.ascontiguousarray(a, a.dtype.newbyteorder("<"))
    kind = {"f": 3, "i": 2, "u": 1}[a.dtype.kind]
    geo = (1, 1, 0, 3, 1024, 0, 1, 1, 1025, 0, 1, 1, 3072, 0, 1, epsg)  # projected, pixel is area, the projection
    tags: list[tuple[int, str, tuple]] = [
        (256, "I", (width,)), (257, "I", (height,)), (258, "H", (8 * a.dtype.itemsize,)), (259, "H", (1,)), (262, "H", (1,)), (273, "I", (0,)), (277, "H", (1,)), (278, "I", (height,)), (279, "I", (a.nbytes,)), (339, "H", (kind,)),
        (33550, "d", (grid.res, grid.res, 0.0)), (33922, "d", (0.0, 0.0, 0.0, grid.x0, grid.y0, 0.0)), (34735, "H", geo),
    ]
    codes, start = {"H": 3, "I": 4, "d": 12}, 8 + 2 + 12 * len(tags) + 4
    extra, entries = b"", b""
    data_at = start + sum(len(v) * struct.calcsize(t) for _, t, v in tags if len(v) * struct.calcsize(t) > 4)
    for tag, t, v in tags:
        v = (data_at,) if tag == 273 else v
        raw = struct.pack(f"<{len(v)}{t}", *v)
        entries += struct.pack("<HHI", tag, codes[t], len(v))
        if len(raw) <= 4:
            entries += raw.ljust(4, b"\0")
        else:
            entries += struct.pack("<I", start + len(extra))
            extra += raw
    return struct.pack("<2sHIH", b"II", 42, 8, len(tags)) + entries + struct.pack("<I", 0) + extra + a.tobytes()


def _put(path: str, data: bytes) -> None:
    """The whole file under its name, or none."""
    part = f"{path}.{uuid.uuid4().hex[:8]}.part"
    with open(part, "wb") as f:
        f.write(data)
    os.replace(part, path)


def _dense(pdf: pd.DataFrame, column: str, index: tuple[np.ndarray, ...], shape: tuple[int, ...], kind: str, fill: float) -> np.ndarray:
    out = np.full(shape, fill, kind)
    v = pdf[column]
    ok = v.notna().to_numpy()
    out[tuple(i[ok] for i in index)] = v[ok].to_numpy().astype(kind)
    return out


def _files(groups, write: Callable[[pd.DataFrame], list[str]]) -> list[str]:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"file": write(pdf)})

    return sorted(r[0] for r in groups.applyInPandas(run, "file string").collect())  # the names of the files


def write_netcdf(df: DataFrame, folder: str, grid: Grid, epsg: int, *, start: str, days: int = 32, attrs: dict | None = None, name: str = "cube") -> list[str]:
    """One file for each block of ``days`` days from ``start``: every channel of a cube (``day, row, col``, channels) on (time, y, x), with the
    coordinates and the attributes. ``folder`` must be one that all executors share. Returns the files written."""
    os.makedirs(folder, exist_ok=True)
    kinds = encodings(df)
    block = F.floor(F.datediff(F.col("day").cast("date"), F.to_date(F.lit(start))) / days)
    base = date.fromisoformat(start)
    y, x = grid.y0 - (np.arange(grid.height) + 0.5) * grid.res, grid.x0 + (np.arange(grid.width) + 0.5) * grid.res

    def write(pdf: pd.DataFrame) -> list[str]:
        offset = np.array([(d - base).days for d in pd.to_datetime(pdf["day"]).dt.date])
        times, t = np.unique(offset, return_inverse=True)
        index = (t, pdf["row"].to_numpy(), pdf["col"].to_numpy())
        shape = (times.size, grid.height, grid.width)
        variables = {"time": (("time",), times.astype("i4"), {"units": f"days since {start}"}), "y": (("y",), y, {"units": "m"}), "x": (("x",), x, {"units": "m"})}
        for c, (kind, fill) in kinds.items():
            variables[c] = (("time", "y", "x"), _dense(pdf, c, index, shape, kind, fill), {"_FillValue": np.array(fill, kind)})
        path = os.path.join(folder, f"{name}_{date.fromordinal(base.toordinal() + int(times[0])):%Y%m%d}.nc")
        _put(path, netcdf({"time": times.size, "y": grid.height, "x": grid.width}, variables, {"crs": f"EPSG:{epsg}", **(attrs or {})}))
        return [path]

    return _files(df.withColumn("_block", block).groupBy("_block"), write)


def write_rasters(df: DataFrame, folder: str, grid: Grid, epsg: int, channels: list[str]) -> list[str]:
    """One GeoTIFF for each day and channel, ``<channel>_<day>.tif``; ``folder`` must be one that all executors share."""
    os.makedirs(folder, exist_ok=True)
    kinds = encodings(df.select("day", "row", "col", *channels))

    def write(pdf: pd.DataFrame) -> list[str]:
        day = pd.to_datetime(pdf["day"].iloc[0])
        index = (pdf["row"].to_numpy(), pdf["col"].to_numpy())
        out = []
        for c, (kind, fill) in kinds.items():
            out.append(os.path.join(folder, f"{c}_{day:%Y%m%d}.tif"))
            _put(out[-1], geotiff(_dense(pdf, c, index, (grid.height, grid.width), kind, fill), grid, epsg))
        return out

    return _files(df.select("day", "row", "col", *channels).groupBy("day"), write)


def write_output(df: DataFrame, path: str, fmt: str, *, grid: Grid | None = None, epsg: int | None = None, start: str | None = None, **how) -> list[str]:
    """A cube in any format: a table (parquet, csv, json, orc) or gridded files (netcdf, geotiff), which need the grid. Returns the paths."""
    if fmt in ("parquet", "csv", "json", "orc"):
        write_table(df, path, fmt, **how)
        return [path]
    if fmt not in ("netcdf", "geotiff") or grid is None or epsg is None:
        raise ValueError(f"unknown format {fmt!r}, or no grid for it")
    if fmt == "netcdf":
        return write_netcdf(df, path, grid, epsg, start=start or str(df.agg(F.min("day")).first()[0])[:10], **how)
    return write_rasters(df, path, grid, epsg, how.get("channels") or list(encodings(df)))
