"""Gridded files, read back from their layouts."""

import struct
from datetime import date

import numpy as np
import pytest

from skerry.functions.geo import Grid
from skerry.sources.grids import encodings, write_netcdf, write_rasters


def read_netcdf(data):
    """The classic format by its grammar: dimensions, attributes and variables."""
    at = 0

    def take(fmt):
        nonlocal at
        v = struct.unpack_from(f">{fmt}", data, at)
        at += struct.calcsize(f">{fmt}")
        return v[0] if len(v) == 1 else v

    def name():
        nonlocal at
        n = take("i")
        s = data[at : at + n].decode()
        at += n + -n % 4
        return s

    types = {1: ">i1", 2: "S1", 3: ">i2", 4: ">i4", 5: ">f4", 6: ">f8"}

    def attributes():
        nonlocal at
        tag, n = take("ii")
        assert tag in (0, 12)
        out = {}
        for _ in range(n):
            k, (t, m) = name(), take("ii")
            size = np.dtype(types[t]).itemsize * m
            raw = data[at : at + size]
            at += size + -size % 4
            out[k] = raw.decode() if t == 2 else np.frombuffer(raw, types[t])
        return out

    assert data[:4] == b"CDF\2"
    at = 4
    assert take("i") == 0
    tag, n = take("ii")
    assert tag == 10
    dims = [(name(), take("i")) for _ in range(n)]
    top = attributes()
    tag, n = take("ii")
    assert tag == 11
    out = {}
    for _ in range(n):
        k, m = name(), take("i")
        own = [take("i") for _ in range(m)]
        attrs = attributes()
        t, size, begin = take("i"), take("i"), take("q")
        shape = [dims[d][1] for d in own]
        a = np.frombuffer(data, types[t], int(np.prod(shape)), begin).reshape(shape)
        assert size == a.nbytes + -a.nbytes % 4 and begin % 4 == 0
        out[k] = ([dims[d][0] for d in own], a, attrs)
    return dict(dims), top, out


@pytest.fixture(scope="module")
def cube(spark):
    rows = [(date(2024, 6, d), r, c, float(10 * d + r) if c else None, d + c if r else None, r == c) for d in (1, 2, 5) for r in range(2) for c in range(3)]
    return spark.createDataFrame(rows, "day date, row int, col int, sst double, n smallint, valid boolean")


GRID = Grid(500_000.0, 5_000_000.0, 100.0, 2, 3)


def test_netcdf_in_blocks_of_days(cube, tmp_path):
    files = write_netcdf(cube, str(tmp_path), GRID, 32631, start="2024-06-01", days=4, attrs={"title": "é", "offset": 1.25})
    assert [f.rsplit("/", 1)[1] for f in files] == ["cube_20240601.nc", "cube_20240605.nc"]
    dims, top, v = read_netcdf(open(files[0], "rb").read())
    assert dims == {"time": 2, "y": 2, "x": 3} and top["crs"] == "EPSG:32631" and top["title"] == "é" and top["offset"][0] == 1.25
    assert v["time"][1].tolist() == [0, 1] and v["time"][2]["units"] == "days since 2024-06-01"
    assert v["x"][1].tolist() == [500_050.0, 500_150.0, 500_250.0] and v["y"][1].tolist() == [4_999_950.0, 4_999_850.0]
    want = np.array([[[np.nan, 10, 10], [np.nan, 11, 11]], [[np.nan, 20, 20], [np.nan, 21, 21]]])
    assert v["sst"][0] == ["time", "y", "x"] and np.array_equal(v["sst"][1], want, equal_nan=True) and np.isnan(v["sst"][2]["_FillValue"][0])
    assert v["n"][1].tolist() == [[[-9999] * 3, [1, 2, 3]], [[-9999] * 3, [2, 3, 4]]] and v["n"][1].dtype == ">i2"
    assert v["valid"][1][0].tolist() == [[1, 0, 0], [0, 1, 0]]
    assert read_netcdf(open(files[1], "rb").read())[2]["time"][1].tolist() == [4]


def test_geotiff_a_day_and_channel(cube, tmp_path):
    files = write_rasters(cube, str(tmp_path), GRID, 32631, ["sst", "n"])
    assert len(files) == 6 and files[0].endswith("/n_20240601.tif")
    data = open(next(f for f in files if f.endswith("sst_20240602.tif")), "rb").read()
    order, magic, at, n = struct.unpack_from("<2sHIH", data)
    assert (order, magic) == (b"II", 42)
    tags = {}
    for k in range(n):
        tag, t, m = struct.unpack_from("<HHI", data, at + 2 + 12 * k)
        code = {3: "H", 4: "I", 12: "d"}[t]
        here = at + 2 + 12 * k + 8
        where = here if m * struct.calcsize(code) <= 4 else struct.unpack_from("<I", data, here)[0]
        tags[tag] = struct.unpack_from(f"<{m}{code}", data, where)
    assert list(tags) == sorted(tags) and (tags[256], tags[257], tags[258], tags[339]) == ((3,), (2,), (32,), (3,))
    assert tags[33550][:2] == (100.0, 100.0) and tags[33922][3:5] == (500_000.0, 5_000_000.0) and tags[34735][-1] == 32631
    a = np.frombuffer(data, "<f4", 6, tags[273][0]).reshape(2, 3)
    assert np.array_equal(a, [[np.nan, 20, 20], [np.nan, 21, 21]], equal_nan=True) and tags[273][0] + tags[279][0] == len(data)


def test_what_can_be_gridded(cube):
    assert encodings(cube)["sst"][0] == "f4" and encodings(cube)["valid"] == ("i1", -128)
    with pytest.raises(ValueError, match="name"):
        encodings(cube.selectExpr("*", "'x' AS name"))


def test_output_in_any_format(spark, cube, tmp_path):
    from skerry.sources.grids import write_output

    assert spark.read.orc(write_output(cube, str(tmp_path / "t"), "orc")[0]).count() == 18
    assert [f[-11:] for f in write_output(cube, str(tmp_path / "n"), "netcdf", grid=GRID, epsg=32631)] == ["20240601.nc"]
    assert len(write_output(cube, str(tmp_path / "g"), "geotiff", grid=GRID, epsg=32631)) == 9
    for fmt in ("netcdf", "zarr"):
        with pytest.raises(ValueError):
            write_output(cube, str(tmp_path / "x"), fmt)
