"""Text lines of user files into typed observations, with the rejects and their reasons."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv as pacsv
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skerry.runtime import spread

FIELDS = ("station_id", "time", "latitude", "longitude", "value", "z", "qc", "station_name")
WELL_QUOTED = r'^(?:[^",]*|"(?:[^"]|"")*")(?:,(?:[^",]*|"(?:[^"]|"")*"))*\z'
NUMBER = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"
TIME = r"^(?P<y>[0-9]{4})-(?P<mo>[0-9]{2})-(?P<d>[0-9]{2})[T ](?P<h>[0-9]{2}):(?P<mi>[0-9]{2})(?::(?P<s>[0-9]{2})(?:\.(?P<f>[0-9]{1,9}))?)?(?:Z|(?P<sg>[+-])(?P<oh>[0-9]{2}):?(?P<om>[0-9]{2}))?$"
OUT = "line_id long, reasons array<string>, station_id string, time_us long, latitude double, longitude double, value double, z double, qc int, station_name string"


def days_from_civil(y: np.ndarray, m: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Days since 1970-01-01 of proleptic Gregorian dates, and whether each is a real date (years from 1)."""
    ok = (y >= 1) & (m >= 1) & (m <= 12) & (d >= 1)
    y, m, d = np.where(ok, y, 1970), np.where(ok, m, 1), np.where(ok, d, 1)
    month = ((y - 1970) * 12 + (m - 1)).astype("datetime64[M]")
    first, after = month.astype("datetime64[D]").astype(np.int64), (month + 1).astype("datetime64[D]").astype(np.int64)
    return first + d - 1, ok & (d <= after - first)


def ints(column: pa.Array, empty: int = 0) -> np.ndarray:
    """Digits as integers; NULL or empty gives ``empty``."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    got = pc.if_else(pc.equal(pc.fill_null(column, ""), ""), str(empty), pc.fill_null(column, ""))
    return pc.cast(got, pa.int64()).to_numpy(zero_copy_only=False)


def _numbers(field: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Plain decimal numbers as doubles (NaN elsewhere), and which are."""
    ok = pc.match_substring_regex(field, NUMBER).to_numpy(zero_copy_only=False)
    # the cast takes every form that NUMBER lets through; numbers too large become infinite
    return pc.cast(pc.if_else(pa.array(ok), field, "nan"), pa.float64()).to_numpy(zero_copy_only=False), ok


def _times(field: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Microseconds since 1970 UTC (a time without an offset is UTC; finer digits are cut), and which are real times."""
    got = pc.extract_regex(field, TIME)
    ok = got.is_valid().to_numpy(zero_copy_only=False)
    part = {k: got.field(k) for k in ("y", "mo", "d", "h", "mi", "s", "sg", "oh", "om")}
    n = {k: ints(pc.if_else(pa.array(ok), v, "")) for k, v in part.items() if k != "sg"}
    day, real = days_from_civil(n["y"], n["mo"], n["d"])
    off = n["oh"] * 60 + n["om"]
    ok &= real & (n["h"] <= 23) & (n["mi"] <= 59) & (n["s"] <= 59) & (off <= 14 * 60)
    frac = ints(pc.utf8_slice_codeunits(pc.utf8_rpad(pc.if_else(pa.array(ok), pc.fill_null(got.field("f"), ""), ""), 6, "0"), 0, 6))
    sign = np.where(pc.equal(pc.fill_null(part["sg"], "+"), "-").to_numpy(zero_copy_only=False), -1, 1)
    return ((day * 86_400 + n["h"] * 3600 + n["mi"] * 60 + n["s"] - sign * off * 60) * 1_000_000 + frac), ok


def _structure(lines: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Table]:
    """Which lines break the quoting, which have another number of fields, and the fields of the others, all as text."""
    text = pc.fill_null(lines, "")
    text = pc.if_else(pc.ends_with(text, "\r"), pc.utf8_slice_codeunits(text, 0, -1), text)
    quoting = ~pc.match_substring_regex(text, WELL_QUOTED).to_numpy(zero_copy_only=False)
    # line ends within a line would end it for the parser; an empty line would be a row of empty fields
    safe = pc.replace_substring(pc.replace_substring(text, "\n", "\x1d"), "\r", "\x1e")
    safe = pc.if_else(pc.or_(pa.array(quoting), pc.equal(safe, "")), "-", safe)
    rejected: list[int] = []

    def refuse(row: pacsv.InvalidRow) -> str:
        rejected.append(row.number - 1)
        return "skip"

    every = pa.ListArray.from_arrays(pa.array([0, len(safe), len(safe)], pa.int32()), pa.concat_arrays([safe, pa.array([""])]))
    data = pc.binary_join(every.slice(0, 1), "\n")[0].as_buffer()
    fields = pacsv.read_csv(
        pa.BufferReader(data),
        read_options=pacsv.ReadOptions(column_names=FIELDS, use_threads=False, block_size=data.size + 1),
        parse_options=pacsv.ParseOptions(invalid_row_handler=refuse, ignore_empty_lines=False),
        convert_options=pacsv.ConvertOptions(column_types=dict.fromkeys(FIELDS, pa.string()), strings_can_be_null=False),
    )
    columns = np.zeros(len(lines), bool)
    columns[rejected] = True
    columns &= ~quoting
    return quoting, columns, fields


def _trim(a: pa.ChunkedArray | pa.Array) -> pa.Array:
    a = a.combine_chunks() if isinstance(a, pa.ChunkedArray) else a
    return pc.utf8_trim(a, " \t")


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        n = b.num_rows
        if not n:
            continue
        quoting, columns, fields = _structure(b.column(1))
        good = ~(quoting | columns)
        where = np.full(n, -1)
        where[good] = np.arange(good.sum())
        at = pa.array(where, mask=~good)
        f = {c: _trim(fields.column(c)) if fields.num_rows else pa.array([], pa.string()) for c in FIELDS}
        us, time_ok = _times(f["time"])
        num = {c: _numbers(f[c]) for c in ("latitude", "longitude", "value", "z", "qc")}
        lat_ok = num["latitude"][1] & (np.abs(np.nan_to_num(num["latitude"][0], nan=999.0)) <= 90)
        val_ok = num["value"][1] & np.isfinite(num["value"][0])
        bad = {"time": ~time_ok, "latitude": ~lat_ok, "value": ~val_ok}
        flags = np.zeros((n, 5), bool)
        flags[:, 0], flags[:, 1] = quoting, columns
        for j, x in enumerate(bad.values(), 2):
            flags[good, j] = x
        names = np.array(["quoting", "columns", *bad])
        off = np.concatenate([[0], np.cumsum(flags.sum(1))]).astype(np.int32)
        reasons = pa.ListArray.from_arrays(pa.array(off), pa.array(names[np.nonzero(flags)[1]], pa.string()))

        def spread(values: np.ndarray, ok: np.ndarray, kind: pa.DataType) -> pa.Array:
            return pa.array(values, mask=~ok).cast(kind, safe=False).take(at)

        qc, qc_ok = num["qc"]
        whole = qc_ok & (np.abs(np.nan_to_num(qc, nan=1e9, posinf=1e9, neginf=1e9)) < 2**31 - 1) & (np.floor(np.nan_to_num(qc)) == qc)
        yield pa.RecordBatch.from_arrays(
            [
                b.column(0),
                reasons,
                f["station_id"].take(at),
                spread(us, time_ok, pa.int64()),
                spread(num["latitude"][0], lat_ok, pa.float64()),
                *(spread(num[c][0], num[c][1] & np.isfinite(num[c][0]), pa.float64()) for c in ("longitude",)),
                spread(num["value"][0], val_ok, pa.float64()),
                spread(num["z"][0], num["z"][1] & np.isfinite(num["z"][0]), pa.float64()),
                spread(np.where(whole, qc, 0), whole, pa.int32()),
                pc.replace_substring(pc.replace_substring(f["station_name"], "\x1d", "\n"), "\x1e", "\r").take(at),
            ],
            names=["line_id", "reasons", "station_id", "time_us", "latitude", "longitude", "value", "z", "qc", "station_name"],
        )


def parse_observation_lines(lines: DataFrame, *, line_id: str = "line_id", line: str = "line") -> DataFrame:
    """Each line with the reasons why it can't be loaded (none: a good line) and its typed fields.

    A line is split at commas by the CSV parser of pyarrow, whose invalid-row callback rejects lines without exactly eight
    fields (reason ``columns``); lines with broken quoting are kept from it (``quoting``). All fields are read as text, then
    cast as vectors: ``time``, ``latitude`` and ``value`` name the cells that fail. A longitude, z or qc that is no number gives
    NULL and no reason. One carriage return at the end of a line is dropped; an empty or NULL line has the reason ``columns``;
    a NULL line_id is kept. A line given twice comes out twice. Works batch by batch; only an input too small to fill the cores is shuffled.
    """
    rows = lines.select(F.col(line_id).cast("long").alias("line_id"), F.col(line).cast("string").alias("line"))
    return spread(rows).mapInArrow(_parse, OUT)


def rejected_lines(lines: DataFrame, **names) -> DataFrame:
    """``line_id, reason``: one row for each rejected line and reason."""
    return parse_observation_lines(lines, **names).select("line_id", F.explode("reasons").alias("reason"))


def loaded_lines(lines: DataFrame, **names) -> DataFrame:
    """The good lines as typed observations."""
    good = parse_observation_lines(lines, **names).where(F.size("reasons") == 0)
    return good.drop("reasons").withColumn("time", F.timestamp_micros("time_us")).drop("time_us")
