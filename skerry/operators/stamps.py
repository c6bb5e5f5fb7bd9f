"""Timestamps in mixed formats, precisions and zones into unambiguous UTC instants.

Every valid reading of a stamp is generated as an array of (format, instant). Where there are several, the choice is made
over the source's record order by the Viterbi algorithm, penalising switches of format and backward jumps in time. A source of
any size is split into blocks of its record order: each block is summed up as the costs between the readings of its first
and its last row, these small matrices are chained, and the blocks are then decoded from their fixed ends; the result is
that of one run over the whole source.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skerry.batches import floats, whole_groups
from skerry.functions import zones
from skerry.runtime import cut
from skerry.sources.lines import days_from_civil, ints

ZONE = r"(?: ?(?P<z>[Zz]|[A-Za-z]{2,5}|[+-][0-9]{2}(?::?[0-9]{2})?))?"
CLOCK = r"(?P<h>[0-9]{1,2}):(?P<mi>[0-9]{2})(?::(?P<s>[0-9]{2})(?:[.,](?P<f>[0-9]+))?)?(?: ?(?P<ap>[AaPp][Mm]))?"
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
#: format name -> pattern over the stamp without blanks around it
FORMATS = {
    "iso": rf"^(?P<y>[0-9]{{4}})-(?P<mo>[0-9]{{1,2}})-(?P<d>[0-9]{{1,2}})[Tt ]{CLOCK}{ZONE}$",
    "compact": rf"^(?P<y>[0-9]{{4}})(?P<mo>[0-9]{{2}})(?P<d>[0-9]{{2}})[Tt ](?P<h>[0-9]{{2}})(?P<mi>[0-9]{{2}})(?P<s>[0-9]{{2}})?{ZONE}$",
    "ordinal": rf"^(?P<y>[0-9]{{4}})-(?P<doy>[0-9]{{3}})[Tt ]{CLOCK}{ZONE}$",
    "slash": rf"^(?P<a>[0-9]{{1,2}})/(?P<b>[0-9]{{1,2}})/(?P<y>[0-9]{{4}})[Tt ]{CLOCK}{ZONE}$",
    "point": rf"^(?P<a>[0-9]{{1,2}})\.(?P<b>[0-9]{{1,2}})\.(?P<y>[0-9]{{4}})[Tt ]{CLOCK}{ZONE}$",
    "dmon": rf"^(?P<d>[0-9]{{1,2}})[- ](?P<mon>[A-Za-z]{{3}})[- ](?P<y>[0-9]{{4}})[Tt ]{CLOCK}{ZONE}$",
    "mond": rf"^(?P<mon>[A-Za-z]{{3}}) (?P<d>[0-9]{{1,2}}), (?P<y>[0-9]{{4}})[Tt ]{CLOCK}{ZONE}$",
    "epoch": r"^(?P<n>[0-9]{10}|[0-9]{13}|[0-9]{16})$",
    "serial": r"^(?P<day>[0-9]{5})\.(?P<frac>[0-9]+)$",
}
CODES = {name: 10 * k for k, name in enumerate(FORMATS)}  # + 1: month before day
NONE = np.int64(-(2**63))


@dataclass(frozen=True)
class StampRule:
    """switch, backward: Viterbi costs of a change of format and of a step back in time. block: record numbers in a block."""

    switch: float = 1.0
    backward: float = 4.0
    block: int = 1 << 17


def _group(got: pa.StructArray, name: str) -> pa.Array | None:
    return got.field(name) if got.type.get_field_index(name) >= 0 else None


def _zone_offsets(text: pa.Array, feed_zones: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """For the zone texts: whether one is given, the offsets in seconds it may stand for (two slots), which slots hold one."""
    zs = np.array([x or "" for x in text.to_pylist()], object)
    given = zs != ""
    slots, ok = [np.zeros(zs.size, np.int64) for _ in range(2)], np.zeros((2, zs.size), bool)
    for one in set(zs[given]):
        own = zs == one
        up = one.upper()
        if one[0] in "+-":
            digits = one[1:].replace(":", "")
            h, m = int(digits[:2]), int(digits[2:] or 0)
            if h <= 23 and m <= 59:
                slots[0][own] = (-1 if one[0] == "-" else 1) * (h * 3600 + m * 60)
                ok[0, own] = True
        elif up in ("Z", "UTC", "GMT"):
            ok[0, own] = True
        else:
            for tz in filter(zones.known, set(feed_zones[own])):
                here = own & (feed_zones == tz)
                offsets = zones.abbreviations(tz).get(up, ())
                if len(offsets) > len(slots):
                    raise ValueError(f"{up} stands for {len(offsets)} offsets in {tz}; there is room for {len(slots)}")
                for j, off in enumerate(offsets):
                    slots[j][here], ok[j, here] = off, True
    return given, slots, ok


def readings_of(stamps: pa.Array, feed_zones: np.ndarray, orders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All valid readings of each stamp: codes and instants (us), four slots a stamp; instant ``NONE`` in empty slots."""
    n = len(stamps)
    code, us = np.full((n, 4), -1, np.int16), np.full((n, 4), NONE, np.int64)
    text = pc.utf8_trim(pc.fill_null(stamps, ""), " \t")
    todo = np.ones(n, bool)

    def put(rows: np.ndarray, c: int, micros: np.ndarray) -> None:
        """Into the first free slot, unless the instant is there already."""
        fresh = (us[rows] != micros[:, None]).all(1)
        rows, micros = rows[fresh], micros[fresh]
        slot = (us[rows] != NONE).sum(1)
        us[rows, slot] = micros  # two orders of day and month by two offsets: four at most
        code[rows, slot] = c

    def put_wall(rows: np.ndarray, c: int, wall: np.ndarray, frac: np.ndarray) -> None:
        for tz in filter(zones.known, set(feed_zones[rows])):
            own = feed_zones[rows] == tz
            u1, ok1, u2, ok2 = zones.instants(tz, wall[own])
            for u, ok in ((u1, ok1), (u2, ok2)):
                put(rows[own][ok], c, u[ok] * 1_000_000 + frac[own][ok])

    for name, pattern in FORMATS.items():
        left = np.flatnonzero(todo)
        if not left.size:
            break
        got = pc.extract_regex(text.take(pa.array(left)), pattern)
        hit = got.is_valid().to_numpy(zero_copy_only=False)
        if not hit.any():
            continue
        rows, got = left[hit], got.filter(pa.array(hit))
        todo[rows] = False
        c = CODES[name]
        if name == "epoch":
            digits = pc.utf8_length(got.field("n")).to_numpy(zero_copy_only=False)
            put(rows, c, ints(got.field("n")) * np.array([10 ** (16 - k) for k in range(17)], np.int64)[digits])
            continue
        if name == "serial":
            frac = pc.utf8_slice_codeunits(pc.utf8_rpad(got.field("frac"), 12, "0"), 0, 12)
            seconds = np.array([(int(x) * 172_800 + 10**12) // (2 * 10**12) for x in frac.to_pylist()], np.int64)  # nearest, halves up
            put_wall(rows, c, (ints(got.field("day")) - 25_569) * 86_400 + seconds, np.zeros(rows.size, np.int64))
            continue
        num = {k: ints(x) for k in ("y", "h", "mi", "s", "mo", "d", "doy", "a", "b") if (x := _group(got, k)) is not None}
        h = num["h"].copy()
        ok = (h <= 23) & (num["mi"] <= 59) & (num["s"] <= 59)
        if (ap := _group(got, "ap")) is not None:
            p = np.array([(x or "").lower() for x in ap.to_pylist()], object)
            half = p != ""
            ok &= ~half | ((h >= 1) & (h <= 12))
            h = np.where(half, h % 12 + np.where(p == "pm", 12, 0), h)
        clock = h * 3600 + num["mi"] * 60 + num["s"]
        f = _group(got, "f")
        frac = np.zeros(rows.size, np.int64) if f is None else ints(pc.utf8_slice_codeunits(pc.utf8_rpad(pc.fill_null(f, ""), 6, "0"), 0, 6))
        given, slots, has = _zone_offsets(got.field("z"), feed_zones[rows])
        if "mon" in {x.name for x in got.type}:
            low = [x.lower() for x in got.field("mon").to_pylist()]
            num["mo"] = np.array([MONTHS.index(x) + 1 if x in MONTHS else 0 for x in low])
        # calendar readings: (code, month, day, which rows may be read so)
        every = np.ones(rows.size, bool)
        ways = [(c, num.get("mo"), num.get("d"), every)]
        if name == "ordinal":
            jan = np.ones(rows.size, np.int64)
            ways = [(c, jan, jan, every)]
        elif name in ("slash", "point"):
            o = orders[rows]
            ways = [(c, num["b"], num["a"], o != "MDY"), (c + 1, num["a"], num["b"], o != "DMY")]
        for k, month, day, may in ways:
            days, real = days_from_civil(num["y"], month, day)
            if name == "ordinal":
                leap = (num["y"] % 4 == 0) & ((num["y"] % 100 != 0) | (num["y"] % 400 == 0))
                real = real & (num["doy"] >= 1) & (num["doy"] <= 365 + leap)
                days = days + num["doy"] - 1
            good = ok & real & may
            wall = days * 86_400 + clock
            for j in range(2):
                own = good & given & has[j]
                put(rows[own], k, (wall[own] - slots[j][own]) * 1_000_000 + frac[own])
            own = good & ~given
            put_wall(rows[own], k, wall[own], frac[own])
    return code, us


def _cost(rule: StampRule, c0: np.ndarray, u0: np.ndarray, c1: np.ndarray, u1: np.ndarray) -> np.ndarray:
    """Costs from each reading of a row to each of the next; leading axes are rows."""
    return rule.switch * (c0[..., :, None] != c1[..., None, :]) + rule.backward * (u0[..., :, None] > u1[..., None, :])


def _steps(rule: StampRule, code: np.ndarray, us: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The costs (rows - 1, 4, 4) between all neighbouring rows; infinite to and from empty slots."""
    out = _cost(rule, code[:-1], us[:-1], code[1:], us[1:])
    slot = np.arange(code.shape[1])
    out[~((slot < m[:-1, None])[:, :, None] & (slot < m[1:, None])[:, None, :])] = np.inf
    return out


def _in_blocks(steps: np.ndarray) -> np.ndarray:
    """The steps as (blocks, about the root of their number, 4, 4), filled up with steps that change nothing."""
    n, k = steps.shape[:2]
    long = max(1, math.isqrt(n))
    fill = np.tile(np.where(np.eye(k, dtype=bool), 0.0, np.inf), (-n % long, 1, 1))
    return np.concatenate([steps, fill]).reshape(-1, long, k, k)


def _product(blocks: np.ndarray) -> np.ndarray:
    """The least costs through each block, all blocks at once."""
    out = blocks[:, 0]
    for j in range(1, blocks.shape[1]):
        out = (out[:, :, :, None] + blocks[:, j, None, :, :]).min(2)
    return out


def _some(m: np.ndarray) -> np.ndarray:
    """The rows that the choice depends on: those of several readings with their neighbours, and the ends."""
    many = m > 1
    near = many.copy()
    near[1:] |= many[:-1]
    near[:-1] |= many[1:]
    near[[0, -1]] = True
    return np.flatnonzero(near)


def _transfer(rule: StampRule, code: np.ndarray, us: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Costs from each reading of the first row to each of the last, up to a constant."""
    own = _some(m)
    if own.size == 1:
        return np.where(np.eye(m[0], dtype=bool), 0.0, np.inf)
    cost = _steps(rule, code[own], us[own], m[own])
    while cost.shape[0] > 1:
        cost = _product(_in_blocks(cost) if cost.shape[0] > 16 else cost[None])
    return cost[0][: m[0], : m[-1]]


def _decode(rule: StampRule, code: np.ndarray, us: np.ndarray, m: np.ndarray, first: int, last: int) -> np.ndarray:
    """The chosen reading of each row, its ends given: the path of least cost, of equal ones that with the earlier readings,
    compared from the last row back.

    The steps lie in blocks; the costs at the blocks' starts follow from the products of the blocks, then all blocks run
    forward together, and back from each of their possible ends.
    """
    pick = np.zeros(m.size, np.int64)
    pick[0], pick[-1] = first, last
    own = _some(m)
    if own.size < 3:
        return pick
    blocks = _in_blocks(_steps(rule, code[own], us[own], m[own]))
    count, long, k = blocks.shape[:3]
    enter = np.full((count, k), np.inf)
    enter[0, first] = 0.0
    for b, through in enumerate(_product(blocks)[:-1]):
        enter[b + 1] = (enter[b][:, None] + through).min(0)
    back = np.empty((count, long, k), np.int8)
    cost = enter
    for j in range(long):
        total = cost[:, :, None] + blocks[:, j]
        back[:, j], cost = total.argmin(1), total.min(1)
    at = np.empty((count, long, k), np.int8)  # the reading of each row, for each end of its block
    state = np.tile(np.arange(k), (count, 1))
    for j in range(long - 1, -1, -1):
        state = np.take_along_axis(back[:, j], state, 1)
        at[:, j] = state
    chosen = np.empty((count, long), np.int64)
    for b in range(count - 1, -1, -1):
        chosen[b] = at[b, :, last]
        last = int(chosen[b, 0])
    pick[own[:-1]] = chosen.ravel()[: own.size - 1]
    return pick


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Whole blocks with their starts and readings; of rows sent again (same row) the first stands for all."""
    for t, starts in whole_groups(batches, ["k", "block"], rows=50_000):
        row, kind = floats(t, "row"), floats(t, "kind")
        keep = np.concatenate([[True], (row[1:] != row[:-1]) | (kind[1:] != kind[:-1])])
        keep[starts] = True
        if not keep.all():
            t, starts = t.filter(pa.array(keep)), (np.cumsum(keep) - 1)[starts]
        tz = np.array([x or "UTC" for x in t.column("tz").to_pylist()], object)
        order = np.array([x or "" for x in t.column("ord").to_pylist()], object)
        code, us = readings_of(t.column("stamp").combine_chunks(), tz, order)
        yield t, starts, code, us, (us != NONE).sum(1)


def _sum_up(rule: StampRule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("k", pa.string()), ("block", pa.int64()), ("c0", pa.list_(pa.int16())), ("u0", pa.list_(pa.int64())), ("c1", pa.list_(pa.int16())), ("u1", pa.list_(pa.int64())), ("cost", pa.list_(pa.float64()))])
        for t, starts, code, us, m in _blocks(batches):
            k, block, out = t.column("k"), floats(t, "block"), []
            for s, e in zip(starts, np.append(starts[1:], m.size), strict=True):
                own = s + np.flatnonzero(m[s:e])
                if own.size:
                    c, u, n = code[own], us[own], m[own]
                    cost = _transfer(rule, c, u, n)
                    out.append({"k": k[int(s)].as_py(), "block": int(block[s]), "c0": c[0, : n[0]].tolist(), "u0": u[0, : n[0]].tolist(), "c1": c[-1, : n[-1]].tolist(), "u1": u[-1, : n[-1]].tolist(), "cost": cost.ravel().tolist()})
            yield from pa.Table.from_pylist(out, schema).to_batches()

    return run


def _chain(rule: StampRule):
    """The readings of each block's first and last row on the cheapest path over all blocks of a source."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("k", pa.string()), ("block", pa.int64()), ("first", pa.int64()), ("last", pa.int64())])
        for t, starts in whole_groups(batches, ["k"], rows=5_000):
            rows, out = t.to_pylist(), []
            for s, e in zip(starts, np.append(starts[1:], len(rows)), strict=True):
                own = rows[s:e]
                cost, pointers = None, []
                for j, x in enumerate(own):
                    c0, u0 = np.array(x["c0"]), np.array(x["u0"])
                    enter = np.zeros(c0.size)
                    come = np.zeros(c0.size, np.int64)
                    if j:
                        y = own[j - 1]
                        step = cost[:, None] + _cost(rule, np.array(y["c1"]), np.array(y["u1"]), c0, u0)
                        come, enter = step.argmin(0), step.min(0)
                    through = enter[:, None] + np.array(x["cost"]).reshape(c0.size, -1)
                    pointers.append((come, through.argmin(0)))
                    cost = through.min(0)
                last = int(cost.argmin())
                for x, (come, first_of) in zip(reversed(own), reversed(pointers), strict=True):
                    first = int(first_of[last])
                    out.append({"k": x["k"], "block": x["block"], "first": first, "last": last})
                    last = int(come[first])
            yield from pa.Table.from_pylist(out, schema).to_batches()

    return run


def _finish(rule: StampRule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([n if d == 0 else n + "_mdy" for n in FORMATS for d in (0, 1)], object)
        for t, starts, code, us, m in _blocks(batches):
            kind, row = floats(t, "kind"), floats(t, "row")
            first, last = floats(t, "first"), floats(t, "last")
            pick = np.zeros(m.size, np.int64)
            for s, e in zip(starts, np.append(starts[1:], m.size), strict=True):
                own = s + np.flatnonzero(m[s:e])
                if own.size and kind[s] == 0 and (m[own] > 1).any():
                    pick[own] = _decode(rule, code[own], us[own], m[own], int(first[s]), int(last[s]))
            rows = np.flatnonzero(kind == 1)
            ok = m[rows] > 0
            best_u, best_c = us[rows, pick[rows]], code[rows, pick[rows]]
            label = names[np.where(ok, best_c // 10 * 2 + best_c % 10, 0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row[rows].astype(np.int64)), t.column("k").combine_chunks().take(pa.array(rows)), pa.array(np.where(ok, best_u, 0), mask=~ok), pa.array(label, pa.string(), mask=~ok), pa.array(m[rows].astype(np.int32))],
                names=["row", "k", "time_us", "format", "readings"],
            )

    return run


def normalise_stamps(rows: DataFrame, sources: DataFrame, rule: StampRule = StampRule(), *, row: str = "row_id", source: str = "feed_id", stamp: str = "time", zone: str = "time_zone", order: str = "date_order") -> DataFrame:
    """``row, source, time_us, format, readings``: one row for each row id (and source).

    ``readings`` counts the instants that the stamp may denote, given what its source declares (zone; order of day and
    month): 0 for no valid stamp (also NULL; time_us and format are NULL), 1 for an unambiguous one; of several, ``time_us`` is
    the one on the cheapest path over the source's rows in order of their ids. A source not declared, or with NULL, is in
    UTC and of unknown order; in a zone that doesn't exist a wall time denotes nothing. Blanks around a stamp don't count; digits finer than microseconds are cut. Rows with a NULL id
    are dropped; a row sent again counts once. ``sources`` has one row a source (of several the least zone and order are taken).
    """
    feeds = sources.select(F.col(source).cast("string").alias("k"), F.col(zone).alias("tz"), F.col(order).alias("ord")).where(F.col("k").isNotNull()).groupBy("k").agg(F.min("tz").alias("tz"), F.min("ord").alias("ord"))
    r = rows.select(F.col(row).cast("long").alias("row"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("k"), F.col(stamp).cast("string").alias("stamp")).where(F.col("row").isNotNull())
    r = r.withColumn("block", F.floor(F.col("row") / rule.block)).join(feeds, "k", "left")
    cols = ["k", "block", "kind", "row", "stamp", "tz", "ord", "first", "last"]
    null = F.lit(None).cast("long")
    r = r.withColumns({"kind": F.lit(1), "first": null, "last": null}).select(*cols)
    by = ["k", "block", "kind", "row", "stamp"]
    ends = cut(r.repartition("k", "block").sortWithinPartitions(*by).mapInArrow(_sum_up(rule), "k string, block long, c0 array<short>, u0 array<long>, c1 array<short>, u1 array<long>, cost array<double>"))
    path = ends.repartition("k").sortWithinPartitions("k", "block").mapInArrow(_chain(rule), "k string, block long, first long, last long")
    none = F.lit(None).cast("string")
    given = path.withColumns({"kind": F.lit(0), "row": F.lit(-(1 << 62)).cast("long"), "stamp": none, "tz": none, "ord": none}).select(*cols)
    both = r.unionByName(given).repartition("k", "block").sortWithinPartitions(*by)
    out = both.mapInArrow(_finish(rule), "row long, k string, time_us long, format string, readings int")
    return out.select(F.col("row").alias(row), F.nullif("k", F.lit("")).alias(source), "time_us", "format", "readings")


def unambiguous_instants(rows: DataFrame, sources: DataFrame, rule: StampRule = StampRule(), **names) -> DataFrame:
    """``row_id, time_us`` of the rows whose stamp denotes exactly one instant."""
    n = normalise_stamps(rows, sources, rule, **names)
    return n.where(F.col("readings") == 1).select(F.col(names.get("row", "row_id")).alias("row_id"), "time_us")
