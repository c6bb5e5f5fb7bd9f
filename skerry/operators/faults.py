"""Implausible readings: spikes by phase-space thresholding, stuck values by zero-difference runs, bounds.

A series is worked on in blocks of (source, time range), as long as hold about ``block_rows`` readings of that source, so a source
of any size and density is spread over tasks:

1. each block is summed up: its first and last readings, its runs of equal values at the edges and inside, and a histogram
   of its absolute steps;
2. the summaries of a source (one row a block) are joined up: what precedes and follows each block, the lengths of runs that
   cross blocks, the source's longest ordinary run, and from the histograms its exact median step;
3. each block is judged with that context, in one pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skerry.batches import floats, list_array, whole_groups
from skerry.operators.regular import finite
from skerry.runtime import beside_key, block_lengths, cut

EDGE = 6  # readings that a block must know of each neighbour: an excursion has up to 3, its levels 3 each
BEFORE, AFTER = 10, 20  # where in a block's context the readings before and after it begin


@dataclass(frozen=True)
class FaultRule:
    """What counts as a fault.

    low, high: bounds of possible values. max_len: readings in an excursion. flank: readings whose median is a level.
    factor: times the source's usual step. least_step: the usual step is at least this. stuck_len, stuck_times: a stuck run
    has at least stuck_len readings and stuck_times the source's longest run shorter than stuck_len. tolerance: a reading
    must exceed a limit by more than this; it stands for the rounding of doubles, so that a departure of exactly ten steps in
    decimal figures is none. block_rows: readings in a block, on average over the source.
    """

    low: float = -5.0
    high: float = 45.0
    factor: float = 10.0
    least_step: float = 0.001
    stuck_len: int = 15
    stuck_times: float = 3.0
    tolerance: float = 1e-9
    block_rows: int = 20_000
    rounds: int = 4


SUMMARY = "k string, block long, n long, head array<double>, tail array<double>, head_run long, tail_run long, short long, steps array<double>, counts array<long>"
CONTEXT = "k string, block long, before array<double>, after array<double>, run_before long, run_after long, short long, cross double"


def _distinct(t: pa.Table, starts: np.ndarray) -> tuple[pa.Table, np.ndarray]:
    """Without rows sent again: equal neighbours in (k, block, t, i)."""
    n = t.num_rows
    if n < 2:
        return t, starts
    same = (floats(t, "t")[1:] == floats(t, "t")[:-1]) & (floats(t, "i")[1:] == floats(t, "i")[:-1])
    if "kind" in t.column_names:
        kind = t.column("kind").to_numpy()
        same &= kind[1:] == kind[:-1]
    keep = np.concatenate([[True], ~same])
    keep[starts] = True
    if keep.all():
        return t, starts
    return t.filter(pa.array(keep)), (np.cumsum(keep) - 1)[starts]


def _runs(v: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of equal values; runs end at the groups' ends."""
    new = np.concatenate([[True], v[1:] != v[:-1]])
    new[starts] = True
    at = np.flatnonzero(new)
    return at, np.diff(np.append(at, v.size))


def _summarise(rule: FaultRule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, starts in whole_groups(batches, ["k", "block"]):
            t, starts = _distinct(t, starts)
            v = floats(t, "v")
            n = v.size
            ends = np.append(starts[1:], n)
            run_at, run_n = _runs(v, starts)
            first_run, last_run = np.searchsorted(run_at, starts), np.searchsorted(run_at, ends) - 1
            inner = np.where(run_n < rule.stuck_len, run_n, 0)
            inner[first_run] = 0
            inner[last_run] = 0
            short = np.maximum.reduceat(inner, first_run)
            d = np.abs(np.diff(v))
            group = np.repeat(np.arange(starts.size), ends - starts)
            own = group[1:] == group[:-1]
            d, g = d[own], group[1:][own]
            order = np.lexsort((d, g))
            d, g = d[order], g[order]
            new = np.concatenate([[True], (d[1:] != d[:-1]) | (g[1:] != g[:-1])]) if d.size else np.empty(0, bool)
            at = np.flatnonzero(new)
            count = np.diff(np.append(at, d.size))
            off = np.searchsorted(g[at], np.arange(starts.size + 1))
            m = np.minimum(EDGE, ends - starts)
            step = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
            edge_off = np.append(0, np.cumsum(m))
            yield pa.RecordBatch.from_arrays(
                [
                    t.column("k").combine_chunks().take(pa.array(starts)),
                    t.column("block").combine_chunks().take(pa.array(starts)),
                    pa.array(ends - starts, pa.int64()),
                    list_array(v[np.repeat(starts, m) + step], edge_off, pa.float64()),
                    list_array(v[np.repeat(ends - m, m) + step], edge_off, pa.float64()),
                    pa.array(run_n[first_run], pa.int64()),
                    pa.array(run_n[last_run], pa.int64()),
                    pa.array(short, pa.int64()),
                    list_array(d[at], off, pa.float64()),
                    list_array(count, off, pa.int64()),
                ],
                names=["k", "block", "n", "head", "tail", "head_run", "tail_run", "short", "steps", "counts"],
            )

    return run


def _join_up(rule: FaultRule):
    """Context of each block from the summaries of its source, in the order of the blocks. A source has one row a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, starts in whole_groups(batches, ["k"], rows=20_000):
            rows = t.to_pylist()
            out = []
            for a, b in zip(starts, np.append(starts[1:], len(rows)), strict=True):
                own = rows[a:b]
                short = max(x["short"] for x in own)
                before: list[float] = []
                left = 0  # readings just before the block that go on as one run of equal values
                for x in own:
                    x["before"], x["run_before"] = before[-EDGE:], left if before and before[-1] == x["head"][0] else 0
                    x["cross"] = abs(x["head"][0] - before[-1]) if before else None
                    whole = x["tail_run"] == x["n"]
                    left = x["tail_run"] + (x["run_before"] if whole else 0)
                    before = (before + x["tail"])[-EDGE:]
                after: list[float] = []
                right = 0
                for x in reversed(own):
                    x["after"], x["run_after"] = after[:EDGE], right if after and after[0] == x["tail"][-1] else 0
                    whole = x["head_run"] == x["n"]
                    right = x["head_run"] + (x["run_after"] if whole else 0)
                    after = (x["head"] + after)[:EDGE]
                for x in own:
                    whole = x["head_run"] == x["n"]
                    for edge in (x["run_before"] + x["head_run"] + (x["run_after"] if whole else 0), x["run_after"] + x["tail_run"] + (x["run_before"] if whole else 0)):
                        if edge < rule.stuck_len:
                            short = max(short, edge)
                out += [{c: x[c] for c in ("k", "block", "before", "after", "run_before", "run_after", "cross")} | {"short": short} for x in own]
            schema = pa.schema([("k", pa.string()), ("block", pa.int64()), ("before", pa.list_(pa.float64())), ("after", pa.list_(pa.float64())), ("run_before", pa.int64()), ("run_after", pa.int64()), ("short", pa.int64()), ("cross", pa.float64())])
            yield from pa.Table.from_pylist(out, schema).combine_chunks().to_batches()

    return run


def median_step(steps: DataFrame, least: float) -> DataFrame:
    """``k, step``: the exact median of each key's steps, given as ``k, d, n`` (a step and how often it occurs).

    The counts of classes of d, about 1 % wide and then a few millionths, find those that hold the middle ranks; only the steps
    within them are ordered. So no task orders all the steps of a hot key.
    """
    classes = {"c1": 64, "c2": 64 << 12}
    h = steps.groupBy("k", "d").agg(F.sum("n").alias("n"))
    wide = lambda f: F.when(F.col("d") > 0, F.floor(F.log2("d") * f)).otherwise(F.lit(-(1 << 40))).cast("long")
    near = h.select("k", "d", "n", *(wide(f).alias(c) for c, f in classes.items()))
    within = ["k"]
    for c in classes:
        w = W.partitionBy(*within).orderBy(c).rowsBetween(W.unboundedPreceding, 0)
        if c == "c1":  # middle ranks from 0
            cum = near.groupBy("k", c).agg(F.sum("n").alias("m")).withColumn("all", F.sum("m").over(W.partitionBy("k")))
            cum = cum.select("k", c, "m", F.floor((F.col("all") - 1) / 2).alias("lo"), F.floor(F.col("all") / 2).alias("hi"), F.sum("m").over(w).alias("to"))
        else:
            cum = near.groupBy(*within, c, "base", "lo", "hi").agg(F.sum("n").alias("m")).withColumn("to", F.col("base") + F.sum("m").over(w))
        within = [*within, c]
        mid = cum.where((F.col("to") - F.col("m") <= F.col("hi")) & (F.col("to") > F.col("lo"))).select(*within, (F.col("to") - F.col("m")).alias("base"), "lo", "hi")
        near = near.select("k", "d", "n", *classes).join(mid, within)
    near = near.withColumn("to", F.col("base") + F.sum("n").over(W.partitionBy(*within).orderBy("d").rowsBetween(W.unboundedPreceding, 0)))
    at = lambda r: F.min(F.when((F.col("to") > F.col(r)) & (F.col("to") - F.col("n") <= F.col(r)), F.col("d")))
    return near.groupBy("k").agg(F.greatest((at("lo") + at("hi")) / 2, F.lit(least)).alias("step"))


def _median3(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c))


def _scale(x: np.ndarray) -> float:
    """Robust standard deviation about the median."""
    return 1.4826 * float(np.median(np.abs(x - np.median(x))))


def outside_ellipsoids(x: np.ndarray, reach: float, rounds: int) -> np.ndarray:
    """Phase-space thresholding of a series ``x``; True where a reading lies outside the ellipsoid.

    The axes are each reading's departure from its local background, and its first and second differences. The background
    is a dead band between the fourth smallest and fourth largest of the five readings before and the five after, so neither
    a reading's companions in an excursion nor one step of the level hide it. The semi-axes are the universal threshold
    sqrt(2 ln n) times a robust scale (of the readings not yet flagged, in rounds until none is added); that of the
    departure is at most ``reach``, so nothing departing further is ever inside. Readings with fewer than five neighbours on a
    side, and all readings of a series too short for a scale (under 18), count as outside: the caller's exact check decides on them.
    """
    n = x.size
    out = np.ones(n, bool)
    if n < 18:
        return out
    near = np.empty((n - 10, 10))
    for j, k in enumerate((0, 1, 2, 3, 4, 6, 7, 8, 9, 10)):
        near[:, j] = x[k : n - 10 + k]
    near.partition((3, 6), axis=1)
    mid = x[5 : n - 5]
    up, down = mid - near[:, 3], mid - near[:, 6]
    u = np.where(np.abs(up) > np.abs(down), up, down)
    d1 = mid - x[4 : n - 6]
    d2 = x[6 : n - 4] - 2 * mid + x[4 : n - 6]
    flagged = np.zeros(u.size, bool)
    lam = np.sqrt(2 * np.log(n))
    tiny = reach * 1e-6
    for _ in range(rounds):
        ok = ~flagged
        if ok.sum() < 8:
            break
        a = min(max(lam * _scale(u[ok]), tiny), reach)
        b, c = (max(lam * _scale(d[ok]), reach) for d in (d1, d2))
        now = flagged | ((u / a) ** 2 + (d1 / b) ** 2 + (d2 / c) ** 2 > 1)
        if (now == flagged).all():
            break
        flagged = now
    out[5 : n - 5] = flagged
    return out


def _excursions(x: np.ndarray, cand: np.ndarray, limit: float, tolerance: float) -> np.ndarray:
    """The exact rule for the candidates: the indices of those within an excursion of one to three readings."""
    n = x.size
    hit = np.zeros(cand.size, bool)
    for length in (1, 2, 3):
        for lag in range(length):
            s = cand - lag
            ok = (s >= 3) & (s + length + 3 <= n)
            i = s[ok]
            if not i.size:
                continue
            b, a = _median3(x[i - 3], x[i - 2], x[i - 1]), _median3(x[i + length], x[i + length + 1], x[i + length + 2])
            w = np.stack([x[i + j] for j in range(length)])
            lo, hi = np.minimum(a, b), np.maximum(a, b)
            for out in (w.min(0) - hi, lo - w.max(0)):
                hit[np.flatnonzero(ok)] |= (out - limit > tolerance) & (out - (hi - lo) > tolerance)
    return cand[hit]


def _judge(rule: FaultRule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, starts in whole_groups(batches, ["k", "block"]):
            t, starts = _distinct(t, starts)
            kind = t.column("kind").to_numpy()
            v_all, i_all, t_all = floats(t, "v"), floats(t, "i"), floats(t, "t")
            n = kind.size
            hit_at: list[np.ndarray] = []
            hit_how: list[np.ndarray] = []
            for s, e in zip(starts, np.append(starts[1:], n), strict=True):
                m = int(np.searchsorted(kind[s:e], True))  # the block's context comes first
                if not 0 < m < e - s:
                    continue  # readings without context don't occur
                code, about = t_all[s : s + m], v_all[s : s + m]
                s += m
                v = v_all[s:e]
                how = np.zeros(v.size, np.int8)
                how[(v < rule.low) | (v > rule.high)] |= 1
                run_before, run_after, short, step = about[code < BEFORE]
                b, a = about[(code >= BEFORE) & (code < AFTER)], about[code >= AFTER]
                limit = rule.factor * step
                x = np.concatenate([b, v, a])
                cand = np.flatnonzero(outside_ellipsoids(x, limit, rule.rounds))
                cand = cand[(cand >= b.size) & (cand < b.size + v.size)]
                how[_excursions(x, cand, limit, rule.tolerance) - b.size] |= 2
                at, size = _runs(v, np.array([0]))
                size = size.astype(np.int64)
                total = size.copy()
                total[0] += int(run_before)
                total[-1] += int(run_after)
                stuck = (total >= rule.stuck_len) & (total >= rule.stuck_times * short)
                how[np.repeat(stuck, size)] |= 4
                f = np.flatnonzero(how)
                hit_at.append(f + s)
                hit_how.append(how[f])
            if not hit_at:
                continue
            at, how = np.concatenate(hit_at).astype(np.int64), np.concatenate(hit_how)
            yield pa.RecordBatch.from_arrays(
                [t.column("k").combine_chunks().take(pa.array(at)), pa.array(i_all[at].astype(np.int64)), pa.array(t_all[at].astype(np.int64)), pa.array(v_all[at]), pa.array(how & 2 > 0), pa.array(how & 4 > 0), pa.array(how & 1 > 0)],
                names=["k", "i", "t", "v", "spike", "stuck", "impossible"],
            )

    return run


def implausible_readings(readings: DataFrame, rule: FaultRule = FaultRule(), *, key: str = "station_id", ident: str = "obs_id", time: str = "time", value: str = "value") -> DataFrame:
    """Readings with a fault: ``key, ident, time, value, spike, stuck, impossible`` (at least one is true).

    Readings are taken per key in order of (time, ident); rows without key, ident or time, or without a finite value, are
    left out; rows sent again (same ident, key and time) count once. Spikes are found by phase-space thresholding
    (:func:`outside_ellipsoids`) and then held against the exact rule: an excursion of one to three readings beyond the medians
    of the three readings on either side by more than ``factor`` usual steps, further than these differ. A reading with
    fewer than three readings on a side is in no excursion. A flag column of the input does not decide. An empty table gives no rows.
    """
    r = readings.select(F.col(key).cast("string").alias("k"), F.unix_micros(F.col(time).cast("timestamp")).alias("t"), F.col(ident).cast("long").alias("i"), F.col(value).cast("double").alias("v"))
    r = r.where(F.col("k").isNotNull() & F.col("t").isNotNull() & F.col("i").isNotNull() & finite(F.col("v")))
    r = beside_key(r, block_lengths(r, rule.block_rows).drop("n")).withColumn("block", F.floor(F.col("t") / F.col("size"))).drop("size")
    order = ["k", "block", "t", "i"]
    blocks = r.select(*order, "v").repartition("k", "block").sortWithinPartitions(*order)
    summary = cut(blocks.mapInArrow(_summarise(rule), SUMMARY))
    context = cut(summary.drop("steps", "counts").repartition("k").sortWithinPartitions("k", "block").mapInArrow(_join_up(rule), CONTEXT))
    steps = summary.select("k", F.explode(F.arrays_zip("steps", "counts")).alias("h")).select("k", F.col("h.steps").alias("d"), F.col("h.counts").alias("n"))
    steps = steps.unionByName(context.where(F.col("cross").isNotNull()).select("k", F.col("cross").alias("d"), F.lit(1).cast("long").alias("n")))
    context = context.join(median_step(steps, rule.least_step), "k", "left")
    # a block's context goes before its readings, as rows of the same columns: a number each, told apart by their time
    one = lambda t, v: F.struct(F.lit(t).cast("long").alias("t"), v.cast("double").alias("v"))
    many = lambda c, t: F.transform(c, lambda v, j: F.struct((j + t).cast("long").alias("t"), v.alias("v")))
    about = F.concat(F.array(*(one(t, F.col(c)) for t, c in enumerate(("run_before", "run_after", "short")))), F.array(one(3, F.coalesce("step", F.lit(rule.least_step)))), many("before", BEFORE), many("after", AFTER))
    rows = context.select("k", "block", F.explode(about).alias("a")).select("k", "block", F.lit(False).alias("kind"), "a.t", F.lit(0).cast("long").alias("i"), "a.v")
    both = rows.unionByName(r.select("k", "block", F.lit(True).alias("kind"), "t", "i", "v"))
    both = both.repartition("k", "block").sortWithinPartitions("k", "block", "kind", "t", "i")
    found = both.mapInArrow(_judge(rule), "k string, i long, t long, v double, spike boolean, stuck boolean, impossible boolean")
    return found.select(F.col("k").alias(key), F.col("i").alias(ident), F.timestamp_micros("t").alias(time), F.col("v").alias(value), "spike", "stuck", "impossible")
