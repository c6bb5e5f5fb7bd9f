"""Pairing records of two tables by nearest time for the same entity, within a tolerance."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skerry.runtime import beside_key, block_lengths

ROWS_PER_GROUP = 200_000  # rows of both tables that a task holds at once, about


def _codes(left: pa.Table, right: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Integer codes of (entity, block), alike in both tables."""
    both = pa.chunked_array([*left.column("k").chunks, *right.column("k").chunks], pa.string()).combine_chunks()
    code = pc.dictionary_encode(both).indices.to_numpy(zero_copy_only=False).astype(np.int64) if len(both) else np.empty(0, np.int64)
    block = np.concatenate([left.column("block").to_numpy(), right.column("block").to_numpy()]).astype(np.int64)
    if block.size:
        block -= block.min()
        code = code * (block.max() + 1) + block
    return code[: left.num_rows], code[left.num_rows :]


def _search(tol: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = pa.schema([("lid", pa.int64()), ("rid", pa.int64()), ("dt_us", pa.int64())])
        if not left.num_rows or not right.num_rows:
            return out.empty_table()
        cl, cr = _codes(left, right)
        tl, tr = left.column("t").to_numpy(), right.column("t").to_numpy()
        rid = right.column("i").to_numpy()
        # one axis for all groups: group g lies at g * span; spans are so far apart that no group sees another's rows
        t0 = min(tl.min(), tr.min())
        order = np.lexsort((rid, tr, cr))
        cr, tr, rid = cr[order], tr[order], rid[order]
        first = np.concatenate([[True], (cr[1:] != cr[:-1]) | (tr[1:] != tr[:-1])])  # of equal times the smaller id
        cr, tr, rid = cr[first], tr[first], rid[first]
        # ranks of (group, time) pairs by binary search within the group's run
        lo = np.searchsorted(cr, cl, "left")
        hi = np.searchsorted(cr, cl, "right")
        dense = np.unique(cr, return_inverse=True)
        span = int(max(tl.max(), tr.max()) - t0) + 1
        if len(dense[0]) * span < 2**62:
            g = np.searchsorted(dense[0], cl)
            key = dense[1].astype(np.int64) * span + (tr - t0)
            at = np.searchsorted(key, np.minimum(g, len(dense[0]) - 1) * span + (tl - t0), "left")
        else:  # the axis would overflow: search group by group
            at = lo.copy()
            for c in np.unique(cl):
                own = np.flatnonzero(cl == c)
                a, b = lo[own[0]], hi[own[0]]
                at[own] = a + np.searchsorted(tr[a:b], tl[own], "left")
        at = np.clip(at, lo, hi)
        far = np.int64(2**62)
        prev, nxt = at - 1, at
        dp = np.where(prev >= lo, tl - tr[np.maximum(prev, 0)], far)
        dn = np.where(nxt < hi, tr[np.minimum(nxt, tr.size - 1)] - tl, far)
        pick = np.where(dp <= dn, prev, nxt)  # of equal distances the earlier
        ok = np.minimum(dp, dn) <= tol
        pick = pick[ok]
        return pa.table({"lid": left.column("i").to_numpy()[ok], "rid": rid[pick], "dt_us": tr[pick] - tl[ok]}, schema=out)

    return run


def match_nearest(
    left: DataFrame,
    right: DataFrame,
    *,
    tolerance_s: float = 3600,
    left_keys: tuple[str, str, str] = ("overpass_id", "station_id", "time"),
    right_keys: tuple[str, str, str] = ("obs_id", "station_id", "time"),
    right_ok: Column | None = None,
    block_rows: int = 10_000,
    groups: int | None = None,
) -> DataFrame:
    """For each left id the nearest right row of the same entity: ``left id, right id, dt_us`` (right minus left time).

    keys: id, entity and time columns. The tolerance is inclusive, before or after; of equal distances the earlier right row,
    then the smaller id. Left ids without a partner give no row, as do rows whose id, entity or time is NULL; blanks around an
    entity don't count; a left id given again counts once if entity and time are the same (else its nearest partner of
    all is kept). Right rows where ``right_ok`` isn't true take no part. Either table may be empty; other columns are not looked at.

    Both tables are co-grouped by a hash of (entity, time range), right rows within the tolerance of a range's edge also going to
    the range beyond, so that each group is complete in itself and a hot entity spreads over all groups. An entity's ranges
    are as long as hold about ``block_rows`` of its rows of both tables (more than twice the tolerance, so that a row goes to two
    at most), and there are so many groups (default: by the rows, counted) that each holds about 200,000 rows, however
    many the tables have. In a group, neighbours are found by vectorised binary search.
    """
    spark = left.sparkSession
    tol = int(tolerance_s * 1_000_000)

    def rows(df: DataFrame, keys: tuple[str, str, str]) -> DataFrame:
        ident, entity, time = (df[c] for c in keys)
        r = df.select(ident.cast("long").alias("i"), F.trim(F.translate(entity.cast("string"), "\t", " ")).alias("k"), F.unix_micros(time.cast("timestamp")).alias("t"))
        return r.where(F.col("i").isNotNull() & F.col("k").isNotNull() & F.col("t").isNotNull())

    at = rows(left, left_keys)
    of = rows(right if right_ok is None else right.where(right_ok), right_keys)
    lengths = block_lengths(at.select("k", "t").unionByName(of.select("k", "t")), block_rows, 2 * tol + 1)
    if groups is None:
        total = lengths.agg(F.sum("n")).first()[0] or 0
        groups = max(8 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // ROWS_PER_GROUP))
    size = F.col("size")
    at = beside_key(at.dropDuplicates(["i", "k", "t"]), lengths.drop("n")).withColumn("block", F.floor(F.col("t") / size))
    of = beside_key(of, lengths.drop("n"))
    a, b = F.floor((F.col("t") - tol) / size), F.floor((F.col("t") + tol) / size)
    of = of.withColumn("block", F.explode(F.when(a == b, F.array(a)).otherwise(F.array(a, b))))
    group = F.pmod(F.xxhash64("k", "block"), F.lit(groups)).alias("g")
    at, of = (x.select("i", "k", "t", "block", group) for x in (at, of))
    found = at.groupBy("g").cogroup(of.groupBy("g")).applyInArrow(lambda x, y: _search(tol)(x, y), "lid long, rid long, dt_us long")
    best = F.min(F.struct(F.abs("dt_us").alias("d"), F.col("dt_us").alias("dt_us"), F.col("rid").alias("rid")))
    return found.groupBy("lid").agg(best.alias("b")).select(F.col("lid").alias(left_keys[0]), F.col("b.rid").alias(right_keys[0]), F.col("b.dt_us").alias("dt_us"))
