"""Writing results so that a reader never sees a part of a table; telling what is complete, and clearing up after broken writes."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def write_table(df: DataFrame, path: str, fmt: str = "parquet", *, partition_by: list[str] | None = None) -> None:
    """Write beside the target, then swap; a failed write leaves the old table. Formats: parquet, csv, json, orc.

    The swap is two renames, as folders can't be exchanged in one: for that moment a reader finds no table, never a part of one.
    If the process dies in between, :func:`repair` puts the old table back."""
    if fmt not in ("parquet", "csv", "json", "orc"):
        raise ValueError(f"unknown format {fmt!r}")
    spark = df.sparkSession
    stage = f"{path}.staging-{uuid.uuid4().hex[:8]}"
    w = df.write.format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    (w.partitionBy(*partition_by) if partition_by else w).save(stage)
    fs, target = _fs(spark, path)
    old = _fs(spark, f"{path}.old-{uuid.uuid4().hex[:8]}")[1]
    had = fs.exists(target)
    if had and not fs.rename(target, old):
        raise OSError(f"can't move {path}")
    if not fs.rename(_fs(spark, stage)[1], target):
        if had:
            fs.rename(old, target)
        raise OSError(f"can't put {path} in place")
    if had:
        fs.delete(old, True)


def append_blocks(df: DataFrame, path: str, *, by: str) -> None:
    """Put the blocks (values of ``by``) that ``df`` holds in place of the same blocks of the table, others staying as they are; doing
    it again changes nothing."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def stamp(spark: SparkSession, path: str, attributes: dict) -> None:
    """Attributes of a table as one JSON file in its folder, which readers of the table pass over."""
    fs, p = _fs(spark, f"{path}/_attributes.json")
    out = fs.create(p, True)
    out.write(bytearray(json.dumps(attributes, sort_keys=True, default=str).encode()))
    out.close()


def attributes_of(spark: SparkSession, path: str) -> dict:
    """The attributes stamped on a table; none if there are none."""
    fs, p = _fs(spark, f"{path}/_attributes.json")
    if not fs.exists(p):
        return {}
    stream = spark._jvm.java.util.Scanner(fs.open(p), "UTF-8").useDelimiter("\\A")
    return json.loads(stream.next())


def is_complete(spark: SparkSession, path: str, expected: tuple[str, ...] = (), *, deep: bool = False, rows: int | None = None) -> bool:
    """Whether a finished table with the expected columns is there, with ``rows`` rows if given; ``deep`` also reads it."""
    fs, p = _fs(spark, path)
    if not fs.exists(p) or not fs.exists(_fs(spark, f"{path}/_SUCCESS")[1]):
        return False
    try:
        df = spark.read.parquet(path)
        if rows is not None and df.count() != rows:
            return False
        if deep:
            df.select(F.count("*"), *(F.count(c) for c in df.columns)).collect()
    except Exception:  # noqa: BLE001 - any unreadable file means incomplete
        return False
    return set(expected) <= set(df.columns)


def scan(spark: SparkSession, root: str, *, deep: bool = False) -> dict[str, list[str]]:
    """Tables below a folder: ``complete``, ``bad`` and ``scratch`` (left by broken writes)."""
    fs, p = _fs(spark, root)
    out: dict[str, list[str]] = {"complete": [], "bad": [], "scratch": []}
    for s in sorted((x for x in fs.listStatus(p) if x.isDirectory()), key=lambda x: x.getPath().getName()):
        name = s.getPath().getName()
        kind = "scratch" if ".staging-" in name or ".old-" in name else "complete" if is_complete(spark, f"{root}/{name}", deep=deep) else "bad"
        out[kind].append(name)
    return out


def repair(spark: SparkSession, root: str) -> dict[str, str]:
    """Clear up what broken writes left below a folder: an old table whose successor never came is put back, the rest is deleted.
    Returns what was done with each. Ask before calling it: another process may be writing."""
    fs, _ = _fs(spark, root)
    done: dict[str, str] = {}
    for name in scan(spark, root)["scratch"]:
        target = name.split(".staging-")[0].split(".old-")[0]
        at, to = _fs(spark, f"{root}/{name}")[1], _fs(spark, f"{root}/{target}")[1]
        if ".old-" in name and not fs.exists(to):
            fs.rename(at, to)
            done[name] = "put back"
        else:
            fs.delete(at, True)
            done[name] = "deleted"
    return done
