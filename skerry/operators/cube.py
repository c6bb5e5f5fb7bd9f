"""Assembling a daily cube: spine and cells, channels side by side, missing work, blocks."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skerry.functions.geo import Grid


def cells(areas: DataFrame, grid: Grid) -> DataFrame:
    """Every cell of the grid for each row of ``areas``: ``*, row, col``."""
    return areas.withColumn("row", F.explode(F.sequence(F.lit(0), F.lit(grid.height - 1)))).withColumn("col", F.explode(F.sequence(F.lit(0), F.lit(grid.width - 1))))


def stack(wide: DataFrame, keys: list[str], channels: list[str]) -> DataFrame:
    """Wide channels as rows ``*keys, channel, value``."""
    return wide.unpivot(keys, channels, "channel", "value")


def side_by_side(long: DataFrame, keys: list[str], channels: list[str], *, channel: str = "channel", value: str = "value") -> DataFrame:
    """Rows as wide channels; the channels are given, so no pass over the data is needed to find them."""
    return long.groupBy(*keys).pivot(channel, channels).agg(F.first(value, ignorenulls=True))


def by_source(static: DataFrame, keys: list[str], fields: list[str], sources: list[str]) -> DataFrame:
    """One column ``<field>_<source>`` a field and source: sources stand beside each other and never fill one another."""
    return static.groupBy(*keys).agg(*(F.max(F.when(F.col("source") == s, F.col(f))).alias(f"{f}_{s}") for f in fields for s in sources))


def missing_work(wanted: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Wanted keys that aren't done."""
    return wanted.join(done.select(*keys).distinct(), keys, "left_anti")


def covers(stored_start: Column, stored_end: Column, start: Column, end: Column) -> Column:
    """Whether a stored range covers a wanted one; a range that isn't stamped does not."""
    return F.coalesce((stored_start <= start) & (stored_end >= end), F.lit(False))


@dataclass(frozen=True)
class Contributor:
    """A fragment of the cube: what it needs, what it gives, and how it is made from the frames so far."""

    name: str
    make: Callable[[dict[str, DataFrame]], DataFrame]
    keys: tuple[str, ...]
    depends_on: tuple[str, ...] = ()
    fills: dict[str, float] = field(default_factory=dict)


def in_order(parts: list[Contributor]) -> list[Contributor]:
    """Parts after those that they depend on, otherwise as declared. Unknown or circular dependencies raise ValueError."""
    by_name = {p.name: p for p in parts}
    if len(by_name) != len(parts):
        raise ValueError("two parts have one name")
    for p in parts:
        if unknown := set(p.depends_on) - set(by_name):
            raise ValueError(f"{p.name} depends on unknown {', '.join(sorted(unknown))}")
    done: list[Contributor] = []
    left = list(parts)
    while left:
        ready = next((p for p in left if all(d in {x.name for x in done} for d in p.depends_on)), None)
        if ready is None:
            raise ValueError(f"circular: {', '.join(p.name for p in left)}")
        done.append(ready)
        left.remove(ready)
    return done


def assemble(base: DataFrame, parts: list[Contributor]) -> DataFrame:
    """The base (every day and cell) with each part's channels joined on its keys; days and cells without a value are missing, or
    filled where the part says so. Parts see the frames of the parts before them."""
    frames: dict[str, DataFrame] = {}
    out = base
    for p in in_order(parts):
        frames[p.name] = p.make(frames)
        out = out.join(frames[p.name], list(p.keys), "left")
        out = out.fillna(p.fills) if p.fills else out
    return out


def same_schema(got: DataFrame, census: DataFrame) -> None:
    """Refuse a block whose channels differ from the census."""
    a, b = dict(got.dtypes), dict(census.dtypes)
    if a != b:
        raise ValueError(f"channels differ: missing {sorted(set(b) - set(a))}, new {sorted(set(a) - set(b))}, changed {sorted(c for c in a if c in b and a[c] != b[c])}")


def day_blocks(df: DataFrame, start: str, days: int, day: str = "day") -> DataFrame:
    """Rows of the same ``days`` days in one partition, so that a table is written in files of whole days; adaptive execution
    may split none of them, and a block is as large as its days."""
    block = F.floor(F.datediff(F.col(day), F.to_date(F.lit(start))) / days)
    return df.withColumn("_block", block).repartition("_block").drop("_block")


def block_days(df: DataFrame, grid: Grid, budget_bytes: int) -> int:
    """How many days of a dense cube fit in a budget, at least one."""
    return max(1, budget_bytes // max(bytes_per_day(df, grid), 1))


def bytes_per_day(df: DataFrame, grid: Grid, keys: tuple[str, ...] = ("day", "row", "col")) -> int:
    """Size of a day of a dense cube."""
    size = {"double": 8, "float": 4, "bigint": 8, "int": 4, "smallint": 2, "tinyint": 1, "boolean": 1, "date": 4, "timestamp": 8}
    return sum(size.get(t, 8) for c, t in df.dtypes if c not in keys) * grid.height * grid.width
