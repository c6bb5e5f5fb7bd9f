"""Time zones as vectors: offsets and abbreviations of a zone at many instants at once."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta
from functools import lru_cache
from zoneinfo import ZoneInfo, ZoneInfoNotFoundError

import numpy as np

FIRST, LAST, WEEK = -2_208_988_800, 5_680_281_600, 604_800  # 1900 to 2150, in seconds since 1970


@lru_cache(maxsize=1024)
def periods(zone: str) -> tuple[np.ndarray, np.ndarray, tuple[str, ...]]:
    """Starts (seconds since 1970 UTC), offsets (seconds) and abbreviations of a zone's periods. An unknown zone raises."""
    z = ZoneInfo(zone)
    epoch = datetime(1970, 1, 1, tzinfo=UTC)

    def at(s: int) -> tuple[int, str]:
        t = (epoch + timedelta(seconds=s)).astimezone(z)
        return int(t.utcoffset().total_seconds()), t.tzname() or ""

    starts, what = [FIRST], [at(FIRST)]
    for s in range(FIRST + WEEK, LAST, WEEK):
        now = at(s)
        if now != what[-1]:
            lo, hi = s - WEEK, s
            while hi - lo > 1:
                mid = (lo + hi) // 2
                lo, hi = (mid, hi) if at(mid) == what[-1] else (lo, mid)
            starts.append(hi)
            what.append(now)
    return np.array(starts), np.array([o for o, _ in what]), tuple(a for _, a in what)


def offsets(zone: str, utc_s: np.ndarray) -> np.ndarray:
    """Offset from UTC in seconds at each instant."""
    starts, off, _ = periods(zone)
    return off[np.clip(np.searchsorted(starts, utc_s, "right") - 1, 0, None)]


def instants(zone: str, wall_s: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The instants that a wall time denotes: first, whether it exists, second, whether it exists.

    A wall time skipped by a clock change has none, one that occurs twice has two (the earlier first).
    """
    before, after = offsets(zone, wall_s - 86_400), offsets(zone, wall_s + 86_400)
    u1, u2 = wall_s - np.maximum(before, after), wall_s - np.minimum(before, after)
    ok1, ok2 = wall_s - u1 == offsets(zone, u1), wall_s - u2 == offsets(zone, u2)
    return u1, ok1, u2, ok2 & (u1 != u2)


@lru_cache(maxsize=1024)
def known(zone: str) -> bool:
    """Whether there is such a zone."""
    try:
        ZoneInfo(zone)
    except (ZoneInfoNotFoundError, ValueError, OSError):
        return False
    return True


@lru_cache(maxsize=1024)
def abbreviations(zone: str) -> dict[str, tuple[int, ...]]:
    """Offsets that each of the zone's abbreviations stands for, as used since 1970."""
    starts, off, names = periods(zone)
    out: dict[str, set[int]] = {}
    until = np.append(starts[1:], LAST)
    for o, a, e in zip(off, names, until, strict=True):
        if e > 0 and a.isalpha():
            out.setdefault(a.upper(), set()).add(int(o))
    return {a: tuple(sorted(o)) for a, o in out.items()}
