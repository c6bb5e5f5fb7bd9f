"""Time expressions: solar hours, reference instants, seasons, stamps in names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_hour(ts: Column) -> Column:
    """Hour of the day with minutes as a fraction; seconds are dropped."""
    return F.hour(ts) + F.minute(ts) / 60.0


def solar_hour(ts: Column, lon: Column) -> Column:
    """Local solar hour: UTC hour plus a fifteenth of the longitude, modulo 24."""
    h = F.hour(ts) + F.minute(ts) / 60.0 + F.second(ts) / 3600.0
    return F.pmod(h + lon / 15, F.lit(24.0))


def in_window(h: Column, lo: float, hi: float) -> Column:
    """Half-open window of hours; it wraps round midnight where lo > hi."""
    return (h >= lo) & (h < hi) if lo <= hi else (h >= lo) | (h < hi)


def reference_instant(day: Column, lon: Column, hours: float) -> Column:
    """The instant of a local solar hour on a day, to the nearest full hour; exact halves go to the even hour."""
    base = F.unix_timestamp(day.cast("timestamp"))
    return F.timestamp_seconds(base + F.bround(F.lit(hours) - lon / 15).cast("long") * 3600)


def clock_hours(text: str) -> float:
    """'10:30' as 10.5."""
    h, _, m = text.partition(":")
    hours, minutes = int(h), int(m or 0)
    if not (0 <= hours < 24 and 0 <= minutes < 60):
        raise ValueError(f"not a time of day: {text!r}")
    return hours + minutes / 60


def season(day: Column) -> tuple[Column, Column]:
    """Sine and cosine of the day of the year."""
    a = F.dayofyear(day) * (2 * 3.141592653589793 / 365.25)
    return F.sin(a), F.cos(a)


def stamp_in_name(name: Column) -> Column:
    """The instant of a YYYYMMDDThhmmss stamp in a name; NULL without one."""
    s = F.regexp_extract(name, r"_(\d{8}T\d{6})", 1)
    return F.try_to_timestamp(F.when(s != "", s), F.lit("yyyyMMdd'T'HHmmss"))


def model_cycle(hour: Column, step: int) -> Column:
    """The nearest model cycle (every ``step`` hours) to an hour of the day, at most the last of the day."""
    return F.least(F.floor((hour + step / 2) / step) * step, F.lit(24 - step)).cast("int")
