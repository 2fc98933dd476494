"""Event time: epoch numbers, timestamps, aligned windows and readable text."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

SECOND = 1_000_000
_UNITS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": SECOND,
    "minute": 60 * SECOND,
    "hour": 3_600 * SECOND,
    "day": 86_400 * SECOND,
}


def micros(duration: str | int) -> int:
    """Length of ``'90 seconds'``, ``'1 hour'`` ... in microseconds; ints pass through."""
    if isinstance(duration, int):
        return duration
    text = duration.strip().lower()
    parts = re.findall(r"(-?\d+)\s*([a-z]+?)s?(?=\s|$)", text)
    if not re.fullmatch(r"(-?\d+\s*[a-z]+(\s+|$))+", text) or any(unit not in _UNITS for _, unit in parts):
        raise ValueError(f"not a duration: {duration!r}")
    return sum(int(n) * _UNITS[unit] for n, unit in parts)


def interval(duration: str | int) -> Column:
    return F.expr(f"INTERVAL '{micros(duration) / SECOND:.6f}' SECOND")


def epoch_us(ts) -> Column:
    """Microseconds since 1970 of a timestamp (session zone is UTC)."""
    return F.unix_micros(_col(ts).cast("timestamp"))


def from_epoch_us(us) -> Column:
    return F.timestamp_micros(_col(us)).cast("timestamp_ntz")


def from_seconds(col) -> Column:
    """Event-time column from epoch seconds."""
    return F.timestamp_seconds(_col(col))


def from_millis(col) -> Column:
    """Event-time column from epoch milliseconds."""
    return F.timestamp_millis(_col(col))


def pane_index(ts, width: str | int, offset: str | int = 0) -> Column:
    """Number of the aligned ``width``-long pane a time lies in."""
    us, off = epoch_us(ts), micros(offset)
    shifted = us - F.lit(off) if off else us
    return floor_div(shifted, micros(width))


def floor_div(value: Column, width: int) -> Column:
    """Integer floor division, right for times before 1970 too."""
    w = F.lit(width).cast("bigint")
    return F.call_function("div", value - F.pmod(value, w), w)


def pane_start(index, width: str | int, offset: str | int = 0) -> Column:
    return from_epoch_us(_col(index) * F.lit(micros(width)) + F.lit(micros(offset)))


def tumbling(ts, size: str, offset: str | None = None) -> Column:
    """``[start, end)`` window of an event time; ``offset`` moves the grid (local midnight)."""
    if offset is None:
        return F.window(ts, size)
    start = micros(offset) % micros(size)
    return F.window(ts, size, size, f"{start // 1000} milliseconds")


def readable(ts, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(ts, pattern)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c
