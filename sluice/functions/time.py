"""Event-time helpers.

Timestamps in the test tables are TIMESTAMP_NTZ.  Conversions to epoch numbers
use ``timestampdiff`` against the NTZ epoch so the result never depends on the
session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _div(c: Column, n: int) -> Column:
    """Exact floor division of a BIGINT by a positive constant (the numerator
    is first made an exact multiple of ``n``)."""
    q = c.cast("bigint")
    return ((q - F.pmod(q, F.lit(n))) / F.lit(n)).cast("bigint")


def floor_div(col, n: int) -> Column:
    """Exact ``floor(col / n)`` for BIGINT ``col`` and a positive constant."""
    return _div(_c(col), n)


def epoch_us(col) -> Column:
    """Microseconds since 1970-01-01 of an NTZ timestamp (zone free)."""
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), _c(col))


def epoch_ms(col) -> Column:
    """Milliseconds since the epoch, floored (the reference's long time unit)."""
    return _div(epoch_us(col), 1000)


def epoch_seconds(col) -> Column:
    return _div(epoch_us(col), 1_000_000)


def from_epoch_seconds(col) -> Column:
    """Seconds (the reference's ``ts`` field) -> NTZ event time."""
    return F.timestamp_add("SECOND", _c(col), F.expr(_EPOCH_NTZ))


def from_epoch_us(col) -> Column:
    return F.timestamp_add("MICROSECOND", _c(col), F.expr(_EPOCH_NTZ))


def from_epoch_ms(col) -> Column:
    return F.timestamp_add("MILLISECOND", _c(col), F.expr(_EPOCH_NTZ))


def shift_seconds(col, seconds) -> Column:
    """``col + seconds`` for NTZ or zoned timestamps; ``seconds`` may be a column."""
    s = seconds if isinstance(seconds, Column) else F.lit(seconds)
    return F.timestamp_add("SECOND", s, _c(col))


def duration_us(text: str) -> int:
    """'6 hours' / '10 seconds' / '1 day' -> microseconds."""
    n, unit = text.split()
    unit = unit.rstrip("s").lower()
    scale = {
        "microsecond": 1,
        "millisecond": 1_000,
        "second": 1_000_000,
        "minute": 60_000_000,
        "hour": 3_600_000_000,
        "day": 86_400_000_000,
    }[unit]
    return int(n) * scale
