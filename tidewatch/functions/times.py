"""Time expressions.

Ordered operators work on epoch microseconds (BIGINT): alignment is then plain integer
arithmetic, the same for TIMESTAMP and TIMESTAMP_NTZ and before 1970.
"""

from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
}


def micros(span: str | timedelta) -> int:
    """``"15 seconds"`` or a timedelta as whole microseconds."""
    if isinstance(span, timedelta):
        return span // timedelta(microseconds=1)
    number, unit = span.split()
    return int(number) * _MICROS[unit.removesuffix("s")]


def epoch_micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def at_micros(us: Column, like: T.DataType | None = None) -> Column:
    """Epoch microseconds back to a timestamp of type ``like`` (TIMESTAMP by default)."""
    stamp = F.timestamp_micros(us)
    return stamp.cast(like) if isinstance(like, T.TimestampNTZType) else stamp


def floor_to(us: Column, width: int) -> Column:
    return us - F.pmod(us, F.lit(width))


def ceil_to(us: Column, width: int) -> Column:
    return us + F.pmod(-us, F.lit(width))


def from_epoch_millis(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def from_epoch_seconds(s: Column) -> Column:
    return F.timestamp_seconds(s)


def now_millis() -> Column:
    return F.unix_millis(F.current_timestamp())


def time_order(ts: Column, tiebreak: Column) -> Column:
    """Order by time, then by a BIGINT, as one DECIMAL.

    Of fixed width, unlike a struct, so that min_by and max_by stay hash aggregates. Holds for
    all times a TIMESTAMP can be written as.
    """
    span = F.lit("20000000000000000000").cast("decimal(20,0)")  # more than BIGINT has values
    us = epoch_micros(ts).cast("decimal(18,0)")
    return (us * span).cast("decimal(38,0)") + tiebreak.cast("decimal(19,0)")
