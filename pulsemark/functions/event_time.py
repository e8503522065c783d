"""Event time as microseconds since the epoch, whatever the column's type.

Operators order and bucket by one bigint, so results do not depend on the
session time zone and grouping keys stay fixed-width.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, TimestampNTZType, TimestampType

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"
_UTC = ("UTC", "Etc/UTC", "GMT", "Z", "+00:00")
_PER_UNIT = {"us": 1, "ms": 1_000, "s": 1_000_000}
_INTERVALS = {"microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000,
              "hour": 3_600_000_000, "day": 86_400_000_000}


def micros(duration: str | timedelta) -> int:
    """Length of ``'15 minutes'`` or a timedelta, in microseconds."""
    if isinstance(duration, timedelta):
        return duration // timedelta(microseconds=1)
    amount, unit = duration.split()
    return int(amount) * _INTERVALS[unit.rstrip("s")]


def interval(duration: str | timedelta) -> str:
    """The same duration as the text ``F.window`` and ``withWatermark`` take."""
    return f"{micros(duration)} microseconds"


def epoch_us(df: DataFrame, column: str, unit: str | None = None) -> Column:
    """``column`` as epoch microseconds. Integer columns must name their unit."""
    kind = df.schema[column].dataType
    if isinstance(kind, TimestampType):
        return F.unix_micros(F.col(column))
    if isinstance(kind, TimestampNTZType):
        if df.sparkSession.conf.get("spark.sql.session.timeZone") in _UTC:
            return F.unix_micros(F.col(column).cast("timestamp"))  # free of any arithmetic
        # a cast would read the value as local time and move it in a daylight-saving gap
        seconds = f"CAST(CAST(`{column}` - {_EPOCH} AS INTERVAL SECOND) AS decimal(20, 6))"
        return F.expr(f"CAST({seconds} * 1000000 AS bigint)")
    if isinstance(kind, IntegralType):
        if unit not in _PER_UNIT:
            raise ValueError(f"{column} is an integer: give its unit, one of {sorted(_PER_UNIT)}")
        return F.col(column).cast("bigint") * F.lit(_PER_UNIT[unit])
    raise TypeError(f"{column} has type {kind.simpleString()}, not a time")


def event_time(df: DataFrame, column: str, unit: str | None = None, to: str = "ts") -> DataFrame:
    """Add ``to`` as a TIMESTAMP, the type watermarks need."""
    return df.withColumn(to, F.timestamp_micros(epoch_us(df, column, unit)))


def floor_to(us: Column, step: int) -> Column:
    """Largest multiple of ``step`` not above ``us``, also before 1970."""
    return us - F.pmod(us, F.lit(step).cast("bigint"))


def us_to_ntz(us: Column) -> Column:
    """Epoch microseconds as a zone-free timestamp."""
    return F.timestamp_add("MICROSECOND", us, F.expr(_EPOCH))


def to_ms(us: Column) -> Column:
    """Whole milliseconds of an epoch in microseconds, without a double in between."""
    return F.unix_millis(F.timestamp_micros(us))


def timestamp_text(us: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss.f``: at least one fraction digit, no trailing zeros."""
    text = us_to_ntz(us).cast("string")
    return F.when(F.instr(text, ".") > 0, text).otherwise(F.concat(text, F.lit(".0")))
