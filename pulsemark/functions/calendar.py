"""Date and time keys. Text times are ``yyyy-MM-dd HH:mm:ss``.

Zone-free timestamps stay free of the session's zone: keys are cut out of their text, and differences are taken between
the timestamps, so no value is moved out of a daylight-saving gap.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The formats of text times and date keys.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_KEY_FORMAT = "yyyyMMdd"


def _cut(ts: Column, *pieces: tuple[int, int] | str) -> Column:
    """Pieces (position, length) of a time's text, and what is put between them."""
    text = ts.cast("string")
    return F.concat(*(F.lit(p) if isinstance(p, str) else F.substring(text, *p) for p in pieces))


YEAR, MONTH, DAY, HOUR, MINUTE = (1, 4), (6, 2), (9, 2), (12, 2), (15, 2)


def parse_time(text: Column) -> Column:
    return F.to_timestamp_ntz(text, F.lit(TIME_FORMAT))


def before(left: Column, right: Column) -> Column:
    return parse_time(left) < parse_time(right)


def after(left: Column, right: Column) -> Column:
    return parse_time(left) > parse_time(right)


def seconds_between(left: Column, right: Column) -> Column:
    """``left - right`` in seconds, as an int."""
    return (parse_time(left) - parse_time(right)).cast("interval second").cast("decimal(20, 6)").cast("int")


def date_hour(text: Column) -> Column:
    """Hour key of a text time."""
    return _cut(parse_time(text), YEAR, "-", MONTH, "-", DAY, "_", HOUR)


def today_text(as_of: Column) -> Column:
    return format_date(as_of)


def yesterday_text(as_of: Column) -> Column:
    return format_date(F.date_sub(as_of, 1))


def format_date(ts: Column) -> Column:
    return _cut(ts, DAY, "/", MONTH, "/", YEAR)


def format_time(ts: Column) -> Column:
    return _cut(ts, (1, 19))


def date_key(ts: Column) -> Column:
    return _cut(ts, YEAR, MONTH, DAY)


def parse_date_key(key: Column) -> Column:
    return F.to_date(key, DATE_KEY_FORMAT)


def minute_key(ts: Column) -> Column:
    return _cut(ts, YEAR, MONTH, DAY, HOUR, MINUTE)
