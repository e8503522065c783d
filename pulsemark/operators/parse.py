"""Text lines to typed rows.

A malformed line fails the job, as a cast does under ANSI rules. With
``quarantine=True`` nothing fails: rows carry ``raw`` and ``is_bad``, and
``split_bad`` parts them.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Position and type of each field of a behaviour line.
BEHAVIOR_FIELDS = {"user_id": "bigint", "item_id": "bigint", "category_id": "int",
                   "behavior": "string", "timestamp": "bigint"}
# Position of each field of an access-log line, and its time format
# (one letter per number, so that it may be padded or not).
LOG_FIELDS = {"ip": 0, "user_id": 1, "time": 3, "method": 5, "url": 6}
LOG_TIME_FORMAT = "d/M/yyyy:H:m:s"


def _field(parts: Column, position: int, quarantine: bool) -> Column:
    # parts[i] fails past the end under ANSI rules, get() gives null
    return F.trim(F.get(parts, position) if quarantine else parts[position])


def _once(lines: DataFrame, **columns: Column) -> DataFrame:
    """``columns`` alone, each worked out once per row however often fields, flag and filters name it: the optimizer copies
    an expression into its uses, but not through a generator."""
    return lines.select(F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def _raw_parts(lines: DataFrame, column: str, separator: str) -> DataFrame:
    return _once(_once(lines, raw=F.col(column)), raw=F.col("raw"), _parts=F.split("raw", separator))


def _flagged(rows: DataFrame, fields: list[str]) -> DataFrame:
    return rows.withColumn("is_bad", reduce(or_, [F.col(name).isNull() for name in fields]))


def behavior_rows(lines: DataFrame, column: str = "value", quarantine: bool = False, missing: bool = False) -> DataFrame:
    """``userId,itemId,categoryId,behavior,timestamp`` lines to behaviour rows.

    An empty field is malformed, unless ``missing``: then it is null.
    """
    if quarantine:
        lines = _raw_parts(lines, column, ",")
    parts = F.col("_parts") if quarantine else F.split(F.col(column), ",")
    fields = []
    for position, (name, kind) in enumerate(BEHAVIOR_FIELDS.items()):
        text = _field(parts, position, quarantine)
        if missing:
            text = F.nullif(text, F.lit(""))
        fields.append((text.try_cast(kind) if quarantine else text.cast(kind)).alias(name))
    if not quarantine:
        return lines.select(*fields)
    return _flagged(lines.select(*fields, "raw"), list(BEHAVIOR_FIELDS))


def access_rows(lines: DataFrame, column: str = "value", quarantine: bool = False) -> DataFrame:
    """``ip user - dd/MM/yyyy:H:mm:ss +0000 METHOD url`` lines to access-log rows.

    ``event_time`` is in ms. The zone in the line is not read; times are UTC
    whatever the session's zone.
    """
    if quarantine:
        lines = _raw_parts(lines, column, " ")
    parts = F.col("_parts") if quarantine else F.split(F.col(column), " ")
    text = {name: _field(parts, i, quarantine) for name, i in LOG_FIELDS.items()}
    parse = F.try_to_timestamp if quarantine else F.to_timestamp
    to_format = f"{LOG_TIME_FORMAT} X"
    when = parse(F.concat(text["time"], F.lit(" Z")), F.lit(to_format) if quarantine else to_format)
    fields = [text["ip"].alias("ip"), text["user_id"].alias("user_id"),
              F.unix_millis(when).alias("event_time"),
              text["method"].alias("method"), text["url"].alias("url")]
    if not quarantine:
        return lines.select(*fields)
    names = ["ip", "user_id", "event_time", "method", "url"]
    return _flagged(lines.select(*fields, "raw"), names)


def split_bad(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the raw text of the others."""
    return (rows.where(~F.col("is_bad")).drop("raw", "is_bad"),
            rows.where(F.col("is_bad")).select("raw"))


def page_view_rows(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("behavior") == "pv")


def get_requests(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("method") == "GET")
