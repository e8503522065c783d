"""The ``events`` table seen as each of the input streams.

Filters are put on the table's own columns, so that they reach the Parquet scan;
only then are the values renamed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.event_time import epoch_us, us_to_ntz

# What each event type stands for.
BEHAVIORS = {"view": "pv", "purchase": "buy", "click": "cart", "signup": "fav"}
ORDER_STEPS = {"click": "create", "purchase": "pay"}


def table(spark: SparkSession, folder: str, name: str = "events") -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _renamed(column: str, names: dict[str, str], only: bool = True) -> Column:
    """The new name of a value; of others, unless ``only`` named ones are there, the value itself."""
    value = F.col(column)
    if only and len(names) == 1:
        return F.lit(next(iter(names.values())))
    cases = F
    for old, new in names.items():
        cases = cases.when(value == old, new)
    return cases if only else cases.otherwise(value)


def number() -> Column:
    """The member ``k`` of the JSON in ``props``; one that is no whole number fails the job."""
    return F.get_json_object("props", "$.k").cast("bigint")


def user_behavior(events: DataFrame, only: Sequence[str] | None = None) -> DataFrame:
    """Behaviour rows; ``only`` keeps some behaviours (``['pv']``). Event types without a behaviour keep their name."""
    names = {old: new for old, new in BEHAVIORS.items() if only is None or new in only}
    if only is not None:
        events = events.where(F.col("event_type").isin(*names))
    return events.select(
        "event_id", "ts", "user_id", number().alias("item_id"),
        F.pmod(number(), F.lit(20)).cast("int").alias("category_id"),
        _renamed("event_type", names, only is not None).alias("behavior"),
    )


def behavior_lines(events: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Behaviour rows as CSV lines, with the time in ms; a missing value leaves its field empty."""
    rows = user_behavior(events)
    ms = F.unix_millis(F.timestamp_micros(epoch_us(rows, "ts")))
    return rows.select(
        *keep, F.concat_ws(",", *(F.coalesce(c.cast("string"), F.lit("")) for c in (
            F.col("user_id"), F.col("item_id"), F.col("category_id"), F.col("behavior"), ms))).alias("value")
    )


def access_lines(events: DataFrame) -> DataFrame:
    """Access-log lines; views are GET, all else POST."""
    text = us_to_ntz(epoch_us(events, "ts")).cast("string")
    hour = F.substring(text, 12, 2).cast("int").cast("string")
    time = F.concat(
        F.substring(text, 9, 2), F.lit("/"), F.substring(text, 6, 2), F.lit("/"), F.substring(text, 1, 4),
        F.lit(":"), hour, F.substring(text, 14, 6),
    )
    ip = F.concat(F.lit("192.168."), F.pmod("user_id", F.lit(256)), F.lit("."),
                  F.pmod(F.expr("user_id div 256"), F.lit(256)))
    return events.select(F.concat_ws(
        " ", ip, F.lit("-"), F.lit("-"), time, F.lit("+0000"),
        F.when(F.col("event_type") == "view", "GET").otherwise("POST"),
        F.concat(F.lit("/www/"), F.pmod(number(), F.lit(10))),
    ).alias("value"))


def market_behavior(events: DataFrame, installed: bool = False) -> DataFrame:
    """Marketing rows: errors are uninstalls, the channel comes from ``k``.

    ``installed`` leaves the uninstalls out at the scan.
    """
    if installed:
        events = events.where(F.col("event_type") != "error")
    behavior = F.when(F.col("event_type") == "error", "UNINSTALL").otherwise(F.col("event_type"))
    return events.select(
        "event_id", "ts", F.col("user_id").cast("string").alias("user_id"),
        behavior.alias("behavior"), F.pmod(number(), F.lit(4)).cast("string").alias("channel"),
    )


def login_events(events: DataFrame, failed: bool = False) -> DataFrame:
    """Login rows: errors are failed logins, all else successes.

    ``failed`` keeps the failed logins only, at the scan.
    """
    if failed:
        events = events.where(F.col("event_type") == "error")
    return events.select(
        "event_id", "user_id", F.concat(F.lit("10.0.0."), F.pmod(number(), F.lit(256))).alias("ip"),
        F.when(F.col("event_type") == "error", "fail").otherwise("success").alias("event_type"),
        F.col("ts").alias("event_time"),
    )


def order_events(events: DataFrame) -> DataFrame:
    """Order rows, one order per user: clicks create, purchases pay."""
    return events.where(F.col("event_type").isin(*ORDER_STEPS)).select(
        "event_id", F.col("user_id").alias("order_id"),
        _renamed("event_type", ORDER_STEPS).alias("event_type"), F.col("ts").alias("event_time"),
    )
