"""Event patterns per user or order, as window functions over short stretches.

Every pattern here ends within a fixed time of its start, so a key is cut into
stretches of time (``plans.lookahead``) and one sort per stretch answers all
steps of the pattern. Look-ahead uses ``lead`` with IGNORE NULLS, which advances
through the rows once; a frame that reaches to the end of the group would be
recomputed for every row.

Rows are ordered by (time, event id); rows without a time take part in no pattern.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.event_time import epoch_us, micros
from ..plans.lookahead import STRETCH, with_lookahead

FAIL = "fail"
CREATE, PAY = "create", "pay"
SUCCESS, TIMEOUT = "success", "timeout"


def _next(value: str, steps: int, key: str) -> Column:
    """The ``steps``-th following non-null ``value`` of the key."""
    return F.expr(
        f"lead({value}, {steps}) IGNORE NULLS OVER (PARTITION BY `{key}`, _stretch ORDER BY _us, _id)"
    )


def _ordered(rows: DataFrame, ts: str, unit: str | None, event_id: str) -> DataFrame:
    return rows.where(F.col(ts).isNotNull()).withColumns(
        {"_us": epoch_us(rows, ts, unit), "_id": F.col(event_id)}
    )


def fail_sequences(logins: DataFrame, fails: int = 3, within="2 seconds", consecutive: bool = False,
                   ts: str = "event_time", unit: str | None = None, event_id: str = "event_id",
                   stretch: int = STRETCH) -> DataFrame:
    """A failed login, directly followed by another, then more up to ``fails``.

    The last must come less than ``within`` after the first. From the third on
    other events may lie in between, unless ``consecutive``. Every failed login
    may start a match; the output names the *second* event of it.
    """
    if fails < 2:
        raise ValueError("a sequence has at least two failed logins")
    reach = micros(within)
    order = Window.partitionBy("user_id", "_stretch").orderBy("_us", "_id")
    rows = with_lookahead(_ordered(logins, ts, unit, event_id), F.col("_us"), reach, stretch)
    rows = rows.withColumn("_fail", F.col("event_type") == FAIL).withColumn(
        "_fail_us", F.when(F.col("_fail"), F.col("_us"))
    )
    adjacent = [F.lead("_fail", step).over(order) for step in range(1, fails if consecutive else 2)]
    matched = rows.select(
        "user_id", "_home", "_fail", "_us",
        F.lead("ip").over(order).alias("ip"),
        F.lead("event_type").over(order).alias("event_type"),
        F.col("_id").alias("start_id"),
        F.lead("_id").over(order).alias("event_id"),
        _next("_fail_us", fails - 1, "user_id").alias("_last_us"),
        *[step.alias(f"_step{i}") for i, step in enumerate(adjacent)],
    )
    hit = F.col("_home") & F.col("_fail") & (F.col("_last_us") < F.col("_us") + F.lit(reach))
    for i in range(len(adjacent)):
        hit = hit & F.col(f"_step{i}")
    return matched.where(hit).select("user_id", "start_id", "event_id", "ip", "event_type")


def fail_pairs(logins: DataFrame, within="2 seconds", ts: str = "event_time",
               unit: str | None = None, event_id: str = "event_id",
               stretch: int = STRETCH) -> DataFrame:
    """Two failed logins of a user with nothing in between, less than ``within`` apart."""
    reach = micros(within)
    order = Window.partitionBy("user_id", "_stretch").orderBy("_us", "_id")
    rows = with_lookahead(_ordered(logins, ts, unit, event_id), F.col("_us"), reach, stretch)
    return (
        rows.select(
            "user_id", "_home", "_us", "event_type",
            F.col("_id").alias("first_id"), F.col("ip").alias("first_ip"),
            F.lead("_id").over(order).alias("second_id"), F.lead("ip").over(order).alias("second_ip"),
            F.lead("event_type").over(order).alias("_next_type"), F.lead("_us").over(order).alias("_next_us"),
        )
        .where(F.col("_home") & (F.col("event_type") == FAIL) & (F.col("_next_type") == FAIL)
               & (F.col("_next_us") < F.col("_us") + F.lit(reach)))
        .select("user_id", "first_id", "first_ip", "second_id", "second_ip")
    )


def order_results(orders: DataFrame, within="15 minutes", strict: bool = False,
                  ts: str = "event_time", unit: str | None = None, event_id: str = "event_id",
                  stretch: int = STRETCH) -> DataFrame:
    """Per ``create``: ``success`` if a ``pay`` follows less than ``within`` later, else ``timeout``.

    A ``pay`` without a ``create`` gives nothing. With ``strict`` the very next
    event must be the ``pay``; if another event comes first in time, the order
    gives no result at all.
    """
    reach = micros(within)
    rows = _ordered(orders, ts, unit, event_id)
    if not strict:
        rows = rows.where(F.col("event_type").isin(CREATE, PAY))
    rows = with_lookahead(rows, F.col("_us"), reach, stretch).withColumn(
        "_pay_us", F.when(F.col("event_type") == PAY, F.col("_us"))
    )
    # a copied create has no say in the relaxed pattern
    if not strict:
        rows = rows.where(F.col("_home") | F.col("_pay_us").isNotNull())
    in_time = F.col("_found_us") < F.col("_us") + F.lit(reach)
    found = "_us" if strict else "_pay_us"
    result = F.when(F.coalesce(in_time, F.lit(False)), F.lit(SUCCESS)).otherwise(TIMEOUT)
    if strict:
        result = F.when(F.coalesce(in_time & (F.col("_found_type") != PAY), F.lit(False)), None) \
            .otherwise(result)
    return (
        rows.select(
            "order_id", "event_type", "_home", "_us", F.col("_id").alias("create_id"),
            _next(found, 1, "order_id").alias("_found_us"),
            *([_next("event_type", 1, "order_id").alias("_found_type")] if strict else []),
        )
        .where(F.col("_home") & (F.col("event_type") == CREATE))
        .select("order_id", "create_id", result.alias("event_type"))
        .where("event_type IS NOT NULL")
    )


def split_results(results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The main output (``success``) and the side output (``timeout``)."""
    return (results.where(F.col("event_type") == SUCCESS), results.where(F.col("event_type") == TIMEOUT))


def _with_burst(moments: DataFrame, reach: int, stretch: int, payload: list[str]) -> DataFrame:
    """Name the burst of each moment (a distinct time ``_us`` of a user).

    Every moment sets a cut ``reach`` later, and at a cut all that was collected
    is handed out. So a moment belongs to the first cut at or after it, the one
    set by the earliest moment not more than ``reach`` before: ``burst_us``.

    Each moment with failed logins (``_n``) asks, at its time less ``reach``, for
    the next moment. Asking and asked rows are sorted together, and one pass
    answers all.
    """
    def mark(at: Column, kind: int, moment: Column, keep: bool) -> Column:
        kept = [F.when(F.lit(keep), F.col(name)).alias(name) for name in payload]
        return F.struct(at.alias("_us"), F.lit(kind).alias("_id"), moment.alias("_moment"),
                        F.col("_us").alias("_own"), *kept)

    us = F.col("_us")
    asked = mark(us, 1, us, keep=False)
    asking = mark(us - F.lit(reach), 0, F.lit(None).cast("bigint"), keep=True)
    marks = moments.select("user_id", F.inline(
        F.when(F.col("_n") > 0, F.array(asked, asking)).otherwise(F.array(asked))
    ))
    # an asking row is never copied: only moments are looked at
    marks = with_lookahead(marks, us, reach, stretch).where("_home OR _id = 1")
    return (
        marks.withColumn("burst_us", _next("_moment", 1, "user_id")).where("_id = 0")
        .select("user_id", "burst_us", F.col("_own").alias("_us"), *payload)
    )


def fail_bursts(logins: DataFrame, within="2 seconds", ts: str = "event_time",
                unit: str | None = None, event_id: str = "event_id",
                stretch: int = STRETCH) -> DataFrame:
    """Bursts of two or more failed logins: the first of each, and the burst's ``size``.

    Rows at one instant are folded together before the first shuffle.
    """
    reach = micros(within)
    fails = _ordered(logins, ts, unit, event_id).where(F.col("event_type") == FAIL)
    moments = fails.groupBy("user_id", "_us").agg(
        F.count(F.lit(1)).alias("_n"),
        F.min(F.struct("_id", "ip", "event_type", F.col(ts).alias("event_time"))).alias("_head"),
    )
    return (
        _with_burst(moments, reach, stretch, ["_n", "_head"])
        .groupBy("user_id", "burst_us")
        .agg(F.sum("_n").alias("size"), F.min(F.struct("_us", "_head")).alias("_first"))
        .where("size > 1")
        .select("user_id", F.col("_first._head._id").alias("event_id"), "_first._head.ip",
                "_first._head.event_type", "_first._head.event_time", "size")
    )


def fail_burst_members(logins: DataFrame, within="2 seconds", ts: str = "event_time",
                       unit: str | None = None, event_id: str = "event_id",
                       stretch: int = STRETCH) -> DataFrame:
    """All failed logins of each burst, one row each, in a burst named by ``burst_id``.

    Unlike ``fail_bursts``, every event of the user sets a cut, successes too;
    only failed logins are collected. Long form on purpose: a burst has no size
    limit, so it is never gathered into one array. ``burst_id`` is the time in µs
    of the event that set the cut.
    """
    reach = micros(within)
    rows = _ordered(logins, ts, unit, event_id)
    failed = F.col("event_type") == FAIL
    moments = rows.groupBy("user_id", "_us").agg(F.count_if(failed).alias("_n"))
    in_burst = Window.partitionBy("user_id", "burst_us")
    placed = (
        _with_burst(moments, reach, stretch, ["_n"])
        .withColumn("size", F.sum("_n").over(in_burst))
        .where("size > 1")
        .select(F.col("user_id").alias("_user"), F.col("_us").alias("_at"), F.col("burst_us").alias("burst_id"), "size")
    )
    same = F.col("user_id").eqNullSafe(F.col("_user")) & (F.col("_us") == F.col("_at"))  # failed logins without a user, too
    return (
        rows.where(failed).join(placed, same)
        .select("user_id", "burst_id", "size", F.col("_id").alias("event_id"), "ip", "event_type",
                F.col(ts).alias("event_time"))
    )
