"""Patterns of logins and orders on a stream: the batch operators' answers, each once, as the watermark settles them.

Input streams carry ``ts`` (TIMESTAMP); rows without it take part in no pattern. Rows are ordered by (time, event id).
Start the queries under ``jobs.STATE_SETTINGS``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.event_time import interval, micros
from ..operators.patterns import CREATE, FAIL, PAY, SUCCESS, TIMEOUT
from ..plans.lookahead import STRETCH
from .jobs import ASCENDING
from .reorder import NO_ID, Rule, in_buckets, in_stretches, reordered, without_ids

HEADS = "user_id bigint, event_id bigint, ip string, event_type string, size bigint"
MEMBERS = "user_id bigint, cut_us bigint, size bigint, event_id bigint, ip string, event_type string"
RESULTS = "order_id bigint, create_id bigint, event_type string"
SEQUENCES = "user_id bigint, start_id bigint, event_id bigint, ip string, event_type string"
PAIRS = "user_id bigint, first_id bigint, first_ip string, second_id bigint, second_ip string"


def _home(key: tuple, us: np.ndarray, reach: int, stretch: int) -> np.ndarray:
    return (us >= key[1]) & (us < key[1] + max(1, stretch) * reach)


@dataclass
class Orders(Rule):
    """Per create: the first pay behind it, if it comes in time."""

    reach: int
    stretch: int
    columns = ["pay"]
    owner = "order_id"

    @property
    def keep(self) -> int:
        return self.reach

    def settle(self, key, rows, carry):
        pay = rows.of["pay"].to_numpy(dtype=bool)
        at = np.flatnonzero(~pay & _home(key, rows.us, self.reach, self.stretch))
        pays = np.append(np.flatnonzero(pay), len(rows))
        behind = pays[np.searchsorted(pays[:-1], at)]
        pay_us = np.append(rows.us, np.iinfo(np.int64).max)[behind]
        paid = (np.append(rows.owner, NO_ID)[behind] == rows.owner[at]) & (pay_us < rows.us[at] + self.reach)
        return np.where(paid, pay_us, rows.us[at] + self.reach), pd.DataFrame(
            {"order_id": rows.owner[at], "create_id": rows.id[at], "event_type": np.where(paid, SUCCESS, TIMEOUT)})


def order_results(orders: DataFrame, within="15 minutes", delay=ASCENDING, stretch: int = STRETCH) -> DataFrame:
    """``success`` or ``timeout`` per created order: a success when the watermark passes the pay, a timeout when it passes
    the last chance (append mode).

    One source, one state; a state holds the creates that are still open and the pays they may yet be paid with, of one
    bucket of orders and stretch of time. Columns: ``order_id, event_id, event_type, ts``.
    """
    reach = micros(within)
    rows = orders.where(F.col("event_type").isin(CREATE, PAY) & F.col("ts").isNotNull()).withWatermark("ts", interval(delay)).select(
        "order_id", "ts", F.unix_micros("ts").alias("us"), F.col("event_id").alias("id"), (F.col("event_type") == PAY).alias("pay"))
    rows = in_stretches(rows, reach, after=F.col("pay"), stretch=stretch)
    return without_ids(reordered(in_buckets(rows, "order_id"), ["bucket", "stretch"], Orders(reach, stretch), RESULTS), "order_id", "create_id")


@dataclass
class Sequences(Rule):
    """A failed login directly followed by another, then more up to ``fails``."""

    reach: int
    stretch: int
    fails: int
    consecutive: bool
    pairs: bool
    columns = ["ip", "fail"]
    owner = "user_id"

    @property
    def keep(self) -> int:
        return self.reach

    def settle(self, key, rows, carry):
        fail = rows.of["fail"].to_numpy(dtype=bool)
        at = np.flatnonzero(fail)
        at, last = at[:max(len(at) - self.fails + 1, 0)], at[self.fails - 1:]
        hit = fail[np.minimum(at + 1, len(rows) - 1)] & (rows.us[last] < rows.us[at] + self.reach)
        hit &= (rows.owner[last] == rows.owner[at]) & _home(key, rows.us[at], self.reach, self.stretch)
        if self.consecutive:
            hit &= last == at + self.fails - 1
        at, last = at[hit], last[hit]
        ip = rows.of["ip"].to_numpy()
        if self.pairs:
            made = {"user_id": rows.owner[at], "first_id": rows.id[at], "first_ip": ip[at], "second_id": rows.id[last], "second_ip": ip[last]}
        else:
            made = {"user_id": rows.owner[at], "start_id": rows.id[at], "event_id": rows.id[at + 1], "ip": ip[at + 1], "event_type": FAIL}
        return rows.us[last], pd.DataFrame(made)


def _logins(logins: DataFrame, delay) -> DataFrame:
    return logins.where(F.col("ts").isNotNull()).withWatermark("ts", interval(delay)).select(
        "user_id", "ts", F.unix_micros("ts").alias("us"), F.col("event_id").alias("id"), "ip",
        F.coalesce(F.col("event_type") == FAIL, F.lit(False)).alias("fail"))


def fail_sequences(logins: DataFrame, fails: int = 3, within="2 seconds", consecutive: bool = False, delay=ASCENDING,
                   stretch: int = STRETCH) -> DataFrame:
    """``operators.patterns.fail_sequences`` of a stream; a match leaves when the watermark passes its last event."""
    if fails < 2:
        raise ValueError("a sequence has at least two failed logins")
    reach = micros(within)
    rows = in_stretches(_logins(logins, delay), reach, after=F.lit(True), stretch=stretch)
    rule = Sequences(reach, stretch, fails, consecutive, pairs=False)
    return without_ids(reordered(in_buckets(rows, "user_id"), ["bucket", "stretch"], rule, SEQUENCES), "user_id", "start_id", "event_id")


def fail_pairs(logins: DataFrame, within="2 seconds", delay=ASCENDING, stretch: int = STRETCH) -> DataFrame:
    """``operators.patterns.fail_pairs`` of a stream."""
    reach = micros(within)
    rows = in_stretches(_logins(logins, delay), reach, after=F.lit(True), stretch=stretch)
    rule = Sequences(reach, stretch, 2, consecutive=True, pairs=True)
    return without_ids(reordered(in_buckets(rows, "user_id"), ["bucket", "stretch"], rule, PAIRS), "user_id", "first_id", "second_id")


@dataclass
class Bursts(Rule):
    """A moment belongs to the burst of the earliest moment not more than ``reach`` before it; ``n`` counts its failed
    logins. A burst is settled at its cut, ``reach`` after its first moment."""

    reach: int
    stretch: int
    members: bool
    columns = ["ip", "n"]
    owner = "user_id"

    @property
    def keep(self) -> int:
        return 2 * self.reach

    def settle(self, key, rows, carry):
        begin = rows.us[rows.first_at(rows.us - self.reach)]
        n = rows.of["n"].to_numpy()
        at = np.flatnonzero(n > 0)
        first = np.flatnonzero(np.append(True, (np.diff(begin[at]) != 0) | (np.diff(rows.owner[at]) != 0))[:len(at)])
        size = np.add.reduceat(n[at], first) if len(at) else n[at]
        wanted = (size > 1) & _home(key, begin[at][first], self.reach, self.stretch)
        ip = rows.of["ip"].to_numpy()
        if self.members:
            runs = np.diff(np.append(first, len(at)))
            at, size = at[np.repeat(wanted, runs)], np.repeat(size, runs)[np.repeat(wanted, runs)]
            made = {"user_id": rows.owner[at], "cut_us": begin[at] + self.reach, "size": size, "event_id": rows.id[at], "ip": ip[at]}
            return begin[at] + self.reach, pd.DataFrame({**made, "event_type": FAIL})
        at, size = at[first][wanted], size[wanted]
        made = {"user_id": rows.owner[at], "event_id": rows.id[at], "ip": ip[at], "event_type": FAIL, "size": size}
        return begin[at] + self.reach, pd.DataFrame(made)


def fail_bursts(logins: DataFrame, within="2 seconds", delay=ASCENDING, members: bool = False, stretch: int = STRETCH) -> DataFrame:
    """Bursts of two or more failed logins (append mode), each when the watermark passes its cut.

    Columns of ``logins``: ``user_id, event_id, ip, event_type, ts``. Without ``members`` only failed logins set cuts;
    those of one instant are folded by an aggregation before they reach the state, so an instant is one row there however
    many logins it saw. With ``members`` every event sets a cut, and every failed login of a burst comes out.
    """
    reach = micros(within)
    rows = _logins(logins, delay)
    if members:
        rows = rows.withColumn("n", F.col("fail").cast("bigint"))
    else:
        rows = rows.where("fail").groupBy("user_id", "ts").agg(
            F.count("*").alias("n"), F.min(F.struct(F.coalesce("id", F.lit(NO_ID)).alias("id"), "ip")).alias("_head")).select(
            "user_id", "ts", F.unix_micros("ts").alias("us"), "_head.id", "_head.ip", "n")
    rows = in_stretches(rows, reach, after=F.lit(True), before=F.lit(True), stretch=stretch)
    made = reordered(in_buckets(rows, "user_id"), ["bucket", "stretch"], Bursts(reach, stretch, members), MEMBERS if members else HEADS)
    return without_ids(made, "user_id", "event_id")
