"""Patterns, counts and reports that leave a stream while it runs, against brute force and the batch operators."""

from __future__ import annotations

import itertools
import random
import uuid

import numpy as np
import pandas as pd
import pytest

from helpers import BASE_MS, brute_bursts, brute_orders, brute_sequences, logins, orders, per_user, random_logins
from pulsemark.functions.hashing import id_position
from pulsemark.operators import distinct, topn
from pulsemark.operators import patterns as batch_patterns
from pulsemark.plans.sliding import sliding_counts
from pulsemark.session import session_conf
from pulsemark.streaming import jobs, live, patterns, reorder, sinks
from pulsemark.streaming.reorder import Rows
from test_streaming import FAR, ITEM, Feed, item_batches

LOGIN = "event_id bigint, user_id bigint, ip string, event_type string, event_time bigint"
ORDER = "event_id bigint, order_id bigint, event_type string, event_time bigint"


def shuffled(table, seed, disorder, parts=5):
    """Rows as they arrive, up to ``disorder`` ms late, in batches."""
    rng = random.Random(seed)
    table = sorted(table, key=lambda r: r[-1] + rng.randrange(disorder + 1))
    size = -(-len(table) // parts)
    return [table[i:i + size] for i in range(0, len(table), size)]


def answers(spark, tmp_path, schema, table, job, last, seed=1, disorder=3_000):
    feed = Feed(spark, tmp_path, schema)
    for part in shuffled(table, seed, disorder):
        feed.add(part)
    feed.add([last])
    with session_conf(spark, jobs.STATE_SETTINGS):
        out, query = feed.run(job(feed.stream("event_time")))
    return out, query


END = (9999, 99, "x", "fail", FAR)
DELAY = "4 seconds"


@pytest.mark.parametrize("consecutive", [False, True])
def test_sequences_of_a_disordered_stream(spark, tmp_path, consecutive):
    rows = random_logins(3, n=300, span_ms=60_000, hot=0.9)
    table = [tuple(r) for r in logins(spark, rows).collect()]
    out, _ = answers(spark, tmp_path, LOGIN, table, lambda s: patterns.fail_sequences(s, 3, "2 seconds", consecutive, DELAY, stretch=2), END)
    got = sorted((r.user_id, r.start_id, r.event_id, r.ip) for r in out.collect())
    assert got == brute_sequences(rows, 3, 2_000, consecutive)
    # answers come while the stream runs, not at its end only
    assert out.select("batch_id").distinct().count() > 2


def test_pairs_of_a_disordered_stream(spark, tmp_path):
    rows = random_logins(4, n=300, span_ms=60_000, hot=0.9)
    table = [tuple(r) for r in logins(spark, rows).collect()]
    out, _ = answers(spark, tmp_path, LOGIN, table, lambda s: patterns.fail_pairs(s, "2 seconds", DELAY, stretch=1), END)
    want = [(user, a[1], b[1]) for user, events in per_user(rows).items() for a, b in itertools.pairwise(events)
            if a[3] == b[3] == "fail" and b[0] - a[0] < 2_000]
    assert sorted((r.user_id, r.first_id, r.second_id) for r in out.collect()) == sorted(want)


@pytest.mark.parametrize("members", [False, True])
def test_bursts_of_a_user_with_most_rows(spark, tmp_path, monkeypatch, members):
    """User 1 has nine rows in ten, and no state ever sees more than a stretch of them."""
    rows = random_logins(5, n=600, span_ms=240_000, hot=0.9)
    table = [tuple(r) for r in logins(spark, rows).collect()]
    out, query = answers(spark, tmp_path, LOGIN, table, lambda s: patterns.fail_bursts(s, "2 seconds", DELAY, members, stretch=2), END)
    expected = brute_bursts(rows, 2_000, all_cut=members)
    if members:
        assert sorted((r.user_id, r.cut_us // 1000 - BASE_MS, r.size, r.event_id) for r in out.collect()) == sorted(
            (u, cut, len(t), e[1]) for u, cut, t in expected for e in t)
    else:
        assert sorted((r.user_id, r.event_id, r.size) for r in out.collect()) == sorted((u, t[0][1], len(t)) for u, _, t in expected)
    # state goes as the watermark does
    assert query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] < 20


def test_no_state_holds_a_whole_user(spark):
    """The rows of a key lie in one stretch and its margins."""
    rows = random_logins(6, n=2_000, span_ms=400_000, hot=0.9)
    frame = logins(spark, rows).selectExpr("event_time * 1000 AS us", "user_id")
    from pulsemark.streaming.reorder import in_stretches
    from pyspark.sql import functions as F
    keyed = in_stretches(frame, 2_000_000, after=F.lit(True), before=F.lit(True), stretch=2)
    most = keyed.groupBy("user_id", "stretch").count().agg(F.max("count")).first()[0]
    assert most < 80 and keyed.count() < 2.2 * len(rows)


def test_an_instant_with_many_failed_logins_is_one_row_of_state(spark, tmp_path):
    rows = [(1, "a", "fail", 1_000)] * 5_000 + [(1, "b", "fail", 2_500), (2, "c", "fail", 0)]
    table = [tuple(r) for r in logins(spark, rows).collect()]
    out, _ = answers(spark, tmp_path, LOGIN, table, lambda s: patterns.fail_bursts(s, "2 seconds", DELAY), END)
    assert [(r.user_id, r.event_id, r.size) for r in out.collect()] == [(1, 0, 5_001)]


def test_orders_of_a_disordered_stream(spark, tmp_path):
    rng = random.Random(8)
    rows = [(rng.choice([1, 1, 1, 2, 3]), rng.choice(["create", "create", "pay"]), rng.randrange(0, 120) * 500) for _ in range(300)]
    table = [tuple(r) for r in orders(spark, rows).collect()]
    out, query = answers(spark, tmp_path, ORDER, table, lambda s: patterns.order_results(s, "3 seconds", DELAY, stretch=2),
                         (9999, 99, "create", FAR))
    assert sorted((r.order_id, r.create_id, r.event_type) for r in out.collect()) == brute_orders(rows, 3_000)
    assert sum(s["numInputRows"] for p in query.recentProgress for s in p["sources"]) == 301  # the source is read once


def test_work_of_an_order_with_very_many_events_is_linear():
    """Ten thousand creates and pays of one order and stretch, none paired with all others."""
    rng = np.random.default_rng(1)
    n = 20_000
    us = np.sort(rng.integers(0, 800_000_000, n))
    pay = rng.random(n) < 0.5
    rule = patterns.Orders(900_000_000, 1)
    decided, made = rule.settle((7, 0), Rows(us, np.arange(n), pd.DataFrame({"pay": pay})), b"")
    assert len(made) == len(decided) == (~pay).sum()
    last = np.flatnonzero(pay)[-1]
    assert (made.event_type == "success").tolist() == (made.create_id < last).tolist()


def test_missing_ids_users_and_times(spark, tmp_path):
    table = [(None, None, "a", "fail", BASE_MS), (None, None, "b", "fail", BASE_MS + 500), (3, None, None, "fail", BASE_MS + 900),
             (4, 1, "d", None, BASE_MS), (5, 1, "e", "fail", None)]
    feed = Feed(spark, tmp_path, LOGIN)
    feed.add(table)
    feed.add([END])
    with session_conf(spark, jobs.STATE_SETTINGS):
        out, _ = feed.run(patterns.fail_sequences(feed.stream("event_time"), delay=DELAY))
        assert [(r.user_id, r.start_id, r.event_id, r.ip) for r in out.collect()] == [(None, None, None, "b")]
        out, _ = feed.run(patterns.fail_bursts(feed.stream("event_time"), delay=DELAY))
        assert [(r.user_id, r.event_id, r.ip, r.size) for r in out.collect()] == [(None, None, "a", 3)]
        out, _ = feed.run(patterns.fail_bursts(feed.stream("event_time"), delay=DELAY, members=True))
        assert sorted((str(r.event_id), r.size) for r in out.collect()) == [("3", 3), ("None", 3), ("None", 3)]


def test_patterns_go_on_after_a_restart(spark, tmp_path):
    rows = random_logins(9, n=200, span_ms=40_000)
    parts = shuffled([tuple(r) for r in logins(spark, rows).collect()], 2, 0)
    feed = Feed(spark, tmp_path, LOGIN)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    for part in [*parts, [END]]:
        feed.add(part)
        with session_conf(spark, jobs.STATE_SETTINGS):
            writer = patterns.fail_sequences(feed.stream("event_time")).writeStream.outputMode("append")
            sinks.run_available(writer.foreachBatch(sinks.batch_folders(out)), checkpoint)
    got = sorted((r.user_id, r.start_id, r.event_id, r.ip) for r in sinks.read_batches(spark, out).collect())
    assert got == brute_sequences(rows, 3, 2_000)


def test_a_count_for_every_element(spark, tmp_path):
    feed = Feed(spark, tmp_path, ITEM)
    batches = [*item_batches(11), [(900, 1, None, BASE_MS + 47_000), (901, 1, -3, BASE_MS + 47_000), (902, 1, 1 << 60, BASE_MS + 47_500)]]
    for batch in batches:
        feed.add(batch)
    feed.add([(9999, 99, 0, FAR)])
    rows = spark.createDataFrame(list(itertools.chain(*batches)), ITEM)
    want = distinct.running_distinct(rows, "user_id", size="10 seconds", unit="ms")
    path = str(tmp_path / "out")
    with session_conf(spark, jobs.STATE_SETTINGS):
        stream = live.first_rows(feed.stream(), "user_id", size="10 seconds", delay=DELAY, bits=1)
        writer = stream.writeStream.outputMode("append").foreachBatch(live.running_counts(path, "10 seconds"))
        query = sinks.run_available(writer, str(tmp_path / "checkpoint"))
    got = sinks.read_batches(spark, f"{path}/rows")
    assert sorted(map(str, got.select("window_end", "event_id", "value", "count").collect())) == sorted(
        map(str, want.selectExpr("window_end", "event_id", "user_id AS value", "count").collect()))
    assert got.select("batch_id").distinct().count() > 2
    # bitmaps of windows that are over are gone
    assert query.recentProgress[-1]["stateOperators"][-1]["numRowsTotal"] < 6


@pytest.mark.parametrize("slide", ["2 seconds", "10 seconds"])
def test_leaders_come_out_once_while_the_stream_runs(spark, tmp_path, slide):
    feed = Feed(spark, tmp_path, ITEM)
    batches = item_batches(12)
    batches.append([(5000 + i, i % 5, 1, BASE_MS + 300_000 + 100 * i) for i in range(30)])  # after a gap
    for batch in batches:
        feed.add(batch)
    feed.add([(9999, 99, 0, FAR)])
    path = str(tmp_path / "out")
    with session_conf(spark, jobs.STATE_SETTINGS):
        stream = live.leaders(feed.stream(), "item_id", 2, "10 seconds", slide, DELAY, buckets=3)
        writer = stream.writeStream.outputMode("append").foreachBatch(live.leader_batches(path, "item_id", 2))
        sinks.run_available(writer, str(tmp_path / "checkpoint"))
    out = sinks.read_batches(spark, path)
    rows = spark.createDataFrame(list(itertools.chain(*batches)), ITEM)
    want = topn.top_n(sliding_counts(rows, "ts", "10 seconds", slide, ["item_id"], "ms"), "item_id", 2)
    assert sorted(map(tuple, out.drop("batch_id").collect())) == sorted(map(tuple, want.collect()))
    assert out.groupBy("window_end").agg({"batch_id": "min"}).count() == out.select("window_end", "batch_id").distinct().count()
    assert out.select("batch_id").distinct().count() > 2


def test_sketches_and_bitmaps_after_each_batch(spark, tmp_path):
    """Late rows correct an hour, and the day made of it, in the batch that brings them."""
    hour = 3_600_000
    start = BASE_MS - BASE_MS % (24 * hour)
    rng = random.Random(3)
    parts = [[(i, 0, rng.randrange(200), start + h * hour + rng.randrange(hour)) for i in range(120)] for h in (0, 1, 0, 2, 1)]
    feed = Feed(spark, tmp_path, ITEM)
    for part in parts:
        feed.add(part)
    stream = feed.stream()
    sketches, _ = feed.run(live.sketch_updates(stream, "user_id", delay="4 hours"), mode="update")
    bitmaps, _ = feed.run(live.bitmap_updates(stream, id_position(stream["user_id"]), delay="4 hours"), mode="update")
    for n in range(len(parts)):
        exact = len({r[2] for part in parts[:n + 1] for r in part})
        sketch = sinks.latest(sketches.where(f"batch_id <= {n}"), ["window_end"])
        (day,) = distinct.estimate_sketches(distinct.merge_sketches(sketch, "1 day")).collect()
        assert abs(day["count"] - exact) <= max(1, 0.08 * exact)
        bits = sinks.latest(bitmaps.where(f"batch_id <= {n}"), ["window_end", "bucket"])
        (day,) = distinct.count_bitmaps(distinct.merge_bitmaps(bits, "1 day")).collect()
        assert day["count"] == exact


def test_batch_and_stream_agree_on_shared_instants(spark, tmp_path):
    rows = [(1, f"i{i}", "fail" if i % 3 else "success", (i // 4) * 500) for i in range(80)]
    table = [tuple(r) for r in logins(spark, rows).collect()]
    out, _ = answers(spark, tmp_path, LOGIN, table, lambda s: patterns.fail_sequences(s, delay=DELAY), END)
    whole = batch_patterns.fail_sequences(logins(spark, rows), unit="ms")
    assert sorted(map(tuple, out.select(whole.columns).collect())) == sorted(map(tuple, whole.collect()))


class Noted:
    """State and timers of one key, in memory; counts the calls of a rule."""

    def __init__(self):
        self.rows, self.done, self.timers = [], None, []

    def getListState(self, *_):
        noted = self

        class State:
            appendValue = staticmethod(lambda row: noted.rows.append(row))
            get = staticmethod(lambda: list(noted.rows))
            put = staticmethod(lambda rows: noted.rows.__setitem__(slice(None), rows))
            clear = staticmethod(lambda: noted.rows.clear())

        return State

    def getValueState(self, *_):
        noted = self

        class State:
            exists = staticmethod(lambda: noted.done is not None)
            get = staticmethod(lambda: noted.done)
            update = staticmethod(lambda value: setattr(noted, "done", value))
            clear = staticmethod(lambda: setattr(noted, "done", None))

        return State

    def registerTimer(self, at):
        self.timers.append(at)


class Clock:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms

    getExpiryTimeInMs = getCurrentWatermarkInMs


def settled(rule, frame):
    """Answers of one key that gets all rows at once, when the watermark has passed them all."""
    handle, step = Noted(), reorder.Reordered(rule)
    step.init(handle)
    assert not list(step.handleInputRows((0, 0), iter([frame]), Clock(0)))
    out = list(step.handleExpiredTimer((0, 0), Clock(10 ** 9), Clock(10 ** 9)))
    assert not handle.rows and handle.done is None
    return pd.concat(out) if out else pd.DataFrame()


def in_one_key(rows, **columns):
    """Rows of several owners as one key sees them, in a time that is one stretch."""
    return pd.DataFrame({"us": [r[3] * 1000 for r in rows], "id": range(len(rows)), "ip": [r[1] for r in rows], **columns})


USERS = random_logins(11, n=400, users=40, span_ms=20_000, hot=0.2)


@pytest.mark.parametrize("members", [False, True])
def test_users_of_one_state_keep_bursts_apart(members):
    rows = [r for r in USERS if members or r[2] == "fail"]
    frame = in_one_key(rows, user_id=[r[0] for r in rows], n=[int(r[2] == "fail") for r in rows])
    got = settled(patterns.Bursts(2_000_000, 100, members), frame)
    expected = brute_bursts(rows, 2_000, all_cut=members)
    if members:
        assert sorted(zip(got.user_id, got.cut_us, got["size"], got.event_id)) == sorted(
            (u, cut * 1000, len(t), e[1]) for u, cut, t in expected for e in t)
    else:
        assert sorted(zip(got.user_id, got.event_id, got["size"])) == sorted((u, t[0][1], len(t)) for u, _, t in expected)


def test_a_state_is_shared_by_users(spark, tmp_path):
    """Each call costs milliseconds, so states do not grow in number with the users: 3,000 users, rows of one stretch."""
    rows = [(u, f"ip{u}", "fail", at) for u in range(3_000) for at in (0, 500)]
    table = [tuple(r) for r in logins(spark, rows).collect()]
    for job, columns in ((patterns.fail_bursts, 5), (lambda s: patterns.fail_bursts(s, members=True), 6)):
        path = tmp_path / uuid.uuid4().hex
        path.mkdir()
        feed = Feed(spark, path, LOGIN)
        feed.add(table)
        feed.add([END])
        with session_conf(spark, jobs.STATE_SETTINGS):
            out, query = feed.run(job(feed.stream("event_time")))
        assert sorted(r.user_id for r in out.collect()) == sorted(list(range(3_000)) * (columns - 4))
        waiting = [p["stateOperators"][0]["customMetrics"] for p in query.recentProgress if p["stateOperators"]]
        assert 0 < max(m["numRegisteredTimers"] for m in waiting) < 3 * reorder.BUCKETS


def test_orders_of_one_state_are_kept_apart():
    """The pay of another order does not pay a create."""
    rng = random.Random(12)
    rows = [(rng.randrange(60), rng.choice(["create", "create", "pay"]), rng.randrange(0, 120) * 500) for _ in range(400)]
    frame = pd.DataFrame({"us": [r[2] * 1000 for r in rows], "id": range(len(rows)), "order_id": [r[0] for r in rows],
                          "pay": [r[1] == "pay" for r in rows]})
    got = settled(patterns.Orders(3_000_000, 100), frame)
    assert sorted(zip(got.order_id, got.create_id, got.event_type)) == brute_orders(rows, 3_000)


@pytest.mark.parametrize("consecutive", [False, True])
def test_sequences_of_one_state_are_kept_apart(consecutive):
    frame = in_one_key(USERS, user_id=[r[0] for r in USERS], fail=[r[2] == "fail" for r in USERS])
    got = settled(patterns.Sequences(2_000_000, 100, 3, consecutive, pairs=False), frame)
    assert sorted(zip(got.user_id, got.start_id, got.event_id, got.ip)) == brute_sequences(USERS, 3, 2_000, consecutive)


def test_pairs_of_one_state_are_kept_apart():
    frame = in_one_key(USERS, user_id=[r[0] for r in USERS], fail=[r[2] == "fail" for r in USERS])
    got = settled(patterns.Sequences(2_000_000, 100, 2, True, pairs=True), frame)
    want = [(user, a[1], b[1]) for user, events in per_user(USERS).items() for a, b in itertools.pairwise(events)
            if a[3] == b[3] == "fail" and b[0] - a[0] < 2_000]
    assert want and sorted(zip(got.user_id, got.first_id, got.second_id)) == sorted(want)
