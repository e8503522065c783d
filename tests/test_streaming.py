"""Streams fed file by file, compared with the batch operators."""

from __future__ import annotations

import itertools
import os
import random
import uuid

import pytest

from helpers import BASE_MS, brute_bursts, brute_orders, logins, orders, random_logins
from pulsemark.functions.event_time import event_time
from pulsemark.operators import counts, distinct, topn
from pulsemark.plans.sliding import sliding_counts
from pulsemark.session import session_conf
from pulsemark.streaming import jobs, patterns, sinks

FAR = BASE_MS + 86_400_000


class Feed:
    """A folder read one file per batch, in the order they were added."""

    def __init__(self, spark, path, schema):
        self.spark, self.path, self.schema, self.n = spark, path, schema, 0
        (path / "in").mkdir()

    def add(self, rows):
        frame = self.spark.createDataFrame(rows, self.schema)
        target = self.path / "in" / f"{self.n:04}.json"
        target.write_text("\n".join(frame.toJSON().collect()) + "\n")
        os.utime(target, (1_600_000_000 + self.n, 1_600_000_000 + self.n))
        self.n += 1

    def stream(self, time="ts"):
        rows = self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).json(str(self.path / "in"))
        return event_time(rows, time, "ms")

    def run(self, stream, mode="append", shape=lambda df: df):
        out = str(self.path / f"out-{uuid.uuid4().hex}")
        writer = stream.writeStream.outputMode(mode).foreachBatch(sinks.batch_folders(out, shape))
        query = sinks.run_available(writer, out + "-checkpoint")
        return sinks.read_batches(self.spark, out), query


ITEM = "event_id bigint, item_id bigint, user_id bigint, ts bigint"


def item_batches(seed, disorder=2_000, n=240):
    rng = random.Random(seed)
    rows = [(i, rng.choice([1, 1, 1, 2, 3, 4]), rng.randrange(6), BASE_MS + i * 200 - rng.randrange(disorder + 1))
            for i in range(n)]
    return [rows[i:i + 60] for i in range(0, n, 60)]


def test_final_counts_equal_batch_in_any_order(spark, tmp_path):
    batches = item_batches(1)
    rows = list(itertools.chain(*batches))
    whole = sliding_counts(spark.createDataFrame(rows, ITEM), "ts", "10 seconds", "2 seconds", ["item_id"], "ms")
    expected = sorted((r.item_id, r.window_end, r["count"]) for r in whole.collect())
    for n, order in enumerate([batches, [random.Random(n).sample(b, len(b)) for n, b in enumerate(batches)]]):
        folder = tmp_path / str(n)
        folder.mkdir()
        feed = Feed(spark, folder, ITEM)
        for batch in order:
            feed.add(batch)
        feed.add([(9999, 99, 0, FAR)])
        out, _ = feed.run(jobs.final_counts(feed.stream(), ["item_id"], "10 seconds", "2 seconds", delay="12 seconds"))
        got = sorted((r.item_id, r.window_end, r["count"]) for r in out.collect() if r.item_id != 99)
        assert got == expected


def test_top_n_per_batch_equals_batch(spark, tmp_path):
    feed = Feed(spark, tmp_path, ITEM)
    batches = item_batches(2, disorder=0)
    for batch in batches:
        feed.add(batch)
    feed.add([(9999, 99, 0, FAR)])
    stream = jobs.final_counts(feed.stream(), ["item_id"], "10 seconds", "2 seconds")
    out, _ = feed.run(stream, shape=lambda df: topn.top_n(df, "item_id", 2))
    rows = spark.createDataFrame(list(itertools.chain(*batches)), ITEM)
    whole = topn.top_n(sliding_counts(rows, "ts", "10 seconds", "2 seconds", ["item_id"], "ms"), "item_id", 2)
    got = {tuple(r) for r in out.where("item_id <> 99").select(whole.columns).collect()}
    assert got == {tuple(r) for r in whole.collect()}


def test_updates_take_late_records_up_to_the_limit(spark, tmp_path):
    schema = "event_id bigint, url string, ts bigint"
    start = BASE_MS - BASE_MS % 60_000
    end = start + 60_000
    feed = Feed(spark, tmp_path, schema)
    feed.add([(0, "a", start), (1, "a", start + 1)])
    feed.add([(2, "b", end + 69_900)])
    feed.add([(3, "a", start + 2)])            # watermark end - 0.1 s: still taken by the last window
    feed.add([(4, "b", end + 70_000)])
    feed.add([(6, "b", end + 70_000)])         # Spark judges lateness by the batch before the last
    feed.add([(5, "a", start + 3)])            # watermark at the window's end: dropped
    feed.add([(7, "b", FAR)])
    out, query = feed.run(jobs.updating_counts(feed.stream(), ["url"]), mode="update")
    now = sinks.latest(out, ["url", "window_end"])
    assert now.where(f"url = 'a' AND window_end = {end}").first()["count"] == 3
    dropped = sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
    assert dropped > 0
    corrections = out.where(f"url = 'a' AND window_end = {end}").orderBy("batch_id")
    assert [r["count"] for r in corrections.collect()] == [2, 3]


def test_distinct_and_first_seen(spark, tmp_path):
    feed = Feed(spark, tmp_path, ITEM)
    batches = item_batches(3, disorder=0)
    for batch in batches:
        feed.add(batch)
    feed.add([(9999, 99, 0, FAR)])
    rows = spark.createDataFrame(list(itertools.chain(*batches)), ITEM)
    whole = {tuple(r) for r in distinct.distinct_per_window(rows, "user_id", size="10 seconds", unit="ms").collect()}
    out, _ = feed.run(jobs.distinct_final(feed.stream(), "user_id", "10 seconds"))
    assert {(r.window_end, r["count"]) for r in out.collect()} == whole
    seen, _ = feed.run(jobs.first_seen(feed.stream(), "user_id", "10 seconds"))
    got = {tuple(r) for r in seen.groupBy("window_end").count().collect() if r.window_end < FAR}
    assert got == whole


def test_page_views_update(spark, tmp_path):
    feed = Feed(spark, tmp_path, ITEM)
    batches = item_batches(4, disorder=0)
    for batch in batches:
        feed.add(batch)
    out, _ = feed.run(jobs.page_views(feed.stream(), "10 seconds"), mode="update")
    now = sinks.latest(out, ["label", "window_end"])
    whole = counts.page_views(spark.createDataFrame(list(itertools.chain(*batches)), ITEM), size="10 seconds", unit="ms")
    assert {tuple(r) for r in now.collect()} == {tuple(r) for r in whole.collect()}


def test_an_upsert_table_compacts_itself(spark, tmp_path):
    path, keys = str(tmp_path / "table"), ["k"]
    write = sinks.upsert_batches(path, keys, every=2)
    now = {}
    for n in range(5):
        rows = [(k, 10 * n + k) for k in range(n, n + 3)]
        now |= dict(rows)
        for _ in range(2):  # a repeated batch changes nothing
            write(spark.createDataFrame(rows, "k int, v int"), n)
        assert {r.k: r.v for r in sinks.read_upserts(spark, path, keys).collect()} == now
    assert {r.version for r in spark.read.parquet(f"{path}/names").collect()} == {1, 3}


def test_a_compaction_rewrites_touched_buckets_only(spark, tmp_path):
    path, keys = str(tmp_path / "table"), ["k"]
    write = sinks.upsert_batches(path, keys, every=1, buckets=16)
    now = {k: k for k in range(400)}
    write(spark.createDataFrame(list(now.items()), "k int, v int"), 0)
    for n, changed in ((1, [3]), (2, [3, 5]), (3, [])):
        now |= {k: 1000 * n + k for k in changed}
        for _ in range(2):
            write(spark.createDataFrame([(k, now[k]) for k in changed], "k int, v int"), n)
        assert {r.k: r.v for r in sinks.read_upserts(spark, path, keys).collect()} == now
    touched = {v: sorted(os.listdir(f"{path}/versions/version={v}")) for v in (0, 1, 2)}
    assert len([b for b in touched[0] if b.startswith("_bucket")]) == 16
    assert [len([b for b in touched[v] if b.startswith("_bucket")]) for v in (1, 2)] == [1, 2]
    assert not os.path.exists(f"{path}/versions/version=3")  # nothing changed


def test_a_repeated_batch_replaces_its_rows_in_a_database():
    assert sinks.replace_statements("ranks", ["window_end", "rank", "batch_id"], 7) == [
        "DELETE FROM ranks WHERE batch_id = 7",
        "INSERT INTO ranks (window_end, rank, batch_id) SELECT window_end, rank, batch_id FROM ranks_staging"]


def test_orders(spark, tmp_path):
    rows = [(1, "create", 0), (2, "create", 1_000), (2, "pay", 2_000), (2, "pay", 500_000), (3, "create", 3_000),
            (3, "pay", 903_000), (4, "pay", 4_000), (5, "create", 600_000), (6, "create", 5_000), (6, "create", 6_000),
            (6, "pay", 700_000)]
    schema = "event_id bigint, order_id bigint, event_type string, event_time bigint"
    feed = Feed(spark, tmp_path, schema)
    table = [tuple(r) for r in orders(spark, rows).collect()]
    table.sort(key=lambda r: r[3])
    for i in range(0, len(table), 2):
        feed.add(table[i:i + 2])
    # only new creates, no new pays
    feed.add([(9999, 99, "create", FAR)])
    with session_conf(spark, jobs.STATE_SETTINGS):
        out, _ = feed.run(patterns.order_results(feed.stream("event_time")))
    got = sorted((r.order_id, r.create_id, r.event_type) for r in out.collect())
    assert got == brute_orders(rows, 900_000)


def test_split_writes_each_result_to_its_sink(spark, tmp_path):
    frame = spark.createDataFrame([(1, "success"), (2, "timeout"), (3, "timeout")], "order_id bigint, event_type string")
    write = sinks.split_batches({"success": sinks.batch_folders(str(tmp_path / "s")),
                                 "timeout": sinks.batch_folders(str(tmp_path / "t"))})
    write(frame, 7)
    write(frame, 7)  # a repeated batch replaces its first run
    assert sinks.read_batches(spark, str(tmp_path / "s")).count() == 1
    assert sorted(tuple(r) for r in sinks.read_batches(spark, str(tmp_path / "t")).collect()) == [
        (2, "timeout", 7), (3, "timeout", 7)]


@pytest.mark.parametrize("members", [False, True])
def test_bursts(spark, tmp_path, members):
    rows = random_logins(7, n=160, span_ms=30_000)
    schema = "event_id bigint, user_id bigint, ip string, event_type string, event_time bigint"
    feed = Feed(spark, tmp_path, schema)
    table = sorted((tuple(r) for r in logins(spark, rows).collect()), key=lambda r: r[4])
    for i in range(0, len(table), 40):
        feed.add(table[i:i + 40])
    feed.add([(9999, 99, "x", "fail", FAR)])
    with session_conf(spark, jobs.STATE_SETTINGS):
        out, _ = feed.run(patterns.fail_bursts(feed.stream("event_time"), members=members))
    expected = brute_bursts(rows, 2000, all_cut=members)
    if members:
        got = sorted((r.user_id, r.cut_us // 1000 - BASE_MS, r.size, r.event_id) for r in out.collect())
        assert got == sorted((u, cut, len(t), e[1]) for u, cut, t in expected for e in t)
    else:
        got = sorted((r.user_id, r.event_id, r.size) for r in out.collect())
        assert got == sorted((u, t[0][1], len(t)) for u, _, t in expected)


def test_console_and_landing(spark, tmp_path):
    feed = Feed(spark, tmp_path, "value string")
    feed.add([("1,2,3,pv,4",)])
    raw = spark.readStream.schema("value string").json(str(tmp_path / "in"))
    for kind in ("csv", "text", "parquet"):
        target = str(tmp_path / kind)
        sinks.run_available(sinks.land_raw(raw, target, kind), target + "-checkpoint")
        landed = spark.read.parquet(target) if kind == "parquet" else spark.read.text(target)
        assert [r[0].strip('"') for r in landed.collect()] == ["1,2,3,pv,4"]
    sinks.run_available(sinks.console(raw, prefix="raw"), str(tmp_path / "console-checkpoint"))


def test_windows_of_final_panes_equal_batch(spark, tmp_path):
    feed = Feed(spark, tmp_path, ITEM)
    batches = item_batches(5)
    for batch in batches:
        feed.add(batch)
    feed.add([(9999, 99, 0, FAR)])
    panes, query = feed.run(jobs.final_panes(feed.stream(), ["item_id"], "10 seconds", "2 seconds", delay="12 seconds"))
    rows = spark.createDataFrame(list(itertools.chain(*batches)), ITEM)
    got = topn.top_n_panes(panes.drop("batch_id"), "item_id", 2, "10 seconds", "2 seconds")
    whole = topn.top_n(sliding_counts(rows, "ts", "10 seconds", "2 seconds", ["item_id"], "ms"), "item_id", 2)
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in whole.collect()}
    # one row of state per key and open pane, not per window
    most = max(op["numRowsTotal"] for p in query.recentProgress for op in p["stateOperators"])
    assert most <= len({(r.item_id, r.ts // 2000) for r in rows.collect()})


def test_panes_are_corrected_by_late_records(spark, tmp_path):
    feed = Feed(spark, tmp_path, "event_id bigint, url string, ts bigint")
    start = BASE_MS - BASE_MS % 60_000
    feed.add([(0, "a", start), (1, "a", start + 1), (2, "b", start + 40_000)])
    feed.add([(3, "a", start + 2)])
    out, _ = feed.run(jobs.updating_panes(feed.stream(), ["url"]), mode="update")
    pane = out.where(f"url = 'a' AND _pane = {start * 1000}").orderBy("batch_id")
    assert [r["_n"] for r in pane.collect()] == [2, 3]


def test_a_stopped_stream_goes_on_from_its_checkpoint(spark, tmp_path):
    feed = Feed(spark, tmp_path, ITEM)
    batches = item_batches(6, disorder=0)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run():
        writer = jobs.page_views(feed.stream(), "10 seconds").writeStream.outputMode("update").foreachBatch(sinks.batch_folders(out))
        return sinks.run_available(writer, checkpoint)

    for batch in batches[:2]:
        feed.add(batch)
    run()
    for batch in batches[2:]:
        feed.add(batch)
    again = run()
    assert sum(p["numInputRows"] for p in again.recentProgress) == sum(map(len, batches[2:]))
    now = sinks.latest(sinks.read_batches(spark, out), ["label", "window_end"])
    whole = counts.page_views(spark.createDataFrame(list(itertools.chain(*batches)), ITEM), size="10 seconds", unit="ms")
    assert {tuple(r) for r in now.collect()} == {tuple(r) for r in whole.collect()}


def test_running_distinct_counts_of_a_stream(spark, tmp_path):
    feed = Feed(spark, tmp_path, ITEM)
    batches = item_batches(7, disorder=0)
    for batch in batches:
        feed.add(batch)
    seen, _ = feed.run(jobs.first_seen(feed.stream(), "user_id", "1 hour"),
                       shape=lambda df: df.groupBy("window_end").count().withColumnRenamed("count", "new"))
    got = {(r.batch_id, r["count"]) for r in sinks.running_totals(seen, ["window_end"], "new").collect()}
    users, want = set(), []
    for n, batch in enumerate(batches):
        users |= {r[2] for r in batch}
        want.append((n, len(users)))
    assert got <= set(want) and max(got) == max(w for w in want if w in got)
