"""Late records as an output, the listener's counts, and state that is read back."""

from __future__ import annotations

import itertools
import random
import time

from pyspark.sql import functions as F

from helpers import BASE_MS
from pulsemark.session import session_conf
from pulsemark.streaming import jobs, late, sinks
from test_streaming import FAR, ITEM, Feed, item_batches


def ran(spark, tmp_path, stream, writer, mode="append", name="checkpoint"):
    with session_conf(spark, jobs.STATE_SETTINGS):
        return sinks.run_available(stream.writeStream.outputMode(mode).foreachBatch(writer), str(tmp_path / name))


def test_a_gate_sorts_every_record_once(spark, tmp_path):
    rng = random.Random(2)
    batches = [[(100 * b + i, 1, 1, BASE_MS + 1_000 * b + rng.randrange(-4_000, 1_000) if rng.random() < 0.9 else None) for i in range(50)]
               for b in range(6)]
    feed = Feed(spark, tmp_path, ITEM)
    for batch in batches:
        feed.add(batch)
    path = str(tmp_path / "gate")
    ran(spark, tmp_path, feed.stream(), late.gate(path, "2 seconds"))
    got = {r.event_id: r.status for r in late.read_gate(spark, path).collect()}
    seen, want = None, {}
    for batch in batches:
        for event, _, _, at in batch:
            refused = at is not None and seen is not None and at <= seen - 2_000
            want[event] = late.NO_TIME if at is None else late.LATE if refused else late.ACCEPTED
        seen = max([t for *_, t in batch if t is not None] + ([seen] if seen is not None else []))
    assert got == want and set(want.values()) == {late.ACCEPTED, late.LATE, late.NO_TIME}
    # what comes through is never late for a step behind the gate
    assert late.read_gate(spark, path, late.ACCEPTED).count() == sum(v == late.ACCEPTED for v in want.values())


def test_a_repeated_batch_of_the_gate_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "gate")
    write = late.gate(path, "1 second", until=F.unix_micros("ts") + 500_000)
    schema = "event_id bigint, ts timestamp"
    frames = [spark.sql(f"SELECT id AS event_id, timestamp_millis({BASE_MS} + id * 1000 - {shift}) AS ts FROM range({n})")
              for n, shift in ((5, 0), (5, 0), (9, 0))]
    for n, frame in enumerate(frames):
        for _ in range(2):
            write(frame.to(spark.createDataFrame([], schema).schema), n)
    found = sorted((r.batch_id, r.event_id, r.status) for r in late.read_gate(spark, path).collect())
    # the watermark is at 4 s - 1 s; a record counts as late when it has reached the record's time and half a second
    assert found == [(n, i, late.LATE if n and i <= 2 else late.ACCEPTED) for n, m in ((0, 5), (1, 5), (2, 9)) for i in range(m)]


def test_dropped_rows_are_counted_per_batch(spark, tmp_path):
    feed = Feed(spark, tmp_path, ITEM)
    feed.add([(0, 1, 1, BASE_MS)])
    feed.add([(1, 1, 1, BASE_MS + 100_000)])
    feed.add([(2, 1, 1, BASE_MS + 100_001)])
    feed.add([(3, 1, 1, BASE_MS + 1)])
    listener = late.Dropped(spark, str(tmp_path / "dropped"))
    spark.streams.addListener(listener)
    try:
        ran(spark, tmp_path, jobs.page_views(feed.stream(), "10 seconds"), sinks.batch_folders(str(tmp_path / "out")), mode="update")
        for _ in range(40):
            time.sleep(0.25)
            try:
                rows = spark.read.parquet(str(tmp_path / "dropped")).orderBy("batch").collect()
            except Exception:  # nothing written yet
                rows = []
            if sum(r["input"] for r in rows) == 4:
                break
    finally:
        spark.streams.removeListener(listener)
    assert [r["batch"] for r in rows][:4] == [0, 1, 2, 3] and sum(r["input"] for r in rows) == 4
    assert [r["dropped"] for r in rows][:4] == [0, 0, 0, 1]


def test_state_holds_open_panes_only(spark, tmp_path):
    """State rows are keys x open panes, and panes that the watermark has passed are gone after a restart."""
    feed = Feed(spark, tmp_path, ITEM)
    batches = item_batches(21, disorder=0)
    checkpoint = str(tmp_path / "checkpoint")
    given = []

    def more(batch):
        feed.add(batch)
        given.append(batch)
        ran(spark, tmp_path, jobs.final_panes(feed.stream(), ["item_id"], "10 seconds", "2 seconds", delay="1 millisecond"),
            sinks.batch_folders(str(tmp_path / "out")))
        rows = late.state_rows(spark, checkpoint).select("key.item_id", F.unix_millis("key.window.start").alias("at")).collect()
        latest = max(r[3] for b in given for r in b) - 1
        want = {(r[1], r[3] // 2000 * 2000) for b in given for r in b if r[3] // 2000 * 2000 + 2000 > latest}
        assert sorted((r["item_id"], r["at"]) for r in rows) == sorted(want)

    for batch in batches[:3]:
        more(batch)
    more([(9999, 99, 0, FAR)])
    # what has left the state has been given out
    out = sinks.read_batches(spark, str(tmp_path / "out"))
    assert out.agg(F.sum("_n")).first()[0] == sum(len(b) for b in itertools.chain(batches[:3]))
