from __future__ import annotations

import random

import pytest

from helpers import BASE_MS
from pulsemark.operators import lateness

ARGS = dict(unit="ms", size="1 minute", slide="5 seconds", delay="10 seconds", lateness="60 seconds")


def frame_of(spark, rows):
    return spark.createDataFrame([(i, key, at) for i, (key, at) in enumerate(rows)],
                                 "event_id bigint, url string, ts bigint")


def brute(rows, per_key):
    seen, out = {}, []
    for i, (key, at) in enumerate(rows):
        k = key if per_key else None
        mark = seen.get(k)
        start = at - at % 5_000
        ends = [start + 5_000 * n for n in range(1, 13)]
        fired = closed = 0
        if mark is not None:
            mark -= 10_000
            fired = sum(end - 1 <= mark for end in ends)
            closed = sum(end - 1 + 60_000 <= mark for end in ends)
        status = "on_time" if not fired else "late_accepted" if closed < 12 else "dropped"
        out.append((i, 12, fired, closed, status))
        seen[k] = max(at, seen.get(k, at))
    return out


@pytest.mark.parametrize("chunk_rows, per_key", [(1, False), (7, True), (1 << 20, False), (16, True)])
def test_against_brute_force(spark, chunk_rows, per_key):
    rng = random.Random(chunk_rows)
    rows = [(rng.choice("aaab"), BASE_MS + i * 1_000 - rng.choice([0, 0, 20_000, 90_000, 200_000]))
            for i in range(300)]
    got = lateness.late_records(frame_of(spark, rows).repartition(4), "event_id", ["url"] if per_key else [],
                                chunk_rows=chunk_rows, **ARGS)
    got = sorted((r.event_id, r.windows, r.fired, r.closed, r.status) for r in got.collect())
    assert got == brute(rows, per_key)
    assert {s for *_, s in got} == {"on_time", "late_accepted", "dropped"}


@pytest.mark.parametrize("ahead, status", [(69_900, "late_accepted"), (70_000, "dropped")])
def test_limit_of_lateness(spark, ahead, status):
    # the record's last window ends at `end`
    start = BASE_MS - BASE_MS % 60_000
    end = start + 60_000
    rows = [("a", end + ahead), ("a", start)]
    got = lateness.late_records(frame_of(spark, rows), "event_id", **ARGS).orderBy("event_id").collect()
    assert [r.status for r in got] == ["on_time", status]
    audit = lateness.late_audit(lateness.late_records(frame_of(spark, rows), "event_id", **ARGS))
    assert {r.status: r.records for r in audit.collect()} == {"on_time": 1, status: 1}


def test_records_without_a_time_are_counted(spark):
    rows = spark.createDataFrame([(1, 1, BASE_MS), (2, 2, None), (3, 3, BASE_MS + 5)], "event_id bigint, arrival bigint, ts bigint")
    audit = lateness.late_audit(lateness.late_records(rows, "arrival", unit="ms"))
    assert {r.status: r.records for r in audit.collect()} == {"on_time": 2, "no_time": 1}
