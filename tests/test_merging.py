"""Sliding windows of extremes and sketches against every window computed on its own."""

from __future__ import annotations

import random

import pytest

from helpers import BASE_MS
from pulsemark.plans import merging

SCHEMA = "k string, v int, ts bigint"


def brute(rows, size, slide, answer):
    held = {}
    for k, v, at in rows:
        if v is None or at is None:
            continue
        start = at - at % slide
        while start > at - size:
            held.setdefault((k, start + size), []).append(v)
            start -= slide
    return sorted(((str(k), end, answer(vs)) for (k, end), vs in held.items()))


def random_rows(seed, n=400):
    rng = random.Random(seed)
    times = [BASE_MS + rng.choice([0, 200_000]) + rng.randrange(60_000) for _ in range(n)]
    return [(rng.choice(["a", "a", "a", "b", None]), rng.choice([None, *range(40)]), t) for t in times] + [("a", 3, None), ("z", 5, -BASE_MS)]


@pytest.mark.parametrize("size, slide", [(10, 1), (12, 4), (5, 5), (60, 2)])
def test_largest_value_of_every_window(spark, size, slide):
    rows = random_rows(size)
    got = merging.sliding_largest(spark.createDataFrame(rows, SCHEMA), "v", "ts", f"{size} seconds", f"{slide} seconds", ["k"], "ms")
    assert sorted((str(r.k), r.window_end, r.largest) for r in got.collect()) == brute(rows, size * 1000, slide * 1000, max)


def test_distinct_values_of_every_window(spark):
    rows = random_rows(3)
    got = merging.sliding_distinct(spark.createDataFrame(rows, SCHEMA), "v", "ts", "12 seconds", "2 seconds", ["k"], "ms")
    # sketches of so few values are exact
    assert sorted((str(r.k), r.window_end, r["count"]) for r in got.collect()) == brute(rows, 12_000, 2_000, lambda v: len(set(v)))
    whole = merging.sliding_distinct(spark.createDataFrame(rows, SCHEMA), "v", "ts", "12 seconds", "2 seconds", [], "ms")
    assert sorted(("", r.window_end, r["count"]) for r in whole.collect()) == brute([("", *r[1:]) for r in rows], 12_000, 2_000, lambda v: len(set(v)))


def test_no_rows_and_uneven_windows(spark):
    assert merging.sliding_largest(spark.createDataFrame([], SCHEMA), "v", "ts", "10 seconds", "5 seconds", ["k"], "ms").count() == 0
    with pytest.raises(ValueError, match="multiple"):
        merging.sliding_largest(spark.createDataFrame([], SCHEMA), "v", "ts", "10 seconds", "4 seconds", ["k"], "ms")
