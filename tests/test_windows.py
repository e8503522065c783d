from __future__ import annotations

import random

import pytest

from helpers import BASE_MS, brute_sliding
from pulsemark.functions.event_time import micros, timestamp_text
from pulsemark.operators import counts, distinct, topn
from pulsemark.plans import sliding
from pyspark.sql import functions as F


def rows_of(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, ts bigint")


def skewed(seed, n=500, span=40_000):
    """A third of the rows on one item, a third in one instant, some before 1970."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        at = BASE_MS + rng.randrange(span) if i % 3 else BASE_MS + 7_000
        if i % 50 == 0:
            at = -rng.randrange(1, 20_000)
        out.append((1 if rng.random() < 0.4 else rng.randrange(2, 6), at))
    return out


@pytest.mark.parametrize("size, slide", [
    ("10 seconds", "1 second"), ("10 seconds", "10 seconds"), ("10 seconds", "3 seconds"),
    ("7 seconds", "2 seconds"), ("3 seconds", "5 seconds"),
])
def test_sliding_counts_match_brute_force(spark, size, slide):
    rows = skewed(5)
    got = sliding.sliding_counts(rows_of(spark, rows), "ts", size, slide, ["item_id"], "ms")
    got = [(r.item_id, r.window_end, r["count"]) for r in got.collect()]
    assert sorted(got) == brute_sliding(rows, micros(size) // 1000, micros(slide) // 1000)
    assert len(set((i, end) for i, end, _ in got)) == len(got)


def test_sliding_counts_equal_plain_windows(spark):
    frame = rows_of(spark, skewed(6))
    ours = sliding.sliding_counts(frame, "ts", "10 seconds", "2 seconds", ["item_id"], "ms")
    plain = sliding.sliding_counts_plain(frame, "ts", "10 seconds", "2 seconds", ["item_id"], "ms")
    assert ours.exceptAll(plain).count() == 0 and plain.exceptAll(ours).count() == 0


def test_sliding_counts_without_a_key_and_with_nulls(spark):
    frame = spark.createDataFrame([(None, BASE_MS), (None, BASE_MS), (1, None)], "item_id bigint, ts bigint")
    keyed = sliding.sliding_counts(frame, "ts", "2 seconds", "1 second", ["item_id"], "ms").collect()
    assert {(r.item_id, r.window_end - BASE_MS, r["count"]) for r in keyed} == {(None, 1000, 2), (None, 2000, 2)}
    assert sliding.sliding_counts(frame, "ts", "2 seconds", "1 second", [], "ms").count() == 2


def test_window_edge(spark):
    ten = 1558432800000  # 2019-05-21 10:00:00
    frame = rows_of(spark, [(1, ten + 3_599_999), (1, ten + 3_600_000)])
    ends = [r.window_end - ten for r in counts.page_views(frame, unit="ms").orderBy("window_end").collect()]
    assert ends == [3_600_000, 7_200_000]


def test_top_n_ties_by_id_and_report(spark):
    frame = spark.createDataFrame(
        [(9, 0, 5), (4, 0, 3), (2, 0, 3), (7, 0, 3)], "item_id bigint, window_end bigint, count bigint")
    ranked = topn.top_n(frame, "item_id", 3)
    assert [(r.rank, r.item_id) for r in ranked.orderBy("rank").collect()] == [(1, 9), (2, 2), (3, 4)]
    text = topn.item_report(ranked).first().report
    assert text == ("时间：1970-01-01 00:00:00.0\nNo1: 商品ID=9 浏览量=5\nNo2: 商品ID=2 浏览量=3\n"
                    "No3: 商品ID=4 浏览量=3\n===================")


def test_url_report_text(spark):
    frame = spark.createDataFrame([("/a", 1500, 2)], "url string, window_end bigint, count bigint")
    text = topn.url_report(topn.top_n(frame, "url", 5)).first().report
    assert text == "时间：1970-01-01 00:00:01.5\nNo1: URL=/a 访问量=2\n" + "=" * 57


def test_timestamp_text(spark):
    frame = spark.createDataFrame([(0,), (1_230_000,), (-1_000,)], "us bigint")
    assert [r[0] for r in frame.select(timestamp_text(F.col("us"))).collect()] == [
        "1970-01-01 00:00:00.0", "1970-01-01 00:00:01.23", "1969-12-31 23:59:59.999"]


def test_market_counts(spark):
    frame = spark.createDataFrame(
        [("u", "CLICK", "weibo", BASE_MS), ("u", "UNINSTALL", "weibo", BASE_MS), ("u", "CLICK", "appstore", BASE_MS)],
        "user_id string, behavior string, channel string, ts bigint")
    args = dict(size="2 seconds", slide="1 second", unit="ms")
    both = counts.market_both(frame, **args)
    apart = counts.market_by_channel(frame, **args).unionByName(counts.market_total(frame, **args))
    assert both.exceptAll(apart).count() == 0 and apart.exceptAll(both).count() == 0
    first = both.where("channel = 'total'").orderBy("window_start").first()
    assert (first.window_start, first.window_end, first.behavior, first["count"]) == (
        "2019-05-21 09:26:39.0", "2019-05-21 09:26:41.0", "total", 2)


def test_average_event_time_is_exact_past_the_bigint_range(spark):
    # 8 million rows of 1.6e12 ms sum to more than 2^63
    big = spark.range(8_000_000).select(F.lit(1).alias("item_id"), (F.lit(1_600_000_000_000) + F.col("id") % 2).alias("ts"))
    row = counts.average_event_time(big, unit="ms").first()
    assert row.average == 1_600_000_000_000.0 and row.average_exact == pytest.approx(1_600_000_000_000.5)


def brute_running(rows, size):
    seen, out = {}, []
    for at, i, user in sorted((at, i, u) for i, (u, at) in enumerate(rows)):
        end = (at // size + 1) * size
        seen.setdefault(end, set())
        if user is not None:
            seen[end].add(user)
        out.append((end, i, user, len(seen[end])))
    return sorted(out, key=lambda r: r[:2])


@pytest.mark.parametrize("slices", [1, 7, 36_000])
def test_running_distinct(spark, slices):
    rng = random.Random(slices)
    rows = [(rng.choice([1, 1, 1, 2, 3, 4, 5, None]), BASE_MS + rng.randrange(0, 300) * 100) for _ in range(400)]
    frame = spark.createDataFrame([(i, u, at) for i, (u, at) in enumerate(rows)],
                                  "event_id bigint, user_id bigint, ts bigint").repartition(6)
    got = distinct.running_distinct(frame, "user_id", size="10 seconds", unit="ms", slices=slices)
    got = sorted(((r.window_end, r.event_id, r.user_id, r["count"]) for r in got.collect()), key=lambda r: r[:2])
    assert got == brute_running(rows, 10_000)

    by_grain = distinct.running_distinct(frame, "user_id", size="10 seconds", unit="ms", slices=slices,
                                         grain="2 seconds").collect()
    last = {}
    for end, i, _, n in sorted(brute_running(rows, 10_000), key=lambda r: (rows[r[1]][1], r[1])):
        last[end, (rows[i][1] // 2000 + 1) * 2000] = n
    assert {(r.window_end, r.grain_end): r["count"] for r in by_grain} == last


def test_bitmaps_merge_and_count(spark):
    frame = spark.range(2000).select((F.col("id") % 700).alias("user_id"), (F.lit(BASE_MS) + F.col("id") * 1000).alias("ts"))
    states = distinct.bitmaps(frame, "user_id", size="1 minute", unit="ms")
    merged = distinct.count_bitmaps(distinct.merge_bitmaps(states, "1 hour"))
    exact = distinct.distinct_per_window(frame, "user_id", size="1 hour", unit="ms")
    assert {tuple(r) for r in merged.collect()} == {tuple(r) for r in exact.collect()}


def test_sketches_are_close(spark):
    frame = spark.range(60_000).select((F.col("id") % 20_000).alias("user_id"), (F.lit(1558432800000) + F.col("id")).alias("ts"))
    states = distinct.sketches(frame, "user_id", size="10 seconds", unit="ms")
    day = distinct.estimate_sketches(distinct.merge_sketches(states, "1 day")).first()["count"]
    one = distinct.approx_distinct_per_window(frame, "user_id", size="1 day", unit="ms").first()["count"]
    assert abs(day - 20_000) < 1_000 and abs(one - 20_000) < 1_500


@pytest.mark.parametrize("buckets, n, keys", [(1, 1, 8), (1, 3, 8), (3, 2, 30), (1024, 3, 8)])
def test_pruned_top_n_equals_plain(spark, buckets, n, keys):
    rng = random.Random(buckets + n)
    weights = [1 / (i + 1) for i in range(keys)]
    rows = [(rng.choices(range(keys), weights)[0], BASE_MS + rng.randrange(0, 3_600_000)) for _ in range(3_000)]
    frame = rows_of(spark, rows)
    args = dict(ts="ts", size="10 minutes", slide="5 seconds", unit="ms")
    ours = topn.top_n_sliding(frame, "item_id", n, buckets=buckets, **args)
    plain = topn.top_n(sliding.sliding_counts(frame, keys=["item_id"], **args), "item_id", n)
    assert ours.count() == plain.count() and ours.exceptAll(plain).count() == 0


def test_pruning_leaves_out_the_long_tail(spark):
    # 3 busy items and 200 that are seen once: the busy ones alone are written out
    busy = [(i, BASE_MS + s * 1_000 + i) for s in range(3_600) for i in range(3)]
    rows = rows_of(spark, busy + [(100 + i, BASE_MS + 1_800_000 + i) for i in range(200)])
    size, slide = micros("10 minutes"), micros("5 seconds")
    panes = sliding.pane_counts(rows, "ts", size, slide, ["item_id"], "ms")
    block = topn._block_steps(size, slide) * slide
    kept = topn._contenders(panes, "item_id", 3, size, slide, block, buckets=1)
    assert kept.where("item_id >= 100").count() == 0
    assert kept.select("item_id").distinct().count() == 3


def test_pruned_top_n_with_ties_and_a_null_key(spark):
    rows = [(k, BASE_MS + s * 1_000) for s in range(1_200) for k in (None, 1, 2, 3, 4, 5)]
    frame = rows_of(spark, rows)
    args = dict(ts="ts", size="10 minutes", slide="5 seconds", unit="ms")
    plain = topn.top_n(sliding.sliding_counts(frame, keys=["item_id"], **args), "item_id", 2)
    for buckets in (1, 4):
        ours = topn.top_n_sliding(frame, "item_id", 2, buckets=buckets, **args)
        assert ours.count() == plain.count() and ours.exceptAll(plain).count() == 0


def test_ranking_many_keys_within_one_window_keeps_blocks_small(spark):
    """Nothing can be pruned where no key fills a block; the last task of a block still gets n rows per bucket and run."""
    rows = spark.range(20_000).select(F.col("id").alias("item_id"), (F.lit(BASE_MS) + F.col("id") % 290_000).alias("ts"))
    panes = sliding.pane_counts(rows, "ts", micros("1 hour"), micros("1 minute"), ["item_id"], "ms")
    size, slide, block = micros("1 hour"), micros("1 minute"), 5 * micros("1 minute")
    runs = topn._runs(topn._contenders(panes, "item_id", 3, size, slide, block, 8), "item_id", slide, block,
                      ["_bucket", "_stretch", "_block"])
    kept = topn._ranked(runs, "item_id", 3, ["_bucket", "_stretch"])
    most = kept.groupBy("_block", "_at").count().agg(F.max("count")).first()[0]
    assert most <= 8 * 3
    got = topn.top_n_sliding(rows, "item_id", 3, size="1 hour", slide="1 minute", unit="ms", buckets=8)
    whole = topn.top_n(sliding.sliding_counts(rows, "ts", "1 hour", "1 minute", ["item_id"], "ms"), "item_id", 3)
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in whole.collect()}
