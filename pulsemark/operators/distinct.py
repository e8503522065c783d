"""Distinct visitors: exact, by bitmap, by sketch, and running."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.event_time import epoch_us, floor_to, micros, to_ms
from ..functions.hashing import BITMAP_BITS, hash_position
from ..plans.running import running
from ..plans.sliding import tumbling


def _timed(rows: DataFrame, ts: str) -> DataFrame:
    """Rows without a time lie in no window and are left out of all counts here."""
    return rows.where(F.col(ts).isNotNull())


def distinct_per_window(rows: DataFrame, column: str, ts: str = "ts", size="1 minute",
                        unit: str | None = None) -> DataFrame:
    """Exact distinct values of ``column`` per tumbling window.

    Spark first groups by (window, value), so a busy window is spread over all
    tasks and repeats vanish before the shuffle.
    """
    return _timed(rows, ts).groupBy(tumbling(epoch_us(rows, ts, unit), size)).agg(
        F.countDistinct(column).alias("count")
    )


def bitmaps(rows: DataFrame, column: str, ts: str = "ts", size="1 hour", unit: str | None = None,
            bits: int = BITMAP_BITS, position: Callable[..., Column] = hash_position) -> DataFrame:
    """Per window and bucket, a bitmap of the positions seen: mergeable state.

    ``bits`` is a power of two. Positions are made distinct first and bitmaps
    are built after the shuffle: a bitmap is 4 KB whatever it holds, so building
    them map-side would ship far more than the few positions a task has seen.
    """
    at = position(F.col(column), bits)
    return (
        _timed(rows, ts).where(F.col(column).isNotNull())
        .select(tumbling(epoch_us(rows, ts, unit), size),
                F.bitmap_bucket_number(at).alias("bucket"), F.bitmap_bit_position(at).alias("_bit"))
        .distinct()
        .repartition("window_end", "bucket")
        .groupBy("window_end", "bucket")
        .agg(F.bitmap_construct_agg("_bit").alias("bitmap"))
    )


def merge_bitmaps(states: DataFrame, size) -> DataFrame:
    """Bitmaps of longer windows, from those of shorter ones."""
    # window_end is exclusive, so step inside the window before re-bucketing
    inside = F.col("window_end") * 1000 - F.lit(1)
    return states.groupBy(tumbling(inside, size), "bucket").agg(
        F.bitmap_or_agg("bitmap").alias("bitmap")
    )


def count_bitmaps(states: DataFrame) -> DataFrame:
    """Set bits per window: distinct values less those that share a position."""
    return states.groupBy("window_end").agg(F.sum(F.bitmap_count("bitmap")).alias("count"))


def sketches(rows: DataFrame, column: str, ts: str = "ts", size="1 hour", unit: str | None = None,
             precision: int = 12) -> DataFrame:
    """A HyperLogLog sketch per window: fixed size, mergeable."""
    return _timed(rows, ts).groupBy(tumbling(epoch_us(rows, ts, unit), size)).agg(
        F.hll_sketch_agg(column, precision).alias("sketch")
    )


def merge_sketches(states: DataFrame, size) -> DataFrame:
    """Sketches of longer windows, from those of shorter ones."""
    inside = F.col("window_end") * 1000 - F.lit(1)
    return states.groupBy(tumbling(inside, size)).agg(F.hll_union_agg("sketch").alias("sketch"))


def estimate_sketches(states: DataFrame) -> DataFrame:
    return states.select("window_end", F.hll_sketch_estimate("sketch").alias("count"))


def approx_distinct_per_window(rows: DataFrame, column: str, ts: str = "ts", size="1 hour",
                               unit: str | None = None, rsd: float = 0.02) -> DataFrame:
    """One-pass estimate where no state has to be kept."""
    return _timed(rows, ts).groupBy(tumbling(epoch_us(rows, ts, unit), size)).agg(
        F.approx_count_distinct(column, rsd).alias("count")
    )


def running_distinct(rows: DataFrame, column: str, event_id: str = "event_id", ts: str = "ts",
                     size="1 hour", unit: str | None = None, grain=None,
                     slices: int = 36_000) -> DataFrame:
    """Distinct values seen so far in the window, after each row.

    Rows are ordered by (time, ``event_id``). Each value's first row in a window
    weighs one, every other row nothing; the answer is the running sum. The
    first rows come from an aggregation rather than a window over the value, so
    a hot value costs nothing, and the running sum is taken in ``slices`` per
    window, so a hot window is spread as well.

    With ``grain`` (e.g. ``'1 minute'``) one row per grain instead of per event.
    """
    length = micros(size)
    events = _timed(rows, ts).select(
        F.col(column), F.col(event_id).alias("event_id"), epoch_us(rows, ts, unit).alias("_us")
    ).withColumn("window_end", tumbling(F.col("_us"), size))
    firsts = (
        events.where(F.col(column).isNotNull()).groupBy("window_end", column)
        .agg(F.min(F.struct("_us", "event_id")).alias("_first"))
        .select("window_end", "_first._us", "_first.event_id",
                F.lit(1).cast("bigint").alias("_new"), F.lit(0).alias("_step"))
    )
    slice_us = max(1, length // slices)
    if grain is not None:
        step = micros(grain)
        if length % step:
            raise ValueError("the window must be a multiple of the grain")
        at = floor_to(F.col("_us"), step).alias("_at")
        seen = events.select("window_end", at, F.lit(0).cast("bigint").alias("_new"))
        per_grain = (
            seen.unionByName(firsts.select("window_end", at, "_new"))
            .groupBy("window_end", "_at").agg(F.sum("_new").alias("_new"))
        )
        slice_no = F.expr(f"pmod(_at, {length}) div {slice_us}")
        return running(per_grain, ["window_end"], slice_no, ["_at"], "_new", "sum", "count").select(
            "window_end", to_ms(F.col("_at") + F.lit(step)).alias("grain_end"), "count"
        )

    marks = events.select(
        "window_end", "_us", "event_id", F.col(column),
        F.lit(0).cast("bigint").alias("_new"), F.lit(1).alias("_step"),
    ).unionByName(firsts, allowMissingColumns=True)
    slice_no = F.expr(f"pmod(_us, {length}) div {slice_us}")
    return (
        running(marks, ["window_end"], slice_no, ["_us", "event_id", "_step"], "_new", "sum", "count")
        .where("_step = 1")
        .select("window_end", "event_id", column, "count")
    )
