"""Sliding-window counts without expanding every row into every window.

``F.window(ts, '1 hour', '5 seconds')`` turns one row into 720 before the first
aggregation. Here rows are first counted per pane (a slice as long as the slide;
map-side combine does most of it). A pane then only states where its count
enters and where it leaves the range of window starts, two small rows. A running
sum over those edges is the window count, constant between two edges, so the
windows are written out last and are never shuffled or aggregated again.

Edges are grouped by key *and* a stretch of time, so neither a hot key nor a
count without any key ends up in one task: a group holds at most one edge pair
per pane of its stretch, however many rows there were.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.event_time import epoch_us, floor_to, interval, micros, to_ms

# Window sizes per stretch of time handled by one group.
STRETCH = 8


def pane_counts(df: DataFrame, ts: str, size: int, slide: int, keys: Sequence[str],
                unit: str | None = None) -> DataFrame:
    """Rows per key and pane; columns ``keys``, ``_pane`` (start, µs), ``_n``. Rows without a time are in no pane."""
    pane = floor_to(epoch_us(df, ts, unit), gcd(size, slide))
    return (
        df.where(F.col(ts).isNotNull())
        .groupBy(*keys, pane.alias("_pane")).agg(F.count(F.lit(1)).alias("_n"))
    )


def roll_up(panes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Pane counts of coarser keys, from pane counts instead of rows."""
    return panes.groupBy(*keys, "_pane").agg(F.sum("_n").alias("_n"))


def stretch_of(size: int, slide: int) -> int:
    return -(-STRETCH * size // slide) * slide


def segments_of(panes: DataFrame, size: int, slide: int, keys: Sequence[str],
                spread: Sequence[str] = ()) -> DataFrame:
    """Runs of window starts with one count: ``keys``, ``_stretch``, ``_at``, ``_next``, ``count``.

    Starts run from ``_at`` to before ``_next`` in steps of the slide. Only
    windows that hold a row appear. ``spread`` names columns, made of the keys,
    that shall place the rows (with ``_stretch``) instead of the keys.
    """
    width = gcd(size, slide)
    stretch = stretch_of(size, slide)

    first = -floor_to(-(F.col("_pane") + F.lit(width - size)), slide)
    last = floor_to(F.col("_pane"), slide)
    home, tail = floor_to(F.col("_first"), stretch), floor_to(F.col("_last"), stretch)

    def edge(group: Column, at: Column, delta: Column) -> Column:
        return F.struct(group.alias("_stretch"), at.alias("_at"), delta.alias("_delta"))

    enter, leave = F.col("_n"), -F.col("_n")
    end = F.col("_last") + F.lit(slide)
    edges = F.when(
        home == tail,
        F.array(edge(home, F.col("_first"), enter), edge(home, end, leave)),
    ).otherwise(
        # the pane's windows cross into the next stretch: close it here, open it there
        F.array(
            edge(home, F.col("_first"), enter), edge(home, tail, leave),
            edge(tail, tail, enter), edge(tail, end, leave),
        )
    )
    panes = panes.withColumn("_first", first).withColumn("_last", last)
    if slide > size:  # panes between two windows; left out else, as it would be pushed down to each row
        panes = panes.where("_first <= _last")
    marks = panes.select(*spread, *keys, F.inline(edges))
    if spread:
        marks = marks.repartition(*spread, "_stretch")
    over = Window.partitionBy(*spread, *keys, "_stretch").orderBy("_at")
    return (
        # ordered without a row frame: edges at one instant count together
        marks.withColumn("count", F.sum("_delta").over(over))
        .withColumn("_next", F.lead("_at").over(over))
        .where("count > 0 AND _next > _at")
        .drop("_delta")
    )


def starts_of(slide: int) -> Column:
    """The window starts of a segment, as an array."""
    return F.sequence("_at", F.col("_next") - F.lit(slide), F.lit(slide).cast("bigint"))


def windows_of(panes: DataFrame, size: int, slide: int, keys: Sequence[str]) -> DataFrame:
    """Window counts of pane counts: ``keys``, ``_start`` (µs), ``count``."""
    return segments_of(panes, size, slide, keys).select(
        *keys, F.explode(starts_of(slide)).alias("_start"), "count"
    )


def sliding_counts(df: DataFrame, ts: str, size, slide, keys: Sequence[str] = (),
                   unit: str | None = None) -> DataFrame:
    """Rows per sliding window and key: ``keys``, ``window_end`` (ms), ``count``."""
    size, slide = micros(size), micros(slide)
    panes = pane_counts(df, ts, size, slide, keys, unit)
    return windows_of(panes, size, slide, keys).select(
        *keys, to_ms(F.col("_start") + F.lit(size)).alias("window_end"), "count"
    )


def sliding_counts_plain(df: DataFrame, ts: str, size, slide, keys: Sequence[str] = (),
                         unit: str | None = None) -> DataFrame:
    """The same with ``F.window`` alone; the yardstick of tests and bench."""
    timed = df.where(F.col(ts).isNotNull()).withColumn("_ts", F.timestamp_micros(epoch_us(df, ts, unit)))
    window = F.window("_ts", interval(size), interval(slide))
    return (
        timed.groupBy(*keys, window.alias("_w")).agg(F.count(F.lit(1)).alias("count"))
        .select(*keys, F.unix_millis("_w.end").alias("window_end"), "count")
    )


def tumbling(us: Column, size) -> Column:
    """End of the tumbling window holding ``us``, in ms."""
    size = micros(size)
    return to_ms(floor_to(us, size) + F.lit(size)).alias("window_end")
