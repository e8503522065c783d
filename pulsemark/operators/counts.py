"""Windowed counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.event_time import epoch_us, micros, timestamp_text
from ..plans.sliding import pane_counts, roll_up, sliding_counts, tumbling, windows_of


def page_views(views: DataFrame, ts: str = "ts", size="1 hour", unit: str | None = None) -> DataFrame:
    """Page views per tumbling window, labelled ``pv``."""
    return (
        views.where(F.col(ts).isNotNull()).groupBy(tumbling(epoch_us(views, ts, unit), size))
        .agg(F.count(F.lit(1)).alias("count"))
        .select(F.lit("pv").alias("label"), "window_end", "count")
    )


def hot_item_counts(views: DataFrame, ts: str = "ts", size="1 hour", slide="5 seconds",
                    unit: str | None = None) -> DataFrame:
    """Views per item and sliding window."""
    return sliding_counts(views, ts, size, slide, ["item_id"], unit)


def hot_url_counts(requests: DataFrame, ts: str = "ts", size="1 minute", slide="5 seconds",
                   unit: str | None = None) -> DataFrame:
    """Requests per url and sliding window."""
    return sliding_counts(requests, ts, size, slide, ["url"], unit)


def average_event_time(rows: DataFrame, key: str = "item_id", ts: str = "ts",
                       unit: str | None = None) -> DataFrame:
    """Mean event time per key in ms: ``average`` by integer division, ``average_exact`` plain.

    A sum of epoch milliseconds leaves the bigint range after some millions of
    rows, so the high and the low part are summed apart and put together per key.
    """
    low_bits = 20
    ms = F.expr("_us div 1000")
    total = (
        F.col("_high").cast("decimal(38,0)") * F.lit(1 << low_bits) + F.col("_low")
    )
    return (
        rows.where(F.col(ts).isNotNull()).select(key, epoch_us(rows, ts, unit).alias("_us"))
        .select(key, ms.alias("_ms"))
        .groupBy(key)
        .agg(F.sum(F.shiftright("_ms", low_bits)).alias("_high"),
             F.sum(F.col("_ms").bitwiseAND(F.lit((1 << low_bits) - 1).cast("bigint"))).alias("_low"),
             F.count(F.lit(1)).alias("_n"))
        .withColumn("_total", total)
        .select(key,
                F.expr("CAST(_total div _n AS double)").alias("average"),
                (F.col("_total").cast("double") / F.col("_n")).alias("average_exact"))
    )


def _market(windows: DataFrame, size: int) -> DataFrame:
    return windows.select(
        timestamp_text(F.col("_start")).alias("window_start"),
        timestamp_text(F.col("_start") + F.lit(size)).alias("window_end"),
        "channel", "behavior", "count",
    )


def _installed(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("behavior") != "UNINSTALL")


def market_by_channel(rows: DataFrame, ts: str = "ts", size="1 hour", slide="5 seconds",
                      unit: str | None = None) -> DataFrame:
    """Counts per (channel, behaviour) and sliding window, uninstalls left out."""
    size, slide, keys = micros(size), micros(slide), ["channel", "behavior"]
    rows = _installed(rows)
    panes = pane_counts(rows, ts, size, slide, keys, unit)
    return _market(windows_of(panes, size, slide, keys), size)


def market_total(rows: DataFrame, ts: str = "ts", size="1 hour", slide="5 seconds",
                 unit: str | None = None) -> DataFrame:
    """The same over all channels and behaviours, labelled ``total``."""
    size, slide = micros(size), micros(slide)
    rows = _installed(rows)
    panes = pane_counts(rows, ts, size, slide, [], unit)
    windows = windows_of(panes, size, slide, [])
    return _market(_labelled(windows), size)


def _labelled(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"channel": F.lit("total"), "behavior": F.lit("total")})


def market_windows(panes: DataFrame, keys: list[str], size="1 hour", slide="5 seconds") -> DataFrame:
    """The same from pane counts per channel and behaviour, as a stream keeps them; without ``keys`` the totals."""
    size, slide = micros(size), micros(slide)
    if not keys:
        return _market(_labelled(windows_of(roll_up(panes, []), size, slide, [])), size)
    return _market(windows_of(panes, size, slide, keys), size)


def market_both(rows: DataFrame, ts: str = "ts", size="1 hour", slide="5 seconds",
                unit: str | None = None) -> DataFrame:
    """Per-channel counts and totals together, as ``GROUPING SETS`` would give them.

    The totals are rolled up from the panes, so rows are read and shuffled once
    and no row is doubled before the first aggregation.
    """
    size, slide, keys = micros(size), micros(slide), ["channel", "behavior"]
    rows = _installed(rows)
    panes = pane_counts(rows, ts, size, slide, keys, unit)
    both = panes.unionByName(_labelled(roll_up(panes, [])))
    return _market(windows_of(both, size, slide, keys), size)
