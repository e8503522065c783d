"""Streaming DataFrame in, streaming DataFrame out.

Input streams carry the event time as TIMESTAMP ``ts``. Filters belong in front
of these jobs: Spark moves them below the watermark wherever they are written.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import gcd

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.event_time import interval, micros

# Delay for a stream in time order: a millisecond, so that rows of the newest instant are not late.
ASCENDING = "1 millisecond"

# Settings a query needs while it is started (see session.session_conf).
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def _panes(stream: DataFrame, keys: Sequence[str], size, slide, behind: str) -> DataFrame:
    width = gcd(micros(size), micros(slide))
    return (
        stream.withWatermark("ts", behind)
        .groupBy(F.window("ts", f"{width} microseconds").alias("_w"), *keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*keys, F.unix_micros("_w.start").alias("_pane"), "_n")
    )


def final_panes(stream: DataFrame, keys: Sequence[str], size="1 hour", slide="5 seconds", delay=ASCENDING) -> DataFrame:
    """Counts per key and pane, each once (append mode), for the reader to make windows of.

    State holds the open panes of a key, not its windows, of which every pane is in size / slide. Columns: ``keys``,
    ``_pane`` (start, µs), ``_n``, as ``plans.sliding`` and ``topn.top_n_panes`` take them.
    """
    return _panes(stream, keys, size, slide, interval(delay))


def updating_panes(stream: DataFrame, keys: Sequence[str], size="1 minute", slide="5 seconds", delay="10 seconds",
                   lateness="60 seconds") -> DataFrame:
    """The same with early counts and corrections (update mode); a pane takes records until the last window that holds
    it would, ``delay + lateness`` after that window's end."""
    behind = f"{micros(delay) + micros(lateness) + micros(size)} microseconds"
    return _panes(stream, keys, size, slide, behind)


def _end(window: str) -> F.Column:
    return F.unix_millis(F.col(window)["end"]).alias("window_end")


def final_counts(stream: DataFrame, keys: Sequence[str], size="1 hour", slide="5 seconds",
                 delay=ASCENDING) -> DataFrame:
    """Sliding counts, each once, when the watermark has passed it (append mode), for sinks that take windows only.

    State holds a row per key and open window; ``final_panes`` holds one per pane.

    Two chained aggregations: panes as long as the slide first, so the state and
    the expansion into windows grow with panes, not with rows.
    """
    if micros(size) % micros(slide):
        raise ValueError("the window must be a multiple of the slide")
    panes = (
        stream.withWatermark("ts", interval(delay))
        .groupBy(F.window("ts", interval(slide)).alias("_pane"), *keys)
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return (
        panes.groupBy(F.window("_pane", interval(size), interval(slide)).alias("_w"), *keys)
        .agg(F.sum("_n").alias("count"))
        .select(*keys, _end("_w"), "count")
    )


def updating_counts(stream: DataFrame, keys: Sequence[str], size="1 minute", slide="5 seconds",
                    delay="10 seconds", lateness="60 seconds") -> DataFrame:
    """Sliding counts with early results and corrections (update mode), for sinks that take windows only.

    Every row is written into its size / slide windows; ``updating_panes`` writes it into one pane.

    A window takes records until the watermark, ``delay + lateness`` behind, has
    passed its end. Spark drops a late record by the watermark of the batch
    before, so a window may take records for one batch longer, never shorter.
    """
    behind = f"{micros(delay) + micros(lateness)} microseconds"
    return (
        stream.withWatermark("ts", behind)
        .groupBy(F.window("ts", interval(size), interval(slide)).alias("_w"), *keys)
        .agg(F.count(F.lit(1)).alias("count"))
        .select(*keys, _end("_w"), "count")
    )


def page_views(stream: DataFrame, size="1 hour", delay=ASCENDING) -> DataFrame:
    """Page views per tumbling window (append or update mode)."""
    return (
        stream.withWatermark("ts", interval(delay))
        .groupBy(F.window("ts", interval(size)).alias("_w")).agg(F.count(F.lit(1)).alias("count"))
        .select(F.lit("pv").alias("label"), _end("_w"), "count")
    )


def distinct_final(stream: DataFrame, column: str, size="1 hour", delay=ASCENDING) -> DataFrame:
    """Distinct values per tumbling window, each once (append mode)."""
    return (
        stream.withWatermark("ts", interval(delay))
        .select(F.window("ts", interval(size)).alias("_w"), column)
        .dropDuplicates(["_w", column])
        .groupBy("_w").agg(F.count(F.lit(1)).alias("count"))
        .select(_end("_w"), "count")
    )


def first_seen(stream: DataFrame, column: str, size="1 hour", delay=ASCENDING) -> DataFrame:
    """Each value's first row in its tumbling window, as it arrives (append mode).

    Summed up per window it is the running distinct count; the sum is left to
    the reader of the sink, where it is a plain aggregation.
    """
    return (
        stream.withWatermark("ts", interval(delay))
        .select(F.window("ts", interval(size)).alias("_w"), column)
        .dropDuplicates(["_w", column])
        .select(_end("_w"), column)
    )
