"""Sliding windows of aggregates that can be merged but not subtracted: extremes, sketches, sets.

Panes as long as the slide are aggregated first. Time is cut into blocks as long as the window; a window then is the end of
one block and the beginning of the next. Running merges give every block's beginnings (from its first pane on) and ends
(back from its last), so a window of 720 panes costs one merge of two values, not 720. Both are step functions of the
window's start; between two steps windows are equal and are written out last.

Groups are a key and a block: at most one row per pane of the block, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.event_time import epoch_us, floor_to, micros, to_ms
from .sliding import starts_of


def sliding_merges(rows: DataFrame, ts: str, size, slide, keys: Sequence[str], aggregate: Column,
                   merged: Callable[[Column], Column], both: Callable[[Column, Column], Column],
                   unit: str | None = None) -> DataFrame:
    """``value`` per key and sliding window that holds a row: ``keys``, ``window_end`` (ms), ``value``.

    ``aggregate`` makes the value of a pane's rows, ``merged`` (an aggregate of values) that of several panes, ``both`` (a
    function of two values, either of which may be null) that of two parts. The window is a multiple of the slide. Rows
    without a time are in no window.
    """
    size, slide = micros(size), micros(slide)
    if size % slide:
        raise ValueError("the window must be a multiple of the slide")
    us = epoch_us(rows, ts, unit)
    panes = rows.where(F.col(ts).isNotNull()).groupBy(*keys, floor_to(us, slide).alias("_pane")).agg(aggregate.alias("_value"))
    panes = panes.withColumn("_block", floor_to(F.col("_pane"), size))
    in_block = Window.partitionBy(*keys, "_block")
    upto, from_here = (w.rowsBetween(Window.unboundedPreceding, Window.currentRow) for w in (
        in_block.orderBy("_pane"), in_block.orderBy(F.desc("_pane"))))
    parts = panes.select(
        *keys, "_block", "_pane", merged(F.col("_value")).over(upto).alias("_begin"), merged(F.col("_value")).over(from_here).alias("_end"),
        F.lag("_pane").over(in_block.orderBy("_pane")).alias("_before"), F.lead("_pane").over(in_block.orderBy("_pane")).alias("_after"))

    def step(home: Column, at: Column, end: Column, begin: Column) -> Column:
        return F.struct(home.alias("_home"), at.alias("_at"), end.alias("_e"), begin.alias("_b"))

    def known(value: Column) -> Column:
        return F.struct(value.alias("v"))

    block, pane = F.col("_block"), F.col("_pane")
    unchanged = F.lit(None)
    # windows that start in block ``_home``: its end from the start on, and the next block's beginning up to the window's end
    end_from = F.coalesce(F.col("_before") + F.lit(slide), block)
    steps = F.array_compact(F.array(
        step(block, end_from, known(F.col("_end")), unchanged),
        # behind the last pane nothing is left of the block; a window that starts in the next one has another home
        F.when(F.col("_after").isNull() & (pane + F.lit(slide) < block + F.lit(size)),
               step(block, pane + F.lit(slide), known(F.lit(None)), unchanged)),
        step(block - F.lit(size), pane + F.lit(slide - size), unchanged, known(F.col("_begin"))),
    ))
    marks = parts.select(*keys, F.inline(steps)).where(F.col("_at") < F.col("_home") + F.lit(size))
    order = Window.partitionBy(*keys, "_home").orderBy("_at")
    so_far = order.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    runs = marks.select(
        *keys, "_at", F.last("_e", ignorenulls=True).over(so_far)["v"].alias("_e"), F.last("_b", ignorenulls=True).over(so_far)["v"].alias("_b"),
        F.coalesce(F.lead("_at").over(order), F.col("_home") + F.lit(size)).alias("_next"))
    runs = runs.where((F.col("_next") > F.col("_at")) & (F.col("_e").isNotNull() | F.col("_b").isNotNull()))
    return runs.select(*keys, both(F.col("_e"), F.col("_b")).alias("value"), F.explode(starts_of(slide)).alias("_start")).select(
        *keys, to_ms(F.col("_start") + F.lit(size)).alias("window_end"), "value")


def sliding_largest(rows: DataFrame, column: str, ts: str = "ts", size="1 hour", slide="5 seconds", keys: Sequence[str] = (),
                    unit: str | None = None) -> DataFrame:
    """The largest ``column`` per sliding window; windows whose values are all null are left out."""
    return sliding_merges(rows.where(F.col(column).isNotNull()), ts, size, slide, keys, F.max(column), F.max, F.greatest, unit).withColumnRenamed(
        "value", "largest")


def sliding_distinct(rows: DataFrame, column: str, ts: str = "ts", size="1 hour", slide="5 seconds", keys: Sequence[str] = (),
                     unit: str | None = None, precision: int = 12) -> DataFrame:
    """Estimated distinct values per sliding window, by HyperLogLog sketches."""
    def both(a: Column, b: Column) -> Column:
        return F.coalesce(F.hll_sketch_estimate(F.hll_union(a, b)), F.hll_sketch_estimate(a), F.hll_sketch_estimate(b))

    return sliding_merges(rows.where(F.col(column).isNotNull()), ts, size, slide, keys, F.hll_sketch_agg(column, precision), F.hll_union_agg,
                          both, unit).withColumnRenamed("value", "count")
