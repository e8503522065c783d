"""Ranking inside windows and the text reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.event_time import floor_to, micros, timestamp_text, to_ms
from ..plans.sliding import pane_counts, segments_of, starts_of, windows_of

# The words and rules of the two reports.
TIME_LABEL = "时间："
ITEM_LABEL, ITEM_COUNT_LABEL, ITEM_RULE = "商品ID", "浏览量", "=" * 19
URL_LABEL, URL_COUNT_LABEL, URL_RULE = "URL", "访问量", "=" * 57


def top_n(counts: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` largest counts of each window, with their ``rank``.

    Equal counts rank by key. Spark prunes to ``n`` rows per window in each map
    task (WindowGroupLimit) before it shuffles.
    """
    order = Window.partitionBy("window_end").orderBy(F.desc("count"), F.asc(key))
    return (
        counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
        .select("window_end", "rank", key, "count")
    )


def top_n_sliding(rows: DataFrame, key: str, n: int, ts: str = "ts", size="1 hour", slide="5 seconds",
                  unit: str | None = None, buckets: int | None = None) -> DataFrame:
    """``top_n`` of sliding counts, ranked before the windows are written out."""
    panes = pane_counts(rows, ts, micros(size), micros(slide), [key], unit)
    return top_n_panes(panes, key, n, size, slide, buckets)


def top_n_panes(panes: DataFrame, key: str, n: int, size="1 hour", slide="5 seconds", buckets: int | None = None) -> DataFrame:
    """``top_n`` of the sliding counts of pane counts (key, ``_pane``, ``_n``).

    With 720 windows per hour the counts of all keys in all windows may outnumber
    the input by far. Neighbouring windows are taken together as a block:

    - Over a block a key's count has a floor (zero unless it is present
      throughout) and a ceiling. If ``n`` keys have a floor that beats a key's
      ceiling, that key ranks in none of the block's windows and is left out.
      Keys are compared within ``buckets`` by hash, where they lie together
      already, so this takes no shuffle; being held against fewer keys, it only
      ever keeps more.
    - Ranks change only where some count changes. They are taken once per run of
      equal windows, first within the buckets, still without a shuffle, then
      among the ``n`` best of each: whatever the number of keys, a block's last
      task gets ``n`` rows per bucket and run. The ranked rows alone are then
      written out window by window.

    Buckets are four per shuffle partition unless given. The result is that of
    ``top_n(sliding_counts(...))``.
    """
    size, slide = micros(size), micros(slide)
    if buckets is None:
        buckets = 4 * int(panes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    block = _block_steps(size, slide) * slide
    if block < 4 * slide:  # blocks about as fine as the windows: nothing to gain
        windows = windows_of(panes, size, slide, [key])
        return top_n(
            windows.select(key, to_ms(F.col("_start") + F.lit(size)).alias("window_end"), "count"), key, n
        )
    contenders = _contenders(panes, key, n, size, slide, block, buckets)
    within = _ranked(_runs(contenders, key, slide, block, ["_bucket", "_stretch", "_block"]), key, n, ["_bucket", "_stretch"])
    best = _ranked(_runs(within.drop("rank", "_bucket", "_stretch"), key, slide, block, ["_block"]), key, n, [])
    return (
        best.select(F.explode(starts_of(slide)).alias("_start"), "rank", key, "count")
        .select(to_ms(F.col("_start") + F.lit(size)).alias("window_end"), "rank", key, "count")
    )


def _ranked(runs: DataFrame, key: str, n: int, within: list[str]) -> DataFrame:
    order = Window.partitionBy(*within, "_block", "_at").orderBy(F.desc("count"), F.asc(key))
    return runs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def _block_steps(size: int, slide: int) -> int:
    """Slides per block: a divisor of the slides per window, about a twelfth of them,
    and few enough to be numbered by the bits of a bigint."""
    steps, rest = divmod(size, slide)
    if rest:
        return 1
    return max(d for d in range(1, max(1, min(steps // 12, 62)) + 1) if steps % d == 0)


def _contenders(panes: DataFrame, key: str, n: int, size: int, slide: int, block: int,
                buckets: int) -> DataFrame:
    """Segments (cut at block borders) of the keys that may rank in their block."""
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).alias("_bucket")
    segments = segments_of(panes.withColumn("_bucket", bucket), size, slide, [key], spread=["_bucket"])
    first, last = floor_to(F.col("_at"), block), floor_to(F.col("_next") - F.lit(slide), block)
    pieces = segments.withColumn(
        "_block", F.explode(F.sequence(first, last, F.lit(block).cast("bigint")))
    ).withColumns({
        "_at": F.greatest("_at", "_block"), "_next": F.least("_next", F.col("_block") + F.lit(block)),
    })
    # at most one piece per window of the block
    per_block = pieces.groupBy("_bucket", "_stretch", key, "_block").agg(
        F.max("count").alias("_ceiling"), F.min("count").alias("_least"),
        F.sum(F.col("_next") - F.col("_at")).alias("_covered"),
        F.collect_list(F.struct("_at", "_next", "count")).alias("_pieces"),
    )
    floor = F.when(F.col("_covered") == F.lit(block), F.col("_least")).otherwise(F.lit(0))
    rivals = (
        Window.partitionBy("_bucket", "_stretch", "_block").orderBy(F.desc("_floor"), F.asc(key))
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    # equal counts rank by key, nulls first
    wins_tie = F.col(key).isNull() | F.coalesce(F.col(key) <= F.col("_bar_key"), F.lit(False))
    may_rank = (
        F.col("_bar").isNull() | (F.col("_ceiling") > F.col("_bar"))
        | ((F.col("_ceiling") == F.col("_bar")) & wins_tie)
    )
    return (
        per_block.withColumn("_floor", floor)
        .withColumn("_bar", F.nth_value("_floor", n).over(rivals))
        .withColumn("_bar_key", F.nth_value(key, n).over(rivals))
        .where(may_rank)
        .select("_bucket", "_stretch", "_block", key, F.inline("_pieces"))
    )


def _runs(pieces: DataFrame, key: str, slide: int, block: int, within: list[str]) -> DataFrame:
    """Cut the pieces of a block (or of its part ``within`` which they lie) wherever one of them begins or ends.

    A block has fewer windows than a bigint has bits, so the borders of a block
    are one number, bit i standing for its i-th window.
    """
    steps = block // slide

    def place(at: str) -> Column:
        return F.call_function("div", F.col(at) - F.col("_block"), F.lit(slide)).cast("int")

    def bit(i: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("bigint"), i)

    border = bit(F.col("_i")).bitwiseOR(F.when(F.col("_j") < steps, bit(F.col("_j"))).otherwise(F.lit(0)))
    later = F.call_function("shiftrightunsigned", F.col("_borders"), F.col("_k") + F.lit(1))
    # zeros below the lowest set bit
    gap = F.bit_count(later.bitwiseAND(-later) - F.lit(1))
    end = F.when(later == 0, F.lit(steps)).otherwise(F.col("_k") + F.lit(1) + gap)
    return (
        pieces.select(*within, key, "count", place("_at").alias("_i"), place("_next").alias("_j"))
        .withColumn("_borders", F.bit_or(border).over(Window.partitionBy(*within)))
        .select(*within, key, "count", "_borders",
                F.explode(F.sequence(F.col("_i"), F.col("_j") - F.lit(1))).alias("_k"))
        .where(F.getbit("_borders", F.col("_k")) == 1)
        .select(*within, key, "count", (F.col("_block") + F.col("_k") * F.lit(slide)).alias("_at"),
                (F.col("_block") + end * F.lit(slide)).alias("_next"))
    )


def _report(ranked: DataFrame, key: str, key_label: str, count_label: str, rule: str) -> DataFrame:
    # at most n rows per window
    rows = F.sort_array(F.collect_list(F.struct("rank", key, "count")))

    def line(row: Column) -> Column:
        return F.concat(F.lit("No"), row["rank"], F.lit(f": {key_label}="), row[key],
                        F.lit(f" {count_label}="), row["count"])

    head = F.concat(F.lit(TIME_LABEL), timestamp_text(F.col("window_end") * 1000))
    return ranked.groupBy("window_end").agg(rows.alias("_rows")).select(
        "window_end",
        F.concat_ws("\n", head, F.array_join(F.transform("_rows", line), "\n"), F.lit(rule))
        .alias("report"),
    )


def item_report(ranked: DataFrame) -> DataFrame:
    """One text per window from the output of ``top_n(…, 'item_id', n)``."""
    return _report(ranked, "item_id", ITEM_LABEL, ITEM_COUNT_LABEL, ITEM_RULE)


def url_report(ranked: DataFrame) -> DataFrame:
    """One text per window from the output of ``top_n(…, 'url', n)``."""
    return _report(ranked, "url", URL_LABEL, URL_COUNT_LABEL, URL_RULE)
