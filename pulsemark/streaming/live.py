"""Answers that leave the stream while it runs: a count per element, a report per window, estimates kept as state."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.event_time import interval, micros
from ..operators import topn
from ..plans.running import running
from ..plans.sliding import tumbling
from .jobs import ASCENDING
from .reorder import Rows, Rule, reordered, without_ids
from .sinks import BatchWriter, latest, read_batches

# ---- running distinct counts, per element ----

SEEN = "window_end bigint, us bigint, event_id bigint, value bigint, new bigint"


@dataclass
class FirstSeen(Rule):
    """Marks each value's first row in a window, in event time; a bitmap keeps the values of a window and bucket."""

    bits: int
    columns = ["value"]
    keep = 0

    def _fresh(self, rows: Rows, carry: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Per row whether its value is new, and the bit of every row (-1 without a value)."""
        value = rows.of["value"]
        known = value.notna().to_numpy()
        bit = np.where(known, value.fillna(0).to_numpy(dtype=np.int64) % self.bits, -1)
        seen = np.unpackbits(np.frombuffer(carry, np.uint8)) if carry else np.zeros(self.bits, np.uint8)
        first = np.zeros(len(rows), bool)
        first[np.unique(bit, return_index=True)[1]] = True
        return first & known & (seen[bit] == 0), bit

    def settle(self, key, rows, carry):
        new, _ = self._fresh(rows, carry)
        return rows.us, pd.DataFrame({"window_end": key[0], "us": rows.us, "event_id": rows.id, "value": rows.of["value"].astype("Int64"),
                                      "new": new.astype(np.int64)})

    def until(self, key):
        return key[0] * 1000

    def carried(self, key, rows, carry, since, now):
        if now >= self.until(key):
            return b""
        _, bit = self._fresh(rows, b"")
        seen = np.unpackbits(np.frombuffer(carry, np.uint8)) if carry else np.zeros(self.bits, np.uint8)
        seen[bit[(rows.us <= now) & (bit >= 0)]] = 1
        return np.packbits(seen).tobytes()


def first_rows(stream: DataFrame, column: str, event_id: str = "event_id", size="1 hour", delay=ASCENDING, bits: int = 12) -> DataFrame:
    """Every row of the stream when the watermark passes it, with ``new`` = 1 if its value is the first in its window.

    ``column`` is an integer; its state is one bitmap of 2^``bits`` per window and range of so many values, gone when the
    window is over. Rows without a value are never new. Columns: window_end (ms), us, event_id, value, new.
    """
    us = F.unix_micros("ts")
    rows = stream.where(F.col("ts").isNotNull()).withWatermark("ts", interval(delay)).select(
        "ts", us.alias("us"), F.col(event_id).alias("id"), F.col(column).cast("bigint").alias("value"),
        tumbling(us, size).alias("window_end"), F.shiftright(F.col(column).cast("bigint"), bits).alias("bucket"))
    return without_ids(reordered(rows, ["window_end", "bucket"], FirstSeen(1 << bits), SEEN), "event_id")


def running_counts(path: str, size="1 hour", slices: int = 36_000) -> BatchWriter:
    """Writes the rows of ``first_rows`` with ``count``, the window's distinct values up to each row.

    A batch's rows are all later than those of the batches before it, so a row's count is what earlier batches have found
    in its window (a number per window and batch, kept beside the rows) plus the running sum inside its own batch, taken
    in ``slices`` per window. A repeated batch replaces what it wrote.
    """
    length = micros(size)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{path}/marks/batch_id={batch_id}")
        marks = spark.read.schema(batch.schema).parquet(f"{path}/marks/batch_id={batch_id}")
        marks.groupBy("window_end").agg(F.sum("new").alias("new")).write.mode("overwrite").parquet(f"{path}/new/batch_id={batch_id}")
        earlier = read_batches(spark, f"{path}/new").where(F.col("batch_id") < batch_id).groupBy("window_end").agg(F.sum("new").alias("_before"))
        slice_no = F.expr(f"pmod(us, {length}) div {max(1, length // slices)}")
        counted = running(marks, ["window_end"], slice_no, ["us", "event_id"], "new", "sum", "count")
        made = counted.join(earlier, "window_end", "left").select(
            "window_end", "event_id", "value", (F.col("count") + F.coalesce("_before", F.lit(0))).alias("count"))
        made.write.mode("overwrite").parquet(f"{path}/rows/batch_id={batch_id}")

    return write


# ---- a report per window ----

MOST_CELLS = 1 << 22  # keys x windows that are counted at a time
LEADERS = "window_end bigint, place int, key {kind}, count bigint"


@dataclass
class Leaders(Rule):
    """The ``n`` largest keys of a bucket for every sliding window, from a ring of pane counts."""

    n: int
    size: int
    slide: int
    columns = ["key", "n"]

    @property
    def keep(self) -> int:
        return self.size

    def settle(self, key, rows, carry):
        # ends of the first and last window that a pane, as long as the slide, lies in
        first, last = rows.us + self.slide, rows.us + self.size
        each = np.unique(first)
        gap = np.flatnonzero(np.diff(each) > self.size)
        runs = zip(each[np.append(0, gap + 1)], each[np.append(gap, len(each) - 1)] + self.size, strict=True)
        ends = np.concatenate([np.arange(a, b, self.slide) for a, b in runs])
        names, codes = np.unique(rows.of["key"].to_numpy(), return_inverse=True)
        enter, leave = np.searchsorted(ends, first), np.searchsorted(ends, last, side="right")
        step, out = max(1, MOST_CELLS // max(len(names), 1)), []
        n = rows.of["n"].to_numpy()
        for at in range(0, len(ends), step):
            to = min(at + step, len(ends))
            edges = np.zeros((len(names), to - at + 1), np.int64)
            inside = (enter < to) & (leave > at)
            np.add.at(edges, (codes[inside], np.maximum(enter[inside], at) - at), n[inside])
            np.add.at(edges, (codes[inside], np.minimum(leave[inside], to) - at), -n[inside])
            counts = np.cumsum(edges, axis=1)[:, :-1]
            # names are in order, so a stable sort ranks equal counts by key
            best = np.argsort(-counts, axis=0, kind="stable")[:self.n]
            top = np.take_along_axis(counts, best, axis=0)
            place, window = np.nonzero(top > 0)
            out.append(pd.DataFrame({"window_end": ends[at + window] // 1000, "place": place.astype(np.int32) + 1,
                                     "key": names[best[place, window]], "count": top[place, window]}))
        made = pd.concat(out, ignore_index=True)
        return made["window_end"].to_numpy() * 1000, made


def leaders(stream: DataFrame, key: str, n: int, size="1 hour", slide="5 seconds", delay=ASCENDING, buckets: int = 64) -> DataFrame:
    """The ``n`` best keys of each of ``buckets`` for each sliding window, once, when the watermark passes its end.

    Rows are counted per key and pane by an aggregation; the panes of the last window of a bucket's keys are its state.
    All buckets answer for a window in the same micro-batch, so the best of all are found per batch (``leader_batches``).
    The window is a multiple of the slide; keys that are null take no part. Columns: window_end (ms), place, key, count.
    """
    size, slide = micros(size), micros(slide)
    if size % slide:
        raise ValueError("the window must be a multiple of the slide")
    panes = (
        stream.where(F.col(key).isNotNull()).withWatermark("ts", interval(delay))
        .groupBy(F.window("ts", f"{slide} microseconds").alias("_w"), F.col(key).alias("key")).agg(F.count("*").alias("n"))
        .select(F.window_time("_w").alias("ts"), F.unix_micros("_w.start").alias("us"), F.lit(0).cast("bigint").alias("id"), "key", "n",
                F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("bucket"))
    )
    kind = stream.schema[key].dataType.simpleString()
    return reordered(panes, ["bucket"], Leaders(n, size, slide), LEADERS.format(kind=kind))


def leader_batches(path: str, key: str, n: int, report: Callable[[DataFrame], DataFrame] | None = None) -> BatchWriter:
    """Writes the ``n`` best of all buckets per window, ranked, or their ``report``; a window is in one batch only."""
    def write(batch: DataFrame, batch_id: int) -> None:
        ranked = topn.top_n(batch.select("window_end", F.col("key").alias(key), "count"), key, n)
        (report(ranked) if report else ranked).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


# ---- sketches and bitmaps as state ----


def sketch_updates(stream: DataFrame, column: str, size="1 hour", delay="10 minutes", precision: int = 12) -> DataFrame:
    """A HyperLogLog sketch per tumbling window, kept as aggregation state; late rows bring out the window's sketch anew
    (update mode). Columns: window_end (ms), sketch."""
    return (
        stream.withWatermark("ts", interval(delay)).groupBy(F.window("ts", interval(size)).alias("_w"))
        .agg(F.hll_sketch_agg(column, precision).alias("sketch"))
        .select(F.unix_millis("_w.end").alias("window_end"), "sketch")
    )


def bitmap_updates(stream: DataFrame, position, size="1 hour", delay="10 minutes") -> DataFrame:
    """The same with exact bitmaps of ``position`` (a column of bit positions): window_end (ms), bucket, bitmap."""
    return (
        stream.withWatermark("ts", interval(delay))
        .groupBy(F.window("ts", interval(size)).alias("_w"), F.bitmap_bucket_number(position).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(position)).alias("bitmap"))
        .select(F.unix_millis("_w.end").alias("window_end"), "bucket", "bitmap")
    )


def standing(spark: SparkSession, path: str, keys: list[str], batch_id: int | None = None) -> DataFrame:
    """What an update-mode stream says of every key after a batch (the last one unless given)."""
    rows = read_batches(spark, path)
    return latest(rows if batch_id is None else rows.where(F.col("batch_id") <= batch_id), keys)
