"""Which records would a watermark have dropped?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.event_time import epoch_us, floor_to, micros
from ..plans.running import running

ON_TIME, LATE_ACCEPTED, DROPPED, NO_TIME = "on_time", "late_accepted", "dropped", "no_time"


def late_records(rows: DataFrame, arrival: str, keys: Sequence[str] = (), ts: str = "ts",
                 size="1 minute", slide="5 seconds", delay="10 seconds", lateness="60 seconds",
                 unit: str | None = None, event_id: str = "event_id",
                 chunk_rows: int = 1 << 20) -> DataFrame:
    """Add ``status`` and how many of the record's windows take it.

    The watermark before a record is the largest time seen so far (in order of
    ``arrival``, then ``event_id``) less ``delay``. A window fires at its last
    millisecond and stays open ``lateness`` longer. ``on_time``: no window of the
    record has fired. ``late_accepted``: some window still takes it after firing
    or after others closed. ``dropped``: all are closed.

    The running maximum is cut by ``arrival`` into pieces ``chunk_rows`` wide, in the unit of ``arrival``: for dense
    numbers that many rows; where arrival is a time, give the width that holds about a million rows. Records without a
    time have no window and get the status ``no_time``.
    """
    size, slide, delay, lateness = (micros(d) for d in (size, slide, delay, lateness))
    millisecond = 1_000
    timed = rows.where(F.col(ts).isNotNull()).withColumn("_us", epoch_us(rows, ts, unit))
    seen = running(timed, keys, F.expr(f"`{arrival}` div {chunk_rows}"), [arrival, event_id],
                   "_us", "max", "_seen", exclusive=True)
    # ends of the record's first and last window; ends are `slide` apart
    first = floor_to(F.col("_us") - F.lit(size), slide) + F.lit(slide + size)
    last = floor_to(F.col("_us"), slide) + F.lit(size)
    watermark = F.col("_seen") - F.lit(delay)

    def ends_up_to(limit: Column) -> Column:
        """How many of the record's windows end at ``limit`` or before."""
        steps = F.call_function("div", floor_to(limit - first, slide), F.lit(slide)) + F.lit(1)
        return F.least(F.col("windows"), F.greatest(F.coalesce(steps, F.lit(0)), F.lit(0)))

    none = rows.where(F.col(ts).isNull()).withColumns({
        **{name: F.lit(0).cast("bigint") for name in ("windows", "fired", "closed")}, "status": F.lit(NO_TIME)})
    return (
        seen.withColumn("windows", F.call_function("div", last - first, F.lit(slide)) + F.lit(1))
        .withColumn("fired", ends_up_to(watermark + F.lit(millisecond)))
        .withColumn("closed", ends_up_to(watermark + F.lit(millisecond - lateness)))
        .withColumn("status", F.when(F.col("fired") == 0, ON_TIME)
                    .when(F.col("closed") < F.col("windows"), LATE_ACCEPTED).otherwise(DROPPED))
        .drop("_us", "_seen").unionByName(none)
    )


def late_audit(records: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Records per status."""
    return records.groupBy(*keys, "status").agg(F.count(F.lit(1)).alias("records"))
