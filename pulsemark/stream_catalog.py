"""Streaming queries by name: the ``events`` table read as a stream to its end.

The table is staged as files in the order of arrival, so many to a micro-batch. Records arrive up to nine minutes after
their time, so every batch but the first brings some that are older than what came before, and counts are corrected. The
last file ends the stream: one record of each event type, made by an aggregate of the table, lies so far past all others
that the watermark passes them all and every window, order and burst comes out. What these closing records would yield
themselves stays open and never appears. The SQL is therefore that of the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog import (BY_CHANNEL_SQL, DAILY_SQL, H6, HOUR, LOGINS, ORDER_SQL, SQL, TOTAL_SQL, URLS_SQL, VIEWS, ITEMS_SQL, _against_exact, _top, _tumble, query)
from .functions.event_time import epoch_us, event_time, micros, us_to_ntz
from .functions.hashing import id_position
from .operators import counts, distinct, parse, topn
from .session import scratch_dir, session_conf
from .sources import events as source
from .sources.readers import read_lines, stream_files
from .streaming import jobs, late, live, patterns, sinks

DELAY = "10 minutes"
BATCHES, FILES = 3, 8
CLOSING = "3650 days"
_STAGED: dict[tuple[str, str], str] = {}


def _last(table: DataFrame) -> int:
    """The table's last time in µs."""
    return table.agg(F.max(epoch_us(table, "ts"))).first()[0] or 0


def _files(table: DataFrame) -> int:
    """Files of a batch: they grow with the table."""
    return max(FILES, table.rdd.getNumPartitions() // BATCHES)


def _staged(spark: SparkSession, folder: str) -> str:
    """The folder of the table's files in order of arrival; written once per session and table."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _STAGED:
        path = scratch_dir(spark, "arrivals")
        table = source.table(spark, folder)
        files = _files(table)
        held_up = F.pmod(F.col("event_id") * 37, F.lit(41)) * F.lit(micros("9 minutes") // 41)
        rows = table.withColumn("_arrival", epoch_us(table, "ts") + held_up)
        cuts = rows.select(F.percentile_approx("_arrival", [i / BATCHES for i in range(1, BATCHES)])).first()[0] or []
        bounds = [None, *cuts, None]
        for low, high in zip(bounds[:-1], bounds[1:], strict=True):
            own = rows
            if low is not None:
                own = own.where(F.col("_arrival") > low)
            if high is not None:  # rows without a time come with the first batch
                upto = F.col("_arrival") <= high
                own = own.where(upto if low is not None else upto | F.col("_arrival").isNull())
            # the file source counts files, so every batch has as many
            own.drop("_arrival").repartitionByRange(files, "event_id").write.mode("append").parquet(path)
        closing = table.groupBy("event_type").agg(F.min("props").alias("props")).select(
            F.lit(-1).cast("bigint").alias("event_id"), us_to_ntz(F.lit(_last(table) + micros(CLOSING))).alias("ts"),
            F.lit(-1).cast("bigint").alias("user_id"), "event_type", F.lit(0.0).alias("value"), "props")
        closing.select(table.columns).coalesce(1).write.mode("append").parquet(path)
        _STAGED[key] = path
    return _STAGED[key]


def _events(spark: SparkSession, folder: str) -> DataFrame:
    table = source.table(spark, folder)
    return stream_files(spark, _staged(spark, folder), table.schema, files_per_trigger=_files(table))


def _views(spark: SparkSession, folder: str) -> DataFrame:
    return event_time(source.user_behavior(_events(spark, folder), only=["pv"]), "ts")


def _write(spark: SparkSession, stream: DataFrame, name: str, mode: str, shape=lambda df: df) -> str:
    path = scratch_dir(spark, name)
    with session_conf(spark, jobs.STATE_SETTINGS):
        writer = stream.writeStream.outputMode(mode).foreachBatch(sinks.batch_folders(f"{path}/out", shape))
        sinks.run_available(writer, f"{path}/checkpoint")
    return f"{path}/out"


def _own(rows: DataFrame, time: str, folder: str) -> DataFrame:
    """Without what belongs to the closing records; ``time`` is in µs."""
    last = _last(source.table(rows.sparkSession, folder))
    return rows.where(F.col(time) < last + micros(CLOSING) // 2)


@query("stream_hot_items", _top(ITEMS_SQL, "item_id", 3))
def stream_hot_items(spark, folder):
    """Each pane's count comes out once, when it is final; the reader ranks the windows of the panes as in batch."""
    panes = jobs.final_panes(_views(spark, folder), ["item_id"], slide="5 minutes", delay=DELAY)
    rows = sinks.read_batches(spark, _write(spark, panes, "hot-items", "append"))
    return topn.top_n_panes(rows.drop("batch_id"), "item_id", 3, slide="5 minutes")


@query("stream_hot_urls", _top(URLS_SQL, "url", 5))
def stream_hot_urls(spark, folder):
    """Pane counts are corrected as late records come; the ranking reads the newest ones."""
    lines = source.access_lines(_events(spark, folder).where("event_type = 'view'"))
    requests = event_time(parse.get_requests(parse.access_rows(lines)), "event_time", "ms")
    path = _write(spark, jobs.updating_panes(requests, ["url"], delay=DELAY), "hot-urls", "update")
    panes = _own(sinks.latest(sinks.read_batches(spark, path), ["url", "_pane"]), "_pane", folder)
    return topn.top_n_panes(panes, "url", 5, "1 minute")


def _market_panes(spark: SparkSession, folder: str) -> DataFrame:
    rows = event_time(source.market_behavior(_events(spark, folder), installed=True), "ts")
    panes = jobs.final_panes(rows, ["channel", "behavior"], slide="5 minutes", delay=DELAY)
    return sinks.read_batches(spark, _write(spark, panes, "market", "append")).drop("batch_id")


@query("stream_market_by_channel", BY_CHANNEL_SQL)
def stream_market_by_channel(spark, folder):
    return counts.market_windows(_market_panes(spark, folder), ["channel", "behavior"], slide="5 minutes")


@query("stream_market_total", TOTAL_SQL)
def stream_market_total(spark, folder):
    return counts.market_windows(_market_panes(spark, folder), [], slide="5 minutes")


@query("stream_uv_running", f"""SELECT {_tumble(HOUR)} AS window_end, count(DISTINCT user_id) AS count
 FROM {VIEWS} GROUP BY ALL""")
def stream_uv_running(spark, folder):
    """Every batch writes the new distinct users of each window; their sum so far is the running count, at the end the
    window's."""
    stream = jobs.first_seen(_views(spark, folder), "user_id", delay=DELAY)
    path = _write(spark, stream, "uv-running", "append", lambda df: df.groupBy("window_end").agg(F.count("*").alias("new")))
    rows = _own(sinks.read_batches(spark, path).withColumn("_us", F.col("window_end") * 1000), "_us", folder)
    return sinks.running_totals(rows, ["window_end"], "new").groupBy("window_end").agg(F.max("count").alias("count"))


@query("stream_uv_final", f"""SELECT {_tumble(HOUR)} AS window_end, count(DISTINCT user_id) AS count
 FROM {VIEWS} GROUP BY ALL""")
def stream_uv_final(spark, folder):
    stream = jobs.distinct_final(_views(spark, folder), "user_id", delay=DELAY)
    return sinks.read_batches(spark, _write(spark, stream, "uv-final", "append")).drop("batch_id")


@query("sink_upsert_latest", SQL["pv_hourly"])
def sink_upsert_latest(spark, folder):
    """A latest-value table kept by an update-mode stream, compacted every second batch."""
    stream, path = jobs.page_views(_views(spark, folder), delay=DELAY), scratch_dir(spark, "pv")
    with session_conf(spark, jobs.STATE_SETTINGS):
        writer = stream.writeStream.outputMode("update").foreachBatch(
            sinks.upsert_batches(f"{path}/out", ["label", "window_end"], every=2))
        sinks.run_available(writer, f"{path}/checkpoint")
    newest = sinks.read_upserts(spark, f"{path}/out", ["label", "window_end"]).withColumn("_us", F.col("window_end") * 1000)
    return _own(newest, "_us", folder).drop("_us")


def _order_stream(spark: SparkSession, folder: str) -> DataFrame:
    return event_time(source.order_events(_events(spark, folder)), "event_time").select(
        "order_id", "event_id", "event_type", "ts"
    )


@query("stream_order_timeout", ORDER_SQL)
def stream_order_timeout(spark, folder):
    """Successes and timeouts go to two tables; both are read back."""
    path = scratch_dir(spark, "orders")
    sink = sinks.split_batches({
        "success": sinks.batch_folders(f"{path}/success"), "timeout": sinks.batch_folders(f"{path}/timeout"),
    })
    with session_conf(spark, jobs.STATE_SETTINGS):
        stream = patterns.order_results(_order_stream(spark, folder), within="6 hours", delay=DELAY)
        sinks.run_available(stream.writeStream.outputMode("append").foreachBatch(sink), f"{path}/checkpoint")
    both = sinks.read_batches(spark, f"{path}/success").unionByName(
        sinks.read_batches(spark, f"{path}/timeout"))
    # the closing click and purchase are an order of their own
    return both.where("order_id >= 0").drop("batch_id")


def _login_stream(spark: SparkSession, folder: str, failed: bool) -> DataFrame:
    rows = source.login_events(_events(spark, folder), failed=failed)
    return event_time(rows, "event_time").drop("event_time")


_CUTS = f"""SELECT *, min(us) OVER (PARTITION BY user_id ORDER BY us
 RANGE BETWEEN {H6} PRECEDING AND CURRENT ROW) + {H6} AS cut_us"""


@query("stream_login_fail_burst", f"""SELECT user_id, event_id, ip, 'fail' AS event_type, size FROM (
 SELECT user_id, cut_us, arg_min(id, (us, id)) AS event_id, arg_min(ip, (us, id)) AS ip, count(*) AS size
 FROM ({_CUTS} FROM {LOGINS} WHERE kind = 'fail') GROUP BY user_id, cut_us) WHERE size > 1""")
def stream_login_fail_burst(spark, folder):
    stream = patterns.fail_bursts(_login_stream(spark, folder, True), within="6 hours", delay=DELAY)
    path = _write(spark, stream, "bursts", "append")
    return sinks.read_batches(spark, path).drop("batch_id")


@query("stream_login_fail_burst_list", f"""SELECT user_id, cut_us, size, event_id, ip, 'fail' AS event_type FROM (
 SELECT user_id, cut_us, id AS event_id, ip, count(*) OVER (PARTITION BY user_id, cut_us) AS size
 FROM (SELECT * FROM ({_CUTS} FROM {LOGINS}) WHERE kind = 'fail')) WHERE size > 1""")
def stream_login_fail_burst_list(spark, folder):
    stream = patterns.fail_bursts(_login_stream(spark, folder, False), within="6 hours", delay=DELAY, members=True)
    path = _write(spark, stream, "burst-members", "append")
    return sinks.read_batches(spark, path).drop("batch_id")


@query("stream_login_fail_cep", SQL["login_fail_cep"])
def stream_login_fail_cep(spark, folder):
    stream = patterns.fail_sequences(_login_stream(spark, folder, False), within="12 hours", delay=DELAY)
    return sinks.read_batches(spark, _write(spark, stream, "sequences", "append")).drop("batch_id")


@query("stream_login_fail_pair", SQL["login_fail_pair"])
def stream_login_fail_pair(spark, folder):
    stream = patterns.fail_pairs(_login_stream(spark, folder, False), within="12 hours", delay=DELAY)
    return sinks.read_batches(spark, _write(spark, stream, "pairs", "append")).drop("batch_id")


@query("stream_uv_per_event", SQL["uv_running"])
def stream_uv_per_event(spark, folder):
    """Every view leaves the stream with the number of distinct users of its window so far."""
    path = scratch_dir(spark, "uv-events")
    with session_conf(spark, jobs.STATE_SETTINGS):
        writer = live.first_rows(_views(spark, folder), "user_id", delay=DELAY).writeStream.outputMode("append")
        sinks.run_available(writer.foreachBatch(live.running_counts(path)), f"{path}/checkpoint")
    return sinks.read_batches(spark, f"{path}/rows").select("window_end", "event_id", F.col("value").alias("user_id"), "count")


def _estimates(spark: SparkSession, folder: str, stream: DataFrame, keys: list[str], name: str, mode: str = "update") -> DataFrame:
    """The rows that stand when the stream has ended, without those of the closing records."""
    path = _write(spark, stream, name, mode)
    return _own(live.standing(spark, path, keys).withColumn("_us", F.col("window_end") * 1000), "_us", folder).drop("_us")


@query("stream_uv_hll", DAILY_SQL)
def stream_uv_hll(spark, folder):
    """Hourly sketches kept as state and corrected by late rows, merged into days, held against the exact counts."""
    hourly = _estimates(spark, folder, live.sketch_updates(_views(spark, folder), "user_id", delay=DELAY), ["window_end"], "sketches")
    return _against_exact(spark, folder, distinct.estimate_sketches(distinct.merge_sketches(hourly, "1 day")), 1.04 / 2 ** 6)


@query("stream_uv_bitmap", SQL["uv_bitmap"])
def stream_uv_bitmap(spark, folder):
    """The same with exact bitmaps, hour by hour."""
    stream = live.bitmap_updates(_views(spark, folder), id_position(F.col("user_id")), delay=DELAY)
    return distinct.count_bitmaps(_estimates(spark, folder, stream, ["window_end", "bucket"], "bitmaps"))


def _reports(spark: SparkSession, stream: DataFrame, key: str, n: int, report, **windows) -> DataFrame:
    path = scratch_dir(spark, "reports")
    with session_conf(spark, jobs.STATE_SETTINGS):
        writer = live.leaders(stream, key, n, delay=DELAY, **windows).writeStream.outputMode("append")
        sinks.run_available(writer.foreachBatch(live.leader_batches(f"{path}/out", key, n, report)), f"{path}/checkpoint")
    return sinks.read_batches(spark, f"{path}/out").drop("batch_id")


@query("stream_hot_items_report", SQL["hot_items_report"])
def stream_hot_items_report(spark, folder):
    """Each window's report is written once, by the batch whose watermark passes the window."""
    return _reports(spark, _views(spark, folder), "item_id", 3, topn.item_report, slide="5 minutes")


@query("stream_hot_urls_report", SQL["hot_urls_report"])
def stream_hot_urls_report(spark, folder):
    lines = source.access_lines(_events(spark, folder).where("event_type = 'view'"))
    requests = event_time(parse.get_requests(parse.access_rows(lines)), "event_time", "ms")
    return _reports(spark, requests, "url", 5, topn.url_report, size="1 minute", slide="5 seconds")


@query("stream_late_records", "SELECT event_id, ts IS NOT NULL AS timed, true AS once FROM events")
def stream_late_records(spark, folder):
    """A gate with a shorter delay than records are held up parts accepted, late and timeless records; no record is lost."""
    path = scratch_dir(spark, "gate")
    stream = event_time(_events(spark, folder), "ts", to="ts").where("event_id >= 0")
    with session_conf(spark, jobs.STATE_SETTINGS):
        sinks.run_available(stream.writeStream.foreachBatch(late.gate(path, "2 minutes")), f"{path}/checkpoint")
    by_status = late.read_gate(spark, path).groupBy("event_id").agg(
        F.max((F.col("status") != late.NO_TIME).cast("int")).alias("_timed"), F.count("*").alias("_n"))
    return by_status.select("event_id", (F.col("_timed") == 1).alias("timed"), (F.col("_n") == 1).alias("once"))


@query("land_raw_stream", SQL["parse_behavior_csv"])
def land_raw_stream(spark, folder):
    """Lines are landed as they come and parsed from the landed files."""
    path = scratch_dir(spark, "landed")
    lines = source.behavior_lines(_events(spark, folder).where("event_id >= 0"))
    sinks.run_available(sinks.land_raw(lines, f"{path}/out", "text"), f"{path}/checkpoint")
    return parse.behavior_rows(read_lines(spark, f"{path}/out"), missing=True)
