"""Every query by name: the Spark callable and, where SQL can say it, the SQL.

Durations are longer than the operators' defaults where the shared ``events``
table (one event every few minutes) would leave second-sized windows empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.hashing import id_position
from .operators import counts, distinct, enrich, lateness, parse, patterns, topn
from .plans import merging
from .sources import events as source

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def _views(spark: SparkSession, folder: str) -> DataFrame:
    return source.user_behavior(source.table(spark, folder), only=["pv"])


def _requests(spark: SparkSession, folder: str) -> DataFrame:
    lines = source.access_lines(source.table(spark, folder).where("event_type = 'view'"))
    return parse.get_requests(parse.access_rows(lines))


# --- SQL fragments -----------------------------------------------------------------

K = "CAST(json_extract(props, '$.k') AS BIGINT)"
VIEWS = f"(SELECT event_id, ts, user_id, {K} AS item_id FROM events WHERE event_type = 'view')"
GETS = f"""(SELECT date_trunc('second', ts) AS ts, '/www/' || CAST({K} % 10 AS VARCHAR) AS url
 FROM events WHERE event_type = 'view')"""
MARKET = f"""(SELECT ts, CAST({K} % 4 AS VARCHAR) AS channel, event_type AS behavior
 FROM events WHERE event_type <> 'error')"""
LOGINS = f"""(SELECT event_id AS id, user_id, epoch_us(ts) AS us, ts, '10.0.0.' || CAST({K} % 256 AS VARCHAR) AS ip,
 CASE WHEN event_type = 'error' THEN 'fail' ELSE 'success' END AS kind FROM events)"""
ORDERS = """(SELECT event_id AS id, user_id AS order_id, epoch_us(ts) AS us,
 CASE event_type WHEN 'click' THEN 'create' ELSE 'pay' END AS kind
 FROM events WHERE event_type IN ('click', 'purchase'))"""


def _tumble(size_ms: int) -> str:
    return f"((epoch_us(ts) // 1000) // {size_ms} + 1) * {size_ms}"


def _sliding(rows: str, size_ms: int, slide_ms: int, keys: str) -> str:
    """Counts per key and window end, one row per window a record falls into."""
    head = f"{keys}, " if keys else ""
    return f"""SELECT {head}((epoch_us(ts) // 1000) // {slide_ms} + 1 + i) * {slide_ms} AS window_end,
 count(*) AS count FROM {rows} e, generate_series(0, {size_ms // slide_ms - 1}) g(i) GROUP BY ALL"""


def _stamp(ms: str) -> str:
    return f"strftime(make_timestamp(({ms}) * 1000), '%Y-%m-%d %H:%M:%S') || '.0'"


def _top(counts_sql: str, key: str, n: int) -> str:
    return f"""SELECT window_end, CAST(rn AS INTEGER) AS rank, {key}, count FROM (SELECT *, row_number() OVER (
 PARTITION BY window_end ORDER BY count DESC, {key}) AS rn FROM ({counts_sql})) WHERE rn <= {n}"""


def _report(top_sql: str, key: str, label: str, count_label: str, rule: str) -> str:
    return f"""SELECT window_end, '{topn.TIME_LABEL}' || {_stamp('window_end')} || chr(10) ||
 string_agg('No' || rank || ': {label}=' || {key} || ' {count_label}=' || count, chr(10) ORDER BY rank)
 || chr(10) || '{rule}' AS report FROM ({top_sql}) GROUP BY window_end"""


HOUR, MINUTE = 3_600_000, 60_000
ITEMS_SQL = _sliding(VIEWS, HOUR, 5 * MINUTE, "item_id")
URLS_SQL = _sliding(GETS, MINUTE, 5_000, "url")

# --- parsing and filters -----------------------------------------------------------


@query("parse_behavior_csv", f"""SELECT user_id, {K} AS item_id, CAST({K} % 20 AS INTEGER) AS category_id,
 CASE event_type WHEN 'view' THEN 'pv' WHEN 'purchase' THEN 'buy' WHEN 'click' THEN 'cart' WHEN 'signup' THEN 'fav'
 ELSE event_type END AS behavior, (epoch_us(ts) // 1000) AS timestamp FROM events""")
def parse_behavior_csv(spark, folder):
    return parse.behavior_rows(source.behavior_lines(source.table(spark, folder)), missing=True)


@query("parse_access_log", f"""SELECT '192.168.' || CAST(user_id % 256 AS VARCHAR) || '.' ||
 CAST((user_id // 256) % 256 AS VARCHAR) AS ip, '-' AS user_id, epoch_us(date_trunc('second', ts)) // 1000 AS event_time,
 CASE WHEN event_type = 'view' THEN 'GET' ELSE 'POST' END AS method,
 '/www/' || CAST({K} % 10 AS VARCHAR) AS url FROM events""")
def parse_access_log(spark, folder):
    return parse.access_rows(source.access_lines(source.table(spark, folder)))


@query("filter_pv", f"""SELECT event_id, user_id, {K} AS item_id, CAST({K} % 20 AS INTEGER) AS category_id,
 'pv' AS behavior FROM events WHERE event_type = 'view'""")
def filter_pv(spark, folder):
    return parse.page_view_rows(_views(spark, folder)).drop("ts")


@query("filter_get", f"""SELECT epoch_us(date_trunc('second', ts)) // 1000 AS event_time, 'GET' AS method,
 '/www/' || CAST({K} % 10 AS VARCHAR) AS url FROM events WHERE event_type = 'view'""")
def filter_get(spark, folder):
    lines = source.access_lines(source.table(spark, folder))
    return parse.get_requests(parse.access_rows(lines)).select("event_time", "method", "url")


# --- counts ------------------------------------------------------------------------


@query("pv_hourly", f"""SELECT 'pv' AS label, {_tumble(HOUR)} AS window_end, count(*) AS count
 FROM events WHERE event_type = 'view' GROUP BY ALL""")
def pv_hourly(spark, folder):
    return counts.page_views(_views(spark, folder))


@query("hot_items_counts", ITEMS_SQL)
def hot_items_counts(spark, folder):
    return counts.hot_item_counts(_views(spark, folder), slide="5 minutes")


@query("hot_items_counts_5s", _sliding(VIEWS, HOUR, 5_000, "item_id"))
def hot_items_counts_5s(spark, folder):
    return counts.hot_item_counts(_views(spark, folder))


@query("hot_items_topn", _top(ITEMS_SQL, "item_id", 3))
def hot_items_topn(spark, folder):
    return topn.top_n_sliding(_views(spark, folder), "item_id", 3, slide="5 minutes")


@query("hot_items_topn_5s", _top(_sliding(VIEWS, HOUR, 5_000, "item_id"), "item_id", 3))
def hot_items_topn_5s(spark, folder):
    return topn.top_n_sliding(_views(spark, folder), "item_id", 3)


@query("hot_items_report", _report(_top(ITEMS_SQL, "item_id", 3), "item_id", topn.ITEM_LABEL,
                                   topn.ITEM_COUNT_LABEL, topn.ITEM_RULE))
def hot_items_report(spark, folder):
    return topn.item_report(hot_items_topn(spark, folder))


@query("hot_urls_counts", URLS_SQL)
def hot_urls_counts(spark, folder):
    return counts.hot_url_counts(_requests(spark, folder), ts="event_time", unit="ms")


@query("hot_urls_topn", _top(URLS_SQL, "url", 5))
def hot_urls_topn(spark, folder):
    return topn.top_n_sliding(_requests(spark, folder), "url", 5, ts="event_time", size="1 minute", unit="ms")


@query("hot_urls_report", _report(_top(URLS_SQL, "url", 5), "url", topn.URL_LABEL,
                                  topn.URL_COUNT_LABEL, topn.URL_RULE))
def hot_urls_report(spark, folder):
    return topn.url_report(hot_urls_topn(spark, folder))


@query("avg_event_time", f"""SELECT item_id, CAST(sum((epoch_us(ts) // 1000)) // count(*) AS DOUBLE) AS average,
 CAST(sum((epoch_us(ts) // 1000)) AS DOUBLE) / count(*) AS average_exact FROM {VIEWS} GROUP BY item_id""")
def avg_event_time(spark, folder):
    return counts.average_event_time(_views(spark, folder))


def _market_sql(windows_sql: str) -> str:
    return f"""SELECT {_stamp(f'window_end - {HOUR}')} AS window_start, {_stamp('window_end')} AS window_end,
 channel, behavior, count FROM ({windows_sql})"""


BY_CHANNEL_SQL = _market_sql(_sliding(MARKET, HOUR, 5 * MINUTE, "channel, behavior"))
TOTAL_SQL = _market_sql(
    f"SELECT 'total' AS channel, 'total' AS behavior, * FROM ({_sliding(MARKET, HOUR, 5 * MINUTE, '')})"
)


def _market_rows(spark, folder):
    return source.market_behavior(source.table(spark, folder), installed=True)


@query("market_by_channel", BY_CHANNEL_SQL)
def market_by_channel(spark, folder):
    return counts.market_by_channel(_market_rows(spark, folder), slide="5 minutes")


@query("market_total", TOTAL_SQL)
def market_total(spark, folder):
    return counts.market_total(_market_rows(spark, folder), slide="5 minutes")


@query("market_grouping_sets", f"({BY_CHANNEL_SQL}) UNION ALL ({TOTAL_SQL})")
def market_grouping_sets(spark, folder):
    return counts.market_both(_market_rows(spark, folder), slide="5 minutes")


# --- distinct ----------------------------------------------------------------------


@query("uv_window", f"""SELECT {_tumble(MINUTE)} AS window_end, count(DISTINCT user_id) AS count
 FROM {VIEWS} GROUP BY ALL""")
def uv_window(spark, folder):
    return distinct.distinct_per_window(_views(spark, folder), "user_id")


@query("distinct_items_window", f"""SELECT {_tumble(MINUTE)} AS window_end, count(DISTINCT item_id) AS count
 FROM {VIEWS} GROUP BY ALL""")
def distinct_items_window(spark, folder):
    return distinct.distinct_per_window(_views(spark, folder), "item_id")


POSITION = "((user_id & 536870911) * 2654435761) & 536870911"


@query("uv_bitmap", f"""SELECT {_tumble(HOUR)} AS window_end, count(DISTINCT {POSITION}) AS count
 FROM {VIEWS} GROUP BY ALL""")
def uv_bitmap(spark, folder):
    return distinct.count_bitmaps(
        distinct.bitmaps(_views(spark, folder), "user_id", position=id_position)
    )


@query("uv_bitmap_daily", f"""SELECT {_tumble(24 * HOUR)} AS window_end, count(DISTINCT {POSITION}) AS count
 FROM {VIEWS} GROUP BY ALL""")
def uv_bitmap_daily(spark, folder):
    hourly = distinct.bitmaps(_views(spark, folder), "user_id", position=id_position)
    return distinct.count_bitmaps(distinct.merge_bitmaps(hourly, "1 day"))


DAILY_SQL = f"""SELECT {_tumble(24 * HOUR)} AS window_end, count(DISTINCT user_id) AS exact, true AS close
 FROM {VIEWS} GROUP BY ALL"""


def _against_exact(spark, folder, estimate, error):
    """The exact daily counts, and whether the estimates lie within five standard errors of them."""
    exact = distinct.distinct_per_window(_views(spark, folder), "user_id", size="1 day").withColumnRenamed("count", "exact")
    near = F.abs(F.col("count") - F.col("exact")) <= F.greatest(F.lit(1.0), F.col("exact") * (5 * error))
    return exact.join(estimate, "window_end", "left").select("window_end", "exact", F.coalesce(near, F.lit(False)).alias("close"))


@query("uv_hll", DAILY_SQL)
def uv_hll(spark, folder):
    """Daily estimates from hourly sketches of 2^12 registers, held against the exact counts."""
    hourly = distinct.sketches(_views(spark, folder), "user_id")
    return _against_exact(spark, folder, distinct.estimate_sketches(distinct.merge_sketches(hourly, "1 day")), 1.04 / 2 ** 6)


@query("uv_approx", DAILY_SQL)
def uv_approx(spark, folder):
    """One-pass daily estimates, held against the exact counts."""
    return _against_exact(spark, folder, distinct.approx_distinct_per_window(_views(spark, folder), "user_id", size="1 day"), 0.02)


@query("uv_running", f"""SELECT window_end, event_id, user_id, CAST(sum(CASE WHEN nth = 1 THEN 1 ELSE 0 END) OVER (
 PARTITION BY window_end ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS count FROM (
 SELECT *, row_number() OVER (PARTITION BY window_end, user_id ORDER BY ts, event_id) AS nth FROM (
 SELECT *, {_tumble(HOUR)} AS window_end FROM {VIEWS}))""")
def uv_running(spark, folder):
    return distinct.running_distinct(_views(spark, folder), "user_id")


@query("uv_running_by_minute", f"""SELECT DISTINCT window_end, ((epoch_us(ts) // 1000) // {MINUTE} + 1) * {MINUTE} AS grain_end,
 CAST(sum(CASE WHEN nth = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY window_end ORDER BY (epoch_us(ts) // 1000) // {MINUTE})
 AS BIGINT) AS count FROM (
 SELECT *, row_number() OVER (PARTITION BY window_end, user_id ORDER BY ts, event_id) AS nth FROM (
 SELECT *, {_tumble(HOUR)} AS window_end FROM {VIEWS}))""")
def uv_running_by_minute(spark, folder):
    return distinct.running_distinct(_views(spark, folder), "user_id", grain="1 minute")


@query("sliding_uv_5s", f"""SELECT ((epoch_us(ts) // 1000) // 5000 + 1 + i) * 5000 AS window_end,
 count(DISTINCT user_id) AS count FROM {VIEWS} e, generate_series(0, {HOUR // 5000 - 1}) g(i) GROUP BY ALL""")
def sliding_uv_5s(spark, folder):
    """Distinct users of every hour, sliding by five seconds, by merged sketches (exact as long as they are small)."""
    return merging.sliding_distinct(_views(spark, folder), "user_id")


@query("sliding_largest_5s", f"""SELECT item_id, ((epoch_us(ts) // 1000) // 5000 + 1 + i) * 5000 AS window_end,
 max(user_id) AS largest FROM {VIEWS} e, generate_series(0, {HOUR // 5000 - 1}) g(i) GROUP BY ALL""")
def sliding_largest_5s(spark, folder):
    """An aggregate that cannot be subtracted: the largest user of every item in every hour, sliding by five seconds."""
    return merging.sliding_largest(_views(spark, folder), "user_id", keys=["item_id"])


# --- patterns ----------------------------------------------------------------------

H6, H12 = 6 * HOUR * 1000, 12 * HOUR * 1000


@query("login_fail_cep", f"""SELECT user_id, start_id, event_id, ip, event_type FROM (
 SELECT user_id, id AS start_id, us, kind, lead(id) OVER w AS event_id, lead(ip) OVER w AS ip,
 lead(kind) OVER w AS event_type, first_value(CASE WHEN kind = 'fail' THEN us END IGNORE NULLS) OVER (
 PARTITION BY user_id ORDER BY us, id ROWS BETWEEN 2 FOLLOWING AND UNBOUNDED FOLLOWING) AS last_us
 FROM {LOGINS} WINDOW w AS (PARTITION BY user_id ORDER BY us, id))
 WHERE kind = 'fail' AND event_type = 'fail' AND last_us < us + {H12}""")
def login_fail_cep(spark, folder):
    return patterns.fail_sequences(source.login_events(source.table(spark, folder)), within="12 hours")


@query("login_fail_consecutive", f"""SELECT user_id, id AS start_id, event_id, ip, 'fail' AS event_type FROM (
 SELECT * EXCLUDE (ip), lead(id) OVER w AS event_id, lead(ip) OVER w AS ip, lead(kind) OVER w AS k2, lead(kind, 2) OVER w AS k3,
 lead(us, 2) OVER w AS last_us FROM (SELECT user_id, id, us, kind, ip FROM {LOGINS}) WINDOW w AS (PARTITION BY user_id ORDER BY us, id))
 WHERE kind = 'fail' AND k2 = 'fail' AND k3 = 'fail' AND last_us < us + {H12}""")
def login_fail_consecutive(spark, folder):
    """Three failed logins with nothing in between."""
    return patterns.fail_sequences(source.login_events(source.table(spark, folder)), within="12 hours", consecutive=True)


@query("login_fail_pair", f"""SELECT user_id, id AS first_id, ip AS first_ip, second_id, second_ip FROM (
 SELECT *, lead(id) OVER w AS second_id, lead(ip) OVER w AS second_ip, lead(kind) OVER w AS next_kind,
 lead(us) OVER w AS next_us FROM {LOGINS} WINDOW w AS (PARTITION BY user_id ORDER BY us, id))
 WHERE kind = 'fail' AND next_kind = 'fail' AND next_us < us + {H12}""")
def login_fail_pair(spark, folder):
    return patterns.fail_pairs(source.login_events(source.table(spark, folder)), within="12 hours")


# a fail's burst: how many cuts (fail time + 6 h) lie before it
@query("login_fail_burst", f"""SELECT user_id, event_id, ip, 'fail' AS event_type, size FROM (
 SELECT user_id, arg_min(id, (us, id)) AS event_id, arg_min(ip, (us, id)) AS ip, count(*) AS size FROM (
 SELECT *, count(*) OVER (PARTITION BY user_id ORDER BY us
 RANGE BETWEEN UNBOUNDED PRECEDING AND {H6 + 1} PRECEDING) AS cuts
 FROM {LOGINS} WHERE kind = 'fail') GROUP BY user_id, cuts) WHERE size > 1""")
def login_fail_burst(spark, folder):
    logins = source.login_events(source.table(spark, folder), failed=True)
    return patterns.fail_bursts(logins, within="6 hours").drop("event_time")


@query("login_fail_burst_list", f"""SELECT user_id, burst_id, size, event_id, ip, 'fail' AS event_type FROM (
 SELECT user_id, id AS event_id, ip, kind, min(us) OVER near AS burst_id,
 CAST(sum(CASE WHEN kind = 'fail' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, cuts) AS BIGINT) AS size FROM (
 SELECT *, count(*) OVER (PARTITION BY user_id ORDER BY us
 RANGE BETWEEN UNBOUNDED PRECEDING AND {H6 + 1} PRECEDING) AS cuts FROM {LOGINS})
 WINDOW near AS (PARTITION BY user_id ORDER BY us RANGE BETWEEN {H6} PRECEDING AND CURRENT ROW))
 WHERE kind = 'fail' AND size > 1""")
def login_fail_burst_list(spark, folder):
    return patterns.fail_burst_members(
        source.login_events(source.table(spark, folder)), within="6 hours"
    ).drop("event_time")


ORDER_SQL = f"""SELECT order_id, id AS create_id,
 CASE WHEN pay_us < us + {H6} THEN 'success' ELSE 'timeout' END AS event_type FROM (
 SELECT *, first_value(CASE WHEN kind = 'pay' THEN us END IGNORE NULLS) OVER (PARTITION BY order_id
 ORDER BY us, id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS pay_us FROM {ORDERS})
 WHERE kind = 'create'"""


@query("order_timeout", ORDER_SQL)
def order_timeout(spark, folder):
    return patterns.order_results(source.order_events(source.table(spark, folder)), within="6 hours")


@query("order_timeout_strict", f"""SELECT order_id, id AS create_id,
 CASE WHEN next_us < us + {H6} THEN 'success' ELSE 'timeout' END AS event_type FROM (
 SELECT *, lead(us) OVER w AS next_us, lead(kind) OVER w AS next_kind FROM {ORDERS}
 WINDOW w AS (PARTITION BY order_id ORDER BY us, id))
 WHERE kind = 'create' AND (next_kind = 'pay' OR next_us IS NULL OR next_us >= us + {H6})""")
def order_timeout_strict(spark, folder):
    return patterns.order_results(
        source.order_events(source.table(spark, folder)), within="6 hours", strict=True
    )


@query("order_timeout_split", f"SELECT * FROM ({ORDER_SQL}) WHERE event_type = 'timeout'")
def order_timeout_split(spark, folder):
    """The side output alone."""
    return patterns.split_results(order_timeout(spark, folder))[1]


# --- lateness ----------------------------------------------------------------------

# arrival: each event is held up by 0 to 40 places in the id order
AUDIT = dict(size="1 hour", slide="5 minutes", delay="10 minutes", lateness="60 minutes")
ARRIVALS_SQL = """(SELECT event_id, epoch_us(ts) AS us, event_id + (event_id * 37) % 41 AS arrival FROM events)"""
S5 = 5 * MINUTE * 1000
LATE_SQL = f"""SELECT event_id, arrival, windows, fired, closed, CASE WHEN fired = 0 THEN 'on_time'
 WHEN closed < windows THEN 'late_accepted' ELSE 'dropped' END AS status FROM (
 SELECT event_id, arrival, CAST(12 AS BIGINT) AS windows,
 (SELECT count(*) FROM generate_series(1, 12) g(i) WHERE us // {S5} * {S5} + i * {S5} <= mark + 1000) AS fired,
 (SELECT count(*) FROM generate_series(1, 12) g(i)
  WHERE us // {S5} * {S5} + i * {S5} <= mark + 1000 - {HOUR * 1000}) AS closed FROM (
 SELECT *, max(us) OVER (ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
 - {10 * MINUTE * 1000} AS mark FROM {ARRIVALS_SQL}))"""


def _late(spark, folder):
    events = source.table(spark, folder)
    arrival = F.col("event_id") + F.pmod(F.col("event_id") * 37, F.lit(41))
    rows = events.select("event_id", "ts", arrival.alias("arrival"))
    return lateness.late_records(rows, "arrival", **AUDIT)


@query("late_records", LATE_SQL)
def late_records(spark, folder):
    return _late(spark, folder).drop("ts")


@query("late_record_audit", f"SELECT status, count(*) AS records FROM ({LATE_SQL}) GROUP BY status")
def late_record_audit(spark, folder):
    return lateness.late_audit(_late(spark, folder))


# --- column jobs -------------------------------------------------------------------


@query("time_keys", """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time_text,
 strftime(ts, '%d/%m/%Y') AS date_text, strftime(ts - INTERVAL 1 DAY, '%d/%m/%Y') AS day_before,
 strftime(ts, '%Y%m%d') AS date_key, strftime(ts, '%Y-%m-%d_%H') AS hour_key,
 strftime(ts, '%Y%m%d%H%M') AS minute_key,
 date_trunc('second', ts) < TIMESTAMP '2024-01-15 12:00:00' AS is_before,
 date_trunc('second', ts) > TIMESTAMP '2024-01-15 12:00:00' AS is_after,
 CAST(epoch(date_trunc('second', ts)) - epoch(TIMESTAMP '2024-01-15 12:00:00') AS INTEGER) AS seconds_to
 FROM events""")
def time_keys(spark, folder):
    rows = source.table(spark, folder).select("event_id", "ts")
    return enrich.time_keys(rows, "ts", "2024-01-15 12:00:00").drop("ts")


@query("kv_fields", f"""SELECT event_id,
 'type=' || event_type || '|k=' || CAST({K} AS VARCHAR) || '|note=' AS attrs, event_type AS type,
 CAST({K} AS VARCHAR) AS k, CAST(NULL AS VARCHAR) AS note,
 'type=' || event_type || '|k=0|note=' AS attrs_updated FROM events""")
def kv_fields(spark, folder):
    rows = source.table(spark, folder).withColumn("k", source.number()).select(
        "event_id",
        F.concat(F.lit("type="), "event_type", F.lit("|k="), F.col("k").cast("string"),
                 F.lit("|note=")).alias("attrs"),
    )
    return enrich.kv_fields(rows, "attrs", r"\|", ["type", "k", "note"], {"k": "0"})


TEXT_CASES = """(SELECT event_id, user_id, CASE event_id % 6 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN ',' || event_type
 WHEN 3 THEN event_type || ',' WHEN 4 THEN ',' || event_type || ',' ELSE event_type END AS word FROM events)"""


@query("text_helpers", f"""SELECT event_id, word IS NULL OR word = '' AS empty, NOT (word IS NULL OR word = '') AS filled,
 regexp_replace(regexp_replace(word, '^,', ''), ',$', '') AS trimmed,
 CASE WHEN length(CAST(user_id AS VARCHAR)) = 2 THEN CAST(user_id AS VARCHAR)
 ELSE '0' || CAST(user_id AS VARCHAR) END AS padded FROM {TEXT_CASES}""")
def text_helpers(spark, folder):
    """On missing and empty words, and on words with a comma at either end or both."""
    from .functions import text

    kind, case, user = F.col("event_type"), F.col("event_id") % 6, F.col("user_id").cast("string")
    comma = F.lit(",")
    word = (F.when(case == 1, F.lit("")).when(case == 2, F.concat(comma, kind)).when(case == 3, F.concat(kind, comma))
            .when(case == 4, F.concat(comma, kind, comma)).when(case == 5, kind))
    return source.table(spark, folder).select(
        "event_id", text.is_empty(word).alias("empty"), text.is_not_empty(word).alias("filled"),
        text.trim_comma(word).alias("trimmed"), text.pad_two(user).alias("padded"),
    )


@query("date_texts", """SELECT event_id, strftime(ts, '%d/%m/%Y') AS today, strftime(ts, '%Y-%m-%d') AS day FROM events""")
def date_texts(spark, folder):
    """The day of each event as text, and read back from its date key."""
    from .functions import calendar

    return source.table(spark, folder).select(
        "event_id", calendar.today_text(F.col("ts")).alias("today"),
        calendar.parse_date_key(calendar.date_key(F.col("ts"))).cast("string").alias("day"))


def _some_broken(spark, folder):
    """Behaviour lines of which two in five are malformed: a user that is no number, or a field too few."""
    rest = F.array_join(F.slice(F.split("value", ","), 2, 4), ",")
    case = F.col("event_id") % 5
    lines = source.behavior_lines(source.table(spark, folder), keep=["event_id"])
    return lines.select(F.when(case == 0, F.concat(F.lit("x,"), rest)).when(case == 1, rest).otherwise(F.col("value")).alias("value"))


LINE = f"""CAST({K} AS VARCHAR) || ',' || CAST({K} % 20 AS VARCHAR) || ',' || CASE event_type WHEN 'view' THEN 'pv'
 WHEN 'purchase' THEN 'buy' WHEN 'click' THEN 'cart' WHEN 'signup' THEN 'fav' ELSE event_type END || ',' ||
 CAST(epoch_us(ts) // 1000 AS VARCHAR)"""


@query("quarantine_good", SQL["parse_behavior_csv"] + " WHERE event_id % 5 NOT IN (0, 1)")
def quarantine_good(spark, folder):
    return parse.split_bad(parse.behavior_rows(_some_broken(spark, folder), quarantine=True))[0]


@query("quarantine_bad", f"""SELECT CASE event_id % 5 WHEN 0 THEN 'x,' ELSE '' END || {LINE} AS raw
 FROM events WHERE event_id % 5 IN (0, 1)""")
def quarantine_bad(spark, folder):
    return parse.split_bad(parse.behavior_rows(_some_broken(spark, folder), quarantine=True))[1]


@query("csv_file_source", SQL["parse_behavior_csv"])
def csv_file_source(spark, folder):
    """Behaviour rows landed as CSV files and read back as a CSV file source."""
    from .session import scratch_dir
    from .sources.readers import read_behavior_csv

    path = scratch_dir(spark, "behavior-csv")
    parse.behavior_rows(source.behavior_lines(source.table(spark, folder))).write.csv(path)
    return read_behavior_csv(spark, path)
