from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pulsemark.functions import calendar, event_time, text
from pulsemark.operators import enrich, parse
from pulsemark.session import session_conf
from pulsemark.sources import events, readers


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def one(frame, column):
    return frame.select(column.alias("x")).first().x


def test_behavior_lines(spark):
    row = parse.behavior_rows(lines(spark, " 1 ,2, 3,pv , 4")).first()
    assert tuple(row) == (1, 2, 3, "pv", 4)
    assert [f.dataType.simpleString() for f in parse.behavior_rows(lines(spark)).schema] == [
        "bigint", "bigint", "int", "string", "bigint"]


@pytest.mark.parametrize("bad", ["1,2,x,pv,3", "1,2,3,pv"])
def test_malformed_behavior_line(spark, bad):
    with pytest.raises(Exception):
        parse.behavior_rows(lines(spark, bad)).collect()
    good, rejected = parse.split_bad(parse.behavior_rows(lines(spark, bad, "1,2,3,pv,4"), quarantine=True))
    assert [tuple(r) for r in good.collect()] == [(1, 2, 3, "pv", 4)]
    assert [r.raw for r in rejected.collect()] == [bad]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_access_lines(spark, zone):
    line = "192.168.1.2 - - 27/04/2020:7:05:09 +0000 GET /www/a"
    padded = "192.168.1.2 - - 08/03/2020:02:30:00 +0000 POST /www/a"
    with session_conf(spark, {"spark.sql.session.timeZone": zone}):
        rows = parse.access_rows(lines(spark, line, padded)).collect()
        assert tuple(rows[0]) == ("192.168.1.2", "-", 1587971109000, "GET", "/www/a")
        assert rows[1].event_time == 1583634600000
        flagged = parse.access_rows(lines(spark, line, "garbage", line.replace("7:05", "7:65")), quarantine=True)
        assert [r.is_bad for r in flagged.collect()] == [False, True, True]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_event_time_does_not_depend_on_the_zone(spark, zone):
    with session_conf(spark, {"spark.sql.session.timeZone": zone}):
        # 02:30 on this day does not exist in New York
        frame = spark.sql("SELECT timestamp_ntz'2024-03-10 02:30:00.123456' AS ts, 5 AS s, 1500 AS ms")
        assert one(frame, event_time.epoch_us(frame, "ts")) == 1710037800123456
        assert one(frame, event_time.epoch_us(frame, "s", "s")) == 5_000_000
        assert one(frame, event_time.epoch_us(frame, "ms", "ms")) == 1_500_000
        with pytest.raises(ValueError):
            event_time.epoch_us(frame, "ms")
        shown = event_time.timestamp_text(F.lit(1710037800000000))
        assert one(frame, shown) == "2024-03-10 02:30:00.0"


def test_calendar_functions(spark):
    frame = spark.sql("SELECT '2018-10-31 21:27:53' AS a, '2018-10-31 21:28:00' AS b, "
                      "timestamp_ntz'2018-11-01 09:05:03' AS ts, '20181101' AS k")
    a, b, ts = F.col("a"), F.col("b"), F.col("ts")
    expected = [
        (calendar.before(a, b), True), (calendar.before(a, a), False), (calendar.after(a, b), False),
        (calendar.after(b, a), True), (calendar.seconds_between(a, b), -7),
        (calendar.date_hour(a), "2018-10-31_21"), (calendar.today_text(ts), "01/11/2018"),
        (calendar.yesterday_text(ts), "31/10/2018"), (calendar.format_date(ts), "01/11/2018"),
        (calendar.format_time(ts), "2018-11-01 09:05:03"),
        (calendar.parse_time(a), dt.datetime(2018, 10, 31, 21, 27, 53)),
        (calendar.date_key(ts), "20181101"), (calendar.parse_date_key(F.col("k")), dt.date(2018, 11, 1)),
        (calendar.minute_key(ts), "201811010905"),
    ]
    got = frame.select(*[column.alias(f"c{i}") for i, (column, _) in enumerate(expected)]).first()
    assert list(got) == [value for _, value in expected]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_time_keys_do_not_move_out_of_a_daylight_saving_gap(spark, zone):
    with session_conf(spark, {"spark.sql.session.timeZone": zone}):
        frame = spark.sql("SELECT timestamp_ntz'2024-03-10 02:30:00' AS ts")
        row = enrich.time_keys(frame, "ts", "2024-03-10 01:30:00").drop("ts").collect()[0]
    assert row.asDict() == {
        "time_text": "2024-03-10 02:30:00", "date_text": "10/03/2024", "day_before": "09/03/2024", "date_key": "20240310",
        "hour_key": "2024-03-10_02", "minute_key": "202403100230", "is_before": False, "is_after": True, "seconds_to": 3600}


@pytest.mark.parametrize("props, value", [('{"a":{"k":1},"k":2}', 2), ('{"k": "7"}', 7), ('{"x": 1}', None), ('{"k": -3}', -3)])
def test_number_reads_json(spark, props, value):
    assert one(spark.createDataFrame([(props,)], "props string"), events.number()) == value


def test_number_that_is_none_fails(spark):
    with pytest.raises(Exception):
        one(spark.createDataFrame([('{"k": 1.5}',)], "props string"), events.number())


def test_other_event_types_keep_their_name_and_missing_values_their_field(spark):
    frame = spark.sql("SELECT 1L AS event_id, timestamp_ntz'2024-01-01 00:00:01' AS ts, 5L AS user_id, 'error' AS event_type, "
                      "'{}' AS props")
    assert events.behavior_lines(frame).first().value == "5,,,error,1704067201000"


def test_text_functions(spark):
    frame = spark.sql("SELECT ',a,' AS both, 'a' AS none, '' AS empty, CAST(NULL AS string) AS missing, '7' AS one, '123' AS long")
    expected = [
        (text.trim_comma(F.col("both")), "a"), (text.trim_comma(F.col("none")), "a"),
        (text.is_empty(F.col("empty")), True), (text.is_empty(F.col("missing")), True),
        (text.is_not_empty(F.col("none")), True), (text.is_not_empty(F.col("missing")), False),
        (text.pad_two(F.col("one")), "07"), (text.pad_two(F.col("long")), "0123"), (text.pad_two(F.lit("12")), "12"),
    ]
    got = frame.select(*[column.alias(f"c{i}") for i, (column, _) in enumerate(expected)]).first()
    assert list(got) == [value for _, value in expected]


@pytest.mark.parametrize("value, field, found", [
    ("a=1|b=2|c=", "b", "2"), ("a=1|b=2|c=", "c", None), ("a=1|b=2", "z", None), ("ab=1|b=2", "b", "2"),
    ("b=1=2|b=3", "b", "3"), ("b=2=|a=1", "b", "2"), ("b", "b", None), ("b=1|b=2", "b", "1"), ("", "b", None),
    ("a.c=5|abc=6", "a.c", "5"),
])
def test_get_field(spark, value, field, found):
    assert one(lines(spark, value), text.get_field(F.col("value"), r"\|", field)) == found


@pytest.mark.parametrize("value, new, expected", [
    ("a=1|b=2|c=", "9", "a=1|b=9|c="), ("b=1|b=2", "9", "b=9|b=9"), ("a=1", "9", "a=1"), ("b", "9", "b=9"),
    ("bb=1|b=", "9", "bb=1|b=9"), ("a=1|b=2", r"$1\x", r"a=1|b=$1\x"), ("b=1=2|a=b", "", "b=|a=b"),
])
def test_set_field(spark, value, new, expected):
    assert one(lines(spark, value), text.set_field(F.col("value"), r"\|", "b", new)) == expected


def test_kv_fields_without_updates(spark):
    row = enrich.kv_fields(lines(spark, "a=1;b=2"), "value", ";", ["a", "b"]).first()
    assert (row.a, row.b) == ("1", "2")


def test_kafka_options():
    assert readers.kafka_options("h:9092", "hot-items", "latest", "g", maxOffsetsPerTrigger="10") == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "hot-items", "startingOffsets": "latest",
        "kafka.group.id": "g", "maxOffsetsPerTrigger": "10"}
    with pytest.raises(ValueError):
        readers.kafka_options("h:9092", "t", "middle")


def test_behavior_csv_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1, 2,3,pv ,4\n5,6,7,buy,8\n")
    got = readers.read_behavior_csv(spark, str(tmp_path)).collect()
    assert sorted(tuple(r) for r in got) == [(1, 2, 3, "pv", 4), (5, 6, 7, "buy", 8)]
    (tmp_path / "b.csv").write_text("1,2,x,pv,3\n")
    with pytest.raises(Exception):
        readers.read_behavior_csv(spark, str(tmp_path)).collect()
