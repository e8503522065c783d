"""Every registered query against its SQL, and the shape of every batch plan."""

from __future__ import annotations

import contextlib
import io
import os
import shutil
import subprocess
import sys

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import oracle
import pulsemark.stream_catalog  # noqa: F401  (registers the streaming queries)
from __spark_entry__ import entry, oracle_sql, queries
from pulsemark.catalog import QUERIES, SQL

SMALL = "/root/testdata/sf0.001"
BATCH = [name for name in QUERIES if not name.startswith(("stream_", "sink_", "land_", "csv_"))]
# totals of the whole table are ordered in one task: one row per 2^20 arrivals
ONE_TASK = {"late_records", "late_record_audit"}


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SMALL)


def plan_of(frame) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        frame.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("name", ["land_raw_stream", "parse_behavior_csv"])
def test_events_without_a_time_are_landed(spark, tmp_path, name):
    events = spark.read.parquet(f"{SMALL}/events.parquet").limit(500).toPandas()
    events.loc[events["event_id"] % 10 == 0, "ts"] = None
    kinds = pa.schema([("event_id", pa.int64()), ("ts", pa.timestamp("us")), ("user_id", pa.int64()), ("event_type", pa.string()),
                       ("value", pa.float64()), ("props", pa.string())])
    pq.write_table(pa.Table.from_pandas(events, schema=kinds, preserve_index=False), tmp_path / "events.parquet")
    got = queries()[name](spark, str(tmp_path)).toPandas()
    assert len(got) == 500 and got["timestamp"].isna().sum() == 50
    assert oracle.difference(got, oracle.connect(str(tmp_path)).execute(SQL[name]).df()) is None


def test_every_sql_has_a_query():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(queries()) and set(SQL) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_sql(spark, con, name):
    got = queries()[name](spark, SMALL).toPandas()
    assert len(got) > 0
    if name in oracle_sql():
        assert oracle.difference(got, con.execute(oracle_sql()[name]).df()) is None


@pytest.mark.parametrize("name", BATCH)
def test_plan_has_no_slow_step(spark, name):
    plan = plan_of(queries()[name](spark, SMALL))
    for step in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups"):
        assert step not in plan, step
    if name not in ONE_TASK:
        assert "SinglePartition" not in plan
    # a sliding window must not multiply rows before they are counted
    assert "Expand" not in plan


@pytest.mark.parametrize("name", ["hot_items_counts", "hot_items_topn", "uv_running", "uv_bitmap", "pv_hourly"])
def test_filter_and_columns_reach_the_scan(spark, name):
    plan = plan_of(queries()[name](spark, SMALL))
    assert "EqualTo(event_type,view)" in plan
    assert "value" not in plan.split("ReadSchema", 1)[1].split("\n", 1)[0]


def test_top_n_prunes_before_the_shuffle(spark):
    plan = plan_of(queries()["hot_items_topn"](spark, SMALL))
    assert plan.count("WindowGroupLimit") >= 2


@pytest.mark.parametrize("name", ["login_fail_cep", "login_fail_pair", "order_timeout"])
def test_patterns_shuffle_and_sort_once(spark, name):
    plan = plan_of(queries()[name](spark, SMALL))
    tree = plan.split("\n\n", 1)[0]
    assert tree.count("Exchange") == 1 and tree.count("Sort") == 1


def test_entry(spark):
    assert entry(spark).columns == ["window_end", "rank", "item_id", "count"]
    assert entry(spark).count() > 0


def test_the_rest_stands_without_the_training_data_operators(tmp_path):
    """A copy without both folders, with and without the pipeline beside them, still imports and lists its queries."""
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for pipeline in (True, False):
        there = tmp_path / str(pipeline)
        shutil.copytree(os.path.join(here, "pulsemark"), there / "pulsemark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
        for name in ["__spark_entry__.py", *(["corpus_pipeline.py"] if pipeline else [])]:
            shutil.copy(os.path.join(here, name), there / name)
        code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries())"
        made = subprocess.run([sys.executable, "-c", code], cwd=there, env={**os.environ, "PYTHONPATH": str(there)}, capture_output=True, text=True)
        assert made.stdout.split() == [str(len(QUERIES)), str(len(SQL)), "False"], made.stderr
