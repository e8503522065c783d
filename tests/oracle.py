"""Compare every query with its SQL, the way a reader would by hand."""

from __future__ import annotations

import glob
import os
import time

import duckdb
import pandas as pd


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    # DuckDB hands out whole numbers with nulls as Int64, Spark as float64
    frame = frame.astype({name: "float64" for name, kind in frame.dtypes.items() if str(kind) == "Int64" and frame[name].hasnans})
    return frame.sort_values(list(frame.columns), ignore_index=True)


def difference(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    """None when both hold the same rows."""
    left, right = canonical(spark_frame), canonical(sql_frame)
    if list(left.columns) != list(right.columns):
        return f"columns {list(left.columns)} / {list(right.columns)}"
    if len(left) != len(right):
        return f"rows {len(left)} / {len(right)}"
    for name in left.columns:
        if left[name].dtype != right[name].dtype:
            return f"type of {name}: {left[name].dtype} / {right[name].dtype}"
    try:
        pd.testing.assert_frame_equal(left, right, check_exact=True)
    except AssertionError as error:
        return str(error)[:200]
    return None


if __name__ == "__main__":
    import sys

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    folder, wanted = sys.argv[1], sys.argv[2:]
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", os.environ.get("ZONE", "UTC")).getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    con = connect(folder)
    for name, run in queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        started = time.time()
        try:
            got = run(spark, folder).toPandas()
            sql = oracle_sql().get(name)
            verdict = "rows only" if sql is None else difference(got, con.execute(sql).df()) or "ok"
            print(f"{name:28} {len(got):8} {time.time() - started:6.2f}s {verdict}", flush=True)
        except Exception as error:  # report and go on with the next query
            print(f"{name:28} ERROR {str(error)[:500]}", flush=True)
