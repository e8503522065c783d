"""Sinks. Every one is safe to repeat after a failure: a batch that is run again replaces what its first run wrote."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

BatchWriter = Callable[[DataFrame, int], None]


def run_available(writer: DataStreamWriter, checkpoint: str) -> StreamingQuery:
    """Process what is there, then stop; a failure is raised."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def console(stream: DataFrame, mode: str = "append", prefix: str | None = None,
            rows: int = 20) -> DataStreamWriter:
    """Print each batch; ``prefix`` names the query."""
    writer = stream.writeStream.format("console").outputMode(mode).options(numRows=rows, truncate=False)
    return writer.queryName(prefix) if prefix else writer


def land_raw(lines: DataFrame, path: str, kind: str = "csv") -> DataStreamWriter:
    """Append raw lines (or rows) to files of ``kind``: csv, text or parquet."""
    return lines.writeStream.format(kind).outputMode("append").option("path", path)


def batch_folders(path: str, shape: Callable[[DataFrame], DataFrame] = lambda df: df) -> BatchWriter:
    """One Parquet folder per batch; ``shape`` is applied first (e.g. ranking)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        shape(batch).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn("batch_id", F.col("batch_id").cast("bigint"))


def latest(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The newest row per key of ``read_batches``: what an update-mode stream says now."""
    values = [name for name in rows.columns if name not in (*keys, "batch_id")]
    newest = F.max_by(F.struct(*values), "batch_id").alias("_newest")
    return rows.groupBy(*keys).agg(newest).select(*keys, "_newest.*")


def running_totals(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``count``: what ``value`` of ``read_batches`` sums up to per key, after each batch. A key has a row per batch at
    most, so a window over it is short."""
    upto = Window.partitionBy(*keys).orderBy("batch_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.select(*keys, "batch_id", F.sum(value).over(upto).alias("count"))


def upsert_batches(path: str, keys: Sequence[str], every: int = 16, buckets: int = 64) -> BatchWriter:
    """A latest-value table that compacts itself: each batch is a folder of changes, and every so many batches the newest
    rows per key are written as a version of the buckets of keys that have changed since; the others stay as they are. A
    version is named only once it is written, so readers and repeated batches never see half of one. ``read_upserts`` reads
    the newest version of each bucket and the changes after it."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
        batch.withColumn("_bucket", bucket).write.mode("overwrite").parquet(f"{path}/changes/batch_id={batch_id}")
        if batch_id % every == every - 1:
            versions = _versions(spark, path, batch_id)
            since = _later(read_batches(spark, f"{path}/changes").where(F.col("batch_id") <= batch_id), versions)
            touched = [r["_bucket"] for r in since.select("_bucket").distinct().collect()]  # at most ``buckets``
            if touched:
                newest = _newest(spark, path, [*keys, "_bucket"], versions, F.col("_bucket").isin(touched) & (F.col("batch_id") <= batch_id))
                newest.repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{path}/versions/version={batch_id}")
                names = spark.createDataFrame([(batch_id, b) for b in touched], "version bigint, bucket int")
                names.coalesce(1).write.mode("append").parquet(f"{path}/names")

    return write


def _versions(spark: SparkSession, path: str, before: int | None) -> dict[int, int]:
    """The newest version of every bucket that has one."""
    try:
        names = spark.read.parquet(f"{path}/names").where(F.col("version") < before if before is not None else F.lit(True))
        return {r["bucket"]: r["version"] for r in names.groupBy("bucket").agg(F.max("version").alias("version")).collect()}
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}


def _later(changes: DataFrame, versions: dict[int, int]) -> DataFrame:
    """The changes that the versions do not hold."""
    if not versions:
        return changes
    known = F.create_map(*[F.lit(x) for pair in versions.items() for x in pair])
    return changes.where(F.col("batch_id") > F.coalesce(F.try_element_at(known, F.col("_bucket")), F.lit(-1)))


def _newest(spark: SparkSession, path: str, keys: Sequence[str], versions: dict[int, int], wanted: Column) -> DataFrame:
    rows = _later(read_batches(spark, f"{path}/changes"), versions).where(wanted)
    if versions:
        base = spark.read.parquet(f"{path}/versions")
        mine = reduce(or_, [(F.col("version") == v) & (F.col("_bucket") == b) for b, v in versions.items()])
        # both are folders, so only those named are read
        rows = rows.unionByName(base.where(mine).withColumnRenamed("version", "batch_id").withColumn("batch_id", F.col("batch_id").cast("bigint")).where(wanted))
    return latest(rows, keys)


def read_upserts(spark: SparkSession, path: str, keys: Sequence[str], before: int | None = None) -> DataFrame:
    """The newest row per key of an ``upsert_batches`` table; ``before`` leaves versions of that batch and later out."""
    return _newest(spark, path, keys, _versions(spark, path, before), F.lit(True)).drop("_bucket")


def replace_statements(table: str, columns: Sequence[str], batch_id: int) -> list[str]:
    """SQL that puts a staged batch in place of what an earlier run of it wrote."""
    named = ", ".join(columns)
    return [f"DELETE FROM {table} WHERE batch_id = {int(batch_id)}",
            f"INSERT INTO {table} ({named}) SELECT {named} FROM {table}_staging"]


def jdbc_batches(url: str, table: str, properties: dict[str, str], execute: Callable[[list[str]], None],
                 shape: Callable[[DataFrame], DataFrame] = lambda df: df, connections: int = 8) -> BatchWriter:
    """Write each batch to a database table, with its ``batch_id``; a repeated batch replaces its first run.

    Executors fill ``<table>_staging``; then ``execute`` must run the statements it is given in one transaction, over a
    connection of the caller's. Needs the database's driver jar.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = shape(batch).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        rows.write.option("numPartitions", connections).jdbc(url, f"{table}_staging", "overwrite", properties)
        execute(replace_statements(table, rows.columns, batch_id))

    return write


def split_batches(outputs: dict[str, BatchWriter], column: str = "event_type") -> BatchWriter:
    """Send each value of ``column`` to its own sink, reading the batch once."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for value, sink in outputs.items():
                sink(batch.where(F.col(column) == value), batch_id)
        finally:
            batch.unpersist()

    return write
