"""Late records as data, and what running queries have dropped.

A stateful step drops late rows without a trace. A gate in front of it decides row by row, by the same rule, and writes
what it refuses beside what it lets through; steps behind it read the accepted rows and drop nothing.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..functions.event_time import micros
from .sinks import BatchWriter, read_batches

ACCEPTED, LATE, NO_TIME = "accepted", "late", "no_time"


def _seen(spark: SparkSession, path: str, before: int) -> int | None:
    """The latest time (µs) of the batches before one."""
    try:
        return read_batches(spark, f"{path}/seen").where(F.col("batch_id") < before).agg(F.max("us")).first()[0]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def gate(path: str, delay, until: Column | None = None) -> BatchWriter:
    """Writes every row of a stream with ``ts`` to one of three outputs, which ``read_gate`` gives back.

    The watermark of a batch is the latest time of the batches before it, in whole milliseconds, less ``delay``. A row is
    late if the watermark has reached ``until`` (µs; e.g. the end of its window), its own time unless given. Rows without a
    time are an output of their own. A batch that is run again replaces what it wrote, and sees the watermark it saw.
    """
    until = F.unix_micros("ts") if until is None else until

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = _seen(spark, path, batch_id)
        late = F.lit(False) if seen is None else until <= F.lit(seen // 1000 * 1000 - micros(delay))
        status = F.when(F.col("ts").isNull(), NO_TIME).when(late, LATE).otherwise(ACCEPTED)
        batch.withColumn("status", status).write.mode("overwrite").parquet(f"{path}/rows/batch_id={batch_id}")
        rows = spark.read.schema(batch.schema).parquet(f"{path}/rows/batch_id={batch_id}")
        rows.agg(F.max(F.unix_micros("ts")).alias("us")).write.mode("overwrite").parquet(f"{path}/seen/batch_id={batch_id}")

    return write


def read_gate(spark: SparkSession, path: str, status: str | None = None) -> DataFrame:
    """The rows of a gate, all with their ``status`` or those of one."""
    rows = read_batches(spark, f"{path}/rows")
    return rows if status is None else rows.where(F.col("status") == status).drop("status")


class Dropped(StreamingQueryListener):
    """Writes a row per batch of every query of the session: input rows, and rows that stateful steps dropped as late.

    Add it with ``spark.streams.addListener``. Steps count what reaches them, which is groups where rows were combined
    before; a gate counts rows.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        dropped = sum(step.numRowsDroppedByWatermark for step in progress.stateOperators)
        row = [(str(progress.id), progress.name, progress.batchId, progress.numInputRows, dropped, progress.eventTime.get("watermark"))]
        self.spark.createDataFrame(row, "query string, name string, batch bigint, input bigint, dropped bigint, watermark string").write.mode(
            "overwrite").parquet(f"{self.path}/query={progress.id}/at={progress.batchId}")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def state_rows(spark: SparkSession, checkpoint: str, operator: int = 0, batch_id: int | None = None) -> DataFrame:
    """What a stateful step holds after a batch (the last unless given): ``key``, ``value``, ``partition_id``."""
    reader = spark.read.format("statestore").option("operatorId", operator)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    return reader.load(checkpoint)
