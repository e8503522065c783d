"""Batch and streaming readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..schemas import USER_BEHAVIOR

OFFSETS = ("earliest", "latest")


def kafka_options(servers: str, topic: str, starting: str = "earliest",
                  group: str | None = None, **more: str) -> dict[str, str]:
    """Options of a Kafka text stream. Values are read as strings, so no
    deserializer is named."""
    if starting not in OFFSETS:
        raise ValueError(f"starting must be one of {OFFSETS}")
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    if group is not None:
        options["kafka.group.id"] = group
    return {**options, **more}


def read_kafka(spark: SparkSession, servers: str, topic: str, starting: str = "earliest",
               group: str | None = None, **more: str) -> DataFrame:
    """Topic as a stream of text lines in ``value``. Needs the Kafka connector package."""
    options = kafka_options(servers, topic, starting, group, **more)
    return spark.readStream.format("kafka").options(**options).load().selectExpr(
        "CAST(value AS STRING) AS value"
    )


def read_behavior_csv(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Behaviour rows from CSV files without a header; a malformed line fails the job."""
    reader = (spark.readStream if stream else spark.read).schema(USER_BEHAVIOR)
    return reader.options(ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True,
                          mode="FAILFAST").csv(path)


def read_lines(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Text files as lines in ``value``."""
    return (spark.readStream if stream else spark.read).text(path)


def stream_files(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int | None = None) -> DataFrame:
    """A folder of Parquet files as a stream, the oldest files first."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)
