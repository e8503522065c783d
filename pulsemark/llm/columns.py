"""Small helpers the operators share: fold numbers, operator columns that clash with nothing, stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_dir


def fold(id_column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def lowest_hashes(df: DataFrame, order: str, limit: int, rows: int, *ties: str) -> DataFrame:
    """At most ``limit`` of about ``rows`` rows, those of the smallest 64-bit hash ``order``.

    Rows whose hash is too large to be among them are left out first, so three times the limit meet in the last task,
    not the limit of each task.
    """
    return df.where(F.col(order) <= _bound(limit, rows)).orderBy(order, *ties).limit(limit)


def _bound(limit: int, rows: int) -> int:
    return min(-(1 << 63) + (1 << 64) * 3 * (limit + 30) // max(rows, 1), (1 << 63) - 1)


def lowest_hashes_by(df: DataFrame, group: str, order: str, limit: int, rows: dict[str, int], *ties: str) -> DataFrame:
    """``lowest_hashes`` of every value of ``group``, whose numbers of rows are given, in one pass for all."""
    bounds = df.sparkSession.createDataFrame([(g, _bound(limit, n)) for g, n in rows.items()], f"{group} string, _bound bigint")
    some = df.join(F.broadcast(bounds), group).where(F.col(order) <= F.col("_bound"))
    nth = F.row_number().over(Window.partitionBy(group).orderBy(order, *ties))
    return some.withColumn("_nth", nth).where(F.col("_nth") <= limit).select(df.columns)


def labelled(docs: DataFrame, labels: DataFrame, key: str, label: str) -> DataFrame:
    """(_key, _label) of the ids in ``docs`` that ``labels`` knows to be 0 or 1; the larger label of an id that has both."""
    known = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(
        F.max(F.col(label).cast("int")).alias("_label"))
    return known.join(docs.select(F.col(key).alias("_key")).distinct(), "_key", "left_semi")


def sampled(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, per_label: int) -> DataFrame:
    """(_key, _label, text): a text for each of the ``per_label`` ids of every label with the smallest hashes.

    Ids are taken from ``docs``, so a label of a text that is not there counts for nothing and takes no place. An id of
    several texts gives that with the smallest hash.
    """
    known = labelled(docs, labels, key, label)
    order = [F.xxhash64("_key"), F.col("_key")]
    some = [known.where(F.col("_label") == v).orderBy(*order).limit(per_label) for v in (0, 1)]
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("text")).join(F.broadcast(some[0].unionByName(some[1])), "_key")
    return rows.groupBy("_key", "_label").agg(F.min_by(F.struct("text"), F.xxhash64("text"))["text"].alias("text"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: lineage ends here, and a lost executor loses nothing."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
