"""All pairs of rows that share a key, in blocks of bounded size.

A key with many rows is cut into blocks by a hash of the row; every pair of blocks is one group of at most about twice
the block size, wherever the key's other rows are. What a group yields is up to the caller, who sees whole groups and
need not write out pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 1024


def _runs(keys: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)]])


def groups(batches: Iterator[pa.RecordBatch], key: str = "_group") -> Iterator[pa.Table]:
    """Whole runs of equal int64 ``key`` of sorted rows, several runs to a table; only an unfinished run is held."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy()
        cut = int(np.searchsorted(keys, keys[-1]))
        if held and (cut or held[-1].column(key)[-1].as_py() != keys[-1]):
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        elif cut:
            yield pa.Table.from_batches([batch.slice(0, cut)])
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def block_pairs(rows: DataFrame, keys: list[str], node: str, compare: Callable[[pa.Table, np.ndarray], pa.RecordBatch | None],
                schema: str, block: int = BLOCK) -> DataFrame:
    """``compare(rows of one group, side)`` for every two blocks of each value of ``keys`` with two rows or more.

    ``side`` is None for a block against itself; else it tells the rows of one block (True) from the other's.
    """
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1")
    cut = F.ceil(F.col("_n") / block)
    dealt = (
        rows.join(sizes, keys).withColumn("_cut", cut).withColumn("_own", F.pmod(F.xxhash64(node, F.lit(11)), F.col("_cut")))
        .withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_cut") - 1)))
        .withColumn("_lo", F.least("_own", "_other")).withColumn("_hi", F.greatest("_own", "_other"))
        .withColumn("_group", F.xxhash64(*keys, "_lo", "_hi")).withColumn("_low", F.col("_own") == F.col("_lo"))
        .drop("_n", "_cut", "_own", "_other")
    )
    dealt = dealt.repartition("_group").sortWithinPartitions("_group")

    def run(batches):
        for table in groups(batches):
            table = table.combine_chunks()
            edges = _runs(table.column("_group").to_numpy())
            for at, to in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if to - at < 2:
                    continue
                part = table.slice(at, to - at)
                within = part.column("_lo")[0].as_py() == part.column("_hi")[0].as_py()
                side = None if within else part.column("_low").to_numpy(zero_copy_only=False)
                made = compare(part, side)
                if made is not None and made.num_rows:
                    yield made

    return dealt.mapInArrow(run, schema)
