"""Running aggregates over a long ordered group, without one task per group.

A plain ``Window.partitionBy(key).orderBy(...)`` sends a whole key to one task.
Here the ordered group is cut into chunks. Each chunk's total is small; the
totals before a chunk are summed up and put in front of it as one extra row, the
carry. The window then runs per chunk, so a hot key spreads over as many tasks
as it has chunks. The plan reads the rows twice, for the totals and for the
window, and shuffles the totals twice and the rows once; nothing is joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_COMBINE = {"sum": F.sum, "max": F.max}


def running(rows: DataFrame, keys: Sequence[str], chunk: Column, order: Sequence[str],
            value: str, how: str, out: str, exclusive: bool = False) -> DataFrame:
    """Add ``out``: the running ``sum`` or ``max`` of ``value`` per ``keys``.

    ``chunk`` must not decrease along ``order``. With ``exclusive`` a row sees
    only the rows before it (null for the first).
    """
    combine = _COMBINE[how]
    rows = rows.withColumn("_chunk", chunk)
    chunks = rows.groupBy(*keys, "_chunk").agg(combine(value).alias("_total"))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = chunks.select(
        *keys, "_chunk", combine("_total").over(before).alias(value), F.lit(0).alias("_is_row")
    ).where(F.col(value).isNotNull())

    upto = (
        Window.partitionBy(*keys, "_chunk").orderBy("_is_row", *order)
        .rowsBetween(Window.unboundedPreceding, -1 if exclusive else Window.currentRow)
    )
    return (
        rows.withColumn("_is_row", F.lit(1))
        .unionByName(carry, allowMissingColumns=True)
        .withColumn(out, combine(value).over(upto))
        .where("_is_row = 1")
        .drop("_chunk", "_is_row")
    )
