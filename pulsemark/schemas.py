"""Record layouts of the streams."""

from __future__ import annotations

from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType


def _layout(**fields) -> StructType:
    return StructType([StructField(name, kind(), True) for name, kind in fields.items()])


# inputs
USER_BEHAVIOR = _layout(user_id=LongType, item_id=LongType, category_id=IntegerType,
                        behavior=StringType, timestamp=LongType)
