"""Bounded look-ahead: pattern steps that end at most ``reach`` after their start.

Sorting a whole key to look a few rows ahead puts a hot key into one task. As a
match never spans more than ``reach``, a key can be cut into stretches of time,
each followed by a copy of the ``reach`` that comes after it. With a stretch of
eight times the reach, about one row in eight is copied; the answer is the same
for any stretch. Groups are sorted by the (spilling) window operator and read as
a stream, so their size is not held in memory either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.event_time import floor_to

# Length of a stretch, in multiples of the reach.
STRETCH = 8


def with_lookahead(df: DataFrame, us: Column, reach: int, stretch: int = STRETCH) -> DataFrame:
    """Put each row into its stretch ``_stretch`` and, where a row up to ``reach``
    earlier lies in the stretch before, into that one as well. ``_home`` marks
    the row itself; copies only serve to be looked at."""
    length = max(1, stretch) * reach
    home, earlier = floor_to(us, length), floor_to(us - F.lit(reach), length)
    places = F.when(home == earlier, F.array(home)).otherwise(F.array(home, earlier))
    return df.withColumn("_stretch", F.explode(places)).withColumn("_home", F.col("_stretch") == home)
