"""Bit positions for distinct-count bitmaps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bits in the map, and the odd multiplier that spreads integer ids over it.
BITMAP_BITS = 1 << 29
MULTIPLIER = 2654435761


def id_position(user_id: Column, bits: int = BITMAP_BITS) -> Column:
    """Position of an integer id. The low bits are masked first: the product's
    low bits are the same and it cannot overflow."""
    mask = F.lit(bits - 1).cast("bigint")
    return (user_id.bitwiseAND(mask) * F.lit(MULTIPLIER).cast("bigint")).bitwiseAND(mask)


def hash_position(value: Column, bits: int = BITMAP_BITS) -> Column:
    """Position of a value of any type."""
    return F.xxhash64(value).bitwiseAND(F.lit(bits - 1).cast("bigint"))
