"""Filters of bounded size, as bitmaps of Spark's own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import unused

# 64 MB.
MAX_BITS = 1 << 29
LEAST_BITS = 1 << 15


def bits_for(entries: int, per_entry: int = 32, most: int = MAX_BITS) -> int:
    bits = LEAST_BITS
    while bits < min(most, entries * per_entry):
        bits <<= 1
    return bits


def position(hashed: Column, bits: int) -> Column:
    return F.pmod(hashed, F.lit(bits)) + 1


def packed(positions: DataFrame) -> DataFrame:
    """One row per 32768 positions of `position`, with a bitmap of 4 KB, where any is set."""
    return positions.groupBy(F.bitmap_bucket_number("position").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("position")).alias("bitmap")
    )


def _is_set(at: Column, bitmap: Column) -> Column:
    bit = F.bitmap_bit_position(at)
    byte = F.conv(F.hex(F.substring(bitmap, (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(byte.bitwiseAND(F.pow(F.lit(2), bit % 8).cast("int")) != 0, F.lit(False))


def with_maybe(df: DataFrame, hashed: str, bitmaps: DataFrame, bits: int, flag: str = "maybe") -> DataFrame:
    """The rows with `flag`: whether the filter has the position of the row's hash.

    `bitmaps` is broadcast: it has `bits` / 32768 rows of 4 KB at most.
    """
    at = position(F.col(hashed), bits)
    bucket, bitmap = unused(df, "_bucket", "_bitmap")
    held = bitmaps.select(F.col("bucket").alias(bucket), F.col("bitmap").alias(bitmap))
    looked = df.withColumn(bucket, F.bitmap_bucket_number(at)).join(F.broadcast(held), bucket, "left")
    return looked.select(*df.columns, _is_set(at, F.col(bitmap)).alias(flag))
