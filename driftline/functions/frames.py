"""Registry wire frame: a zero byte, a four-byte big-endian schema id, the body."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def frame_magic(value: Column) -> Column:
    return F.substring(value, 1, 1)


def frame_schema_id(value: Column) -> Column:
    """Schema id as a long, so that ids above the signed int range survive."""
    return F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("bigint")


def frame_body(value: Column) -> Column:
    """Everything after the header, however long."""
    return F.substr(value, F.lit(6))
