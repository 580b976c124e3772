"""Value shaping for loads into target tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from driftline.schemas import EMAIL_PATTERN


def map_values(value: Column, mapping: Mapping[str, str]) -> Column:
    """Replace the mapped values and keep every other one."""
    renamed = reduce(lambda acc, kv: acc.when(value == kv[0], kv[1]), mapping.items(), F)
    return renamed.otherwise(value)


def clamp_at_zero(value: Column) -> Column:
    """Negative becomes zero. Null stays null, which `greatest` would turn into zero."""
    return F.when(value < 0, F.lit(0)).otherwise(value)


def null_when(condition: Column, value: Column) -> Column:
    """Null where the condition holds, the value elsewhere (also where it is unknown)."""
    return F.when(F.coalesce(condition, F.lit(False)), F.lit(None)).otherwise(value)


def default_to(value: Column, default: object) -> Column:
    return F.coalesce(value, default if isinstance(default, Column) else F.lit(default))


def object_id(text: Column) -> Column:
    """Document id as plain text, from either `abc` or `{"$oid": "abc"}`."""
    return F.when(text.startswith("{"), F.get_json_object(text, "$.$oid")).otherwise(text)


def truncate_text(text: Column, width: int) -> Column:
    return F.substring(text, 1, width)


def email_is_valid(text: Column) -> Column:
    return text.rlike(EMAIL_PATTERN)
