"""One text for a value, however a system types it, so that digests of unlike systems agree."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Strings are passed over, whole numbers written as doubles lose their fraction.
_WHOLE_DOUBLE = r'("(?:[^"\\]|\\.)*")|(-?\d+)\.0(?=[,\]}]|$)'
_FRACTION = r"^(-?\d+)(?:\.0*|(\.\d*?[1-9])0*)$"


def number_text(value: Column, kind: T.DataType) -> Column:
    """A number in plain digits without needless zeros: whole numbers, decimals, floats and doubles of the same value agree.

    Floats count by the digits they are written with. A double that a decimal of 38 digits does not hold keeps its own form.
    """
    if isinstance(kind, T.IntegralType):
        return value.cast("string")
    if isinstance(kind, T.DecimalType):
        text = value.cast("string")
    else:
        double = value.cast("string").try_cast("double")
        exact = double.try_cast("decimal(38,18)")
        text = F.when(exact.cast("double") == double, exact.cast("string")).otherwise(value.cast("string"))
    plain = F.regexp_replace(text, _FRACTION, "$1$2")
    return F.when(plain == "-0", "0").otherwise(plain)


def time_text(value: Column, kind: T.DataType) -> Column:
    """A time as microseconds since 1970. A time without zone counts as UTC, whatever the session's zone."""
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), value).cast("string")
    return F.unix_micros(value).cast("string")


def json_text(text: Column) -> Column:
    """JSON with its keys sorted, without spaces, and with one form of each number; what is no JSON stays as it is.

    Numbers are equal if their digits are; those that are written with an exponent and have more than seven digits keep it.
    """
    parsed = F.to_json(F.try_parse_json(text))
    return F.coalesce(F.regexp_replace(parsed, _WHOLE_DOUBLE, "$1$2"), text)


def composed(text: Column) -> Column:
    """Letters and their accents in composed form (NFC). Rows go through Python in batches, since Spark has no function for it."""

    @F.pandas_udf("string")
    def normal(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFC", t))

    return normal(text)


def canonical_text(value: Column, kind: T.DataType, json: bool = False, compose: bool = False) -> Column:
    """The text of a value by its type; null stays null. `json` says that a text holds JSON, `compose` that letters are to be composed."""
    if isinstance(kind, T.NumericType):
        return number_text(value, kind)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return time_text(value, kind)
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return json_text(F.to_json(value, {"ignoreNullFields": "false"}))
    if isinstance(kind, T.VariantType):
        return json_text(F.to_json(value))
    if isinstance(kind, T.BinaryType):
        return F.lower(F.hex(value))
    text = value.cast("string")
    if isinstance(kind, T.StringType):
        text = json_text(text) if json else text
        text = composed(text) if compose else text
    return text


def canonical(df: DataFrame, columns: Sequence[str], json: Sequence[str] = (), compose: bool = False) -> list[Column]:
    """Columns for `checksum` and its like, the same for the same rows however they are typed."""
    return [canonical_text(F.col(c), df.schema[c].dataType, c in json, compose).alias(c) for c in columns]
