"""Row digests that other databases can compute too."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PLAIN = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
NULL_TEXT = "\\N"
SEPARATOR = "\x1f"


def row_text(columns: Sequence[Column], kinds: Sequence[T.DataType] | None = None) -> Column:
    """Columns as one text. Nulls get a marker, else they would vanish from the text.

    Backslashes are doubled and separators within values escaped, so that no value reads like a marker or like two. `kinds` are the
    columns' types, if known: numbers, times and flags have nothing to escape, and are spared it.
    """
    kinds = kinds or [T.StringType()] * len(columns)
    texts = [c.cast("string") if isinstance(k, _PLAIN) else _escaped(c.cast("string")) for c, k in zip(columns, kinds, strict=True)]
    return F.concat_ws(SEPARATOR, *[F.coalesce(t, F.lit(NULL_TEXT)) for t in texts])


def _escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit(SEPARATOR), F.lit("\\s"))


def row_digest(columns: Sequence[Column], kinds: Sequence[T.DataType] | None = None) -> Column:
    """Leading 60 bits of the row's MD5 as a long. Sum it as a decimal: a long overflows."""
    return F.conv(F.substring(F.md5(row_text(columns, kinds)), 1, 15), 16, 10).cast("bigint")
