"""Times arrive as micros in row images, millis in envelopes and text in documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def from_micros(micros: Column, whole_seconds: bool = False) -> Column:
    """Timestamp of an epoch in microseconds; the fraction is kept unless asked otherwise."""
    ts = F.timestamp_micros(micros)
    return F.date_trunc("second", ts) if whole_seconds else ts


def from_millis(millis: Column, whole_seconds: bool = False) -> Column:
    """Timestamp of an epoch in milliseconds."""
    ts = F.timestamp_millis(millis)
    return F.date_trunc("second", ts) if whole_seconds else ts


def epoch_seconds(text: Column) -> Column:
    """Epoch seconds of an ISO text, with or without fraction or zone; null if it is no time."""
    return F.unix_seconds(F.try_to_timestamp(text))


def document_time(text: Column) -> Column:
    """Timestamp of a document field holding ISO text or a `$date` object."""
    date = F.get_json_object(text, "$.$date")
    millis = F.coalesce(F.get_json_object(date, "$.$numberLong"), date).try_cast("bigint")
    return F.coalesce(F.timestamp_millis(millis), F.try_to_timestamp(date), F.try_to_timestamp(text))
