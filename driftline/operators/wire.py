"""Registry-framed messages: split, census of schema ids, decoding per id."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.functions import frame_body, frame_magic, frame_schema_id
from driftline.functions.once import with_computed_once

Decoder = Callable[[Column], Column]


def split_frames(records: DataFrame) -> DataFrame:
    """Add magic byte, schema id, body and the reason a frame cannot be used."""
    value = F.col("value")
    reason = (
        F.when(value.isNull(), "null_value")
        .when(F.octet_length(value) < 5, "short_frame")
        .when(F.col("magic_byte") != F.lit(b"\x00"), "bad_magic")
    )
    return records.withColumns(
        {"magic_byte": frame_magic(value), "schema_id": frame_schema_id(value), "body": frame_body(value)}
    ).withColumn("reject_reason", reason)


def schema_census(frames: DataFrame) -> DataFrame:
    """Messages, first and last offset per schema id. Few rows come out, whatever goes in."""
    return frames.groupBy("schema_id").agg(
        F.count("*").alias("messages"),
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
    )


def latest_schema_id(frames: DataFrame) -> DataFrame:
    """The highest id among usable frames: a damaged frame's id means nothing."""
    return frames.filter("reject_reason IS NULL").agg(F.max("schema_id").alias("latest_schema_id"))


def avro_decoder(schema_json: str) -> Decoder:
    """Decoder for an Avro writer schema. Spark says so if its spark-avro package is missing."""
    from pyspark.sql.avro.functions import from_avro

    return lambda body: from_avro(body, schema_json)


def json_decoder(schema: T.StructType) -> Decoder:
    """Decoder for JSON bodies in the same frame."""
    return lambda body: F.from_json(body.cast("string"), schema)


def decode_frames(frames: DataFrame, decoders: Mapping[int, Decoder], latest_only: bool = False) -> DataFrame:
    """Decode each message under its own schema id, in one pass over the messages.

    The results share one struct holding every field of every schema; a message leaves null
    what its schema lacks. A field that schemas type differently takes the wider type. `latest_only` keeps just the highest id among the messages.
    Ids without a decoder keep their row, with `reject_reason` set.
    """
    if latest_only:
        newest = latest_schema_id(frames)  # one row
        frames = frames.join(F.broadcast(newest), F.col("schema_id") == F.col("latest_schema_id")).drop(
            "latest_schema_id"
        )
    names = {i: f"_decoded_{i}" for i in decoders}
    usable = F.col("reject_reason").isNull()
    decoded = frames
    for i, decode in decoders.items():
        mine = F.when(usable & (F.col("schema_id") == i), decode(F.col("body")))
        decoded = with_computed_once(decoded, names[i], mine)
    types = {i: decoded.schema[names[i]].dataType for i in decoders}
    merged = T.StructType([])
    for i in sorted(types):
        merged = _merge(merged, types[i])
    event = F.coalesce(*[_conform(F.col(names[i]), types[i], merged) for i in decoders])
    unknown = F.when(usable & ~F.col("schema_id").isin(*decoders), "unknown_schema")
    undecoded = F.when(usable & F.col("cdc_event").isNull(), "unparsable")
    return (
        decoded.withColumn("cdc_event", event)
        .withColumn("reject_reason", F.coalesce("reject_reason", unknown, undecoded))
        .drop(*names.values())
    )


def flatten_frames(decoded: DataFrame) -> DataFrame:
    """Envelope fields as columns; both images stay structs so that their fields can be pruned."""
    event = F.col("cdc_event")
    return decoded.select(
        "topic", "partition", "offset", F.col("timestamp").alias("kafka_timestamp"), "schema_id",
        event["before"].alias("before"), event["after"].alias("after"),
        event["op"].alias("operation"), event["ts_ms"].alias("cdc_timestamp_ms"), "reject_reason",
    )


_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def _wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """A type that holds every value of both, text if nothing else does; casting to it never fails."""
    if a == b:
        return a
    if isinstance(a, _INTEGRAL) and isinstance(b, _INTEGRAL):
        return max(a, b, key=lambda t: _INTEGRAL.index(type(t)))
    exact = [t if isinstance(t, T.DecimalType) else T.DecimalType(_DIGITS[type(t)], 0) for t in (a, b) if isinstance(t, (T.DecimalType, *_INTEGRAL))]
    if len(exact) == 2:
        scale = max(t.scale for t in exact)
        digits = max(t.precision - t.scale for t in exact) + scale
        return T.DecimalType(digits, scale) if digits <= 38 else T.StringType()
    # A double holds whole numbers of 32 bits, but not every long, and no decimal's digits.
    if all(isinstance(t, (*_INTEGRAL[:3], T.FloatType, T.DoubleType)) for t in (a, b)):
        return T.DoubleType()
    if {type(a), type(b)} == {T.DateType, T.TimestampType}:
        return T.TimestampType()
    return T.StringType()


def _merge(a: T.DataType, b: T.DataType) -> T.DataType:
    if not (isinstance(a, T.StructType) and isinstance(b, T.StructType)):
        return _wider(a, b)
    fields = {f.name: f.dataType for f in a.fields}
    for f in b.fields:
        fields[f.name] = _merge(fields[f.name], f.dataType) if f.name in fields else f.dataType
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


def _conform(value: Column, have: T.DataType, want: T.DataType) -> Column:
    if not isinstance(want, T.StructType) or have == want:
        return value.cast(want)
    types = {f.name: f.dataType for f in have.fields}
    fields = [
        (_conform(value[f.name], types[f.name], f.dataType) if f.name in types else F.lit(None).cast(f.dataType)).alias(
            f.name
        )
        for f in want.fields
    ]
    return F.when(value.isNotNull(), F.struct(*fields))
