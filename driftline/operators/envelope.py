"""Change envelopes: parse, classify, flatten."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.functions import object_id
from driftline.functions.once import with_computed_once
from driftline.schemas import (
    DELETE,
    DOCUMENT_ENVELOPE,
    EVENT_DOCUMENT,
    INVENTORY_DOCUMENT,
    OPERATIONS,
    UPSERTS,
    relational_envelope,
)

RECORD_COLUMNS = ("topic", "partition", "offset")


# Where the JSON parser leaves the text of a record of which some value did not fit its type.
_DAMAGED = "_corrupt_record"


def _reject_reason(value: Column, payload: Column, image_missing: Column, key_missing: Column, damaged: Column) -> Column:
    op = payload["op"]
    return (
        F.when(value.isNull(), "null_value")
        .when(payload.isNull() | (op.isNull() & payload["ts_ms"].isNull()), "unparsable")
        .when(op.isNull() | ~op.isin(*OPERATIONS), "unknown_op")
        .when(op.isin(*UPSERTS) & image_missing, "missing_after")
        .when(damaged, "bad_field")
        .when(key_missing, "missing_key")
    )


def _noting_damage(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(_DAMAGED, T.StringType())])


def parse_relational(records: DataFrame, row: T.StructType, keys: Sequence[str] = ()) -> DataFrame:
    """Kafka records to one row per change with both images and a reject reason.

    A record is bad when `reject_reason` is set; the parser itself only yields nulls for it.
    `bad_field` means that a value does not fit its type and would be lost. With `keys`, upserts need
    them in the after image and deletes in the before image; without, a delete needs a before image.
    Records are parsed once and classified in the same pass, so accepted and rejected
    changes can be written together.
    """
    text = F.col("value").cast("string")
    parsed = with_computed_once(records, "data", F.from_json(text, _noting_damage(relational_envelope(row))))
    payload = F.col("data.payload")
    is_delete = payload["op"] == DELETE
    key_missing = is_delete & payload["before"].isNull()
    for key in keys:
        key_missing = key_missing | F.when(is_delete, payload["before"][key]).otherwise(payload["after"][key]).isNull()
    damaged = F.col(f"data.{_DAMAGED}").isNotNull()
    reason = _reject_reason(F.col("value"), payload, payload["after"].isNull(), key_missing, damaged)
    return parsed.select(
        *RECORD_COLUMNS,
        F.col("timestamp").alias("kafka_timestamp"),
        payload["op"].alias("operation"),
        payload["ts_ms"].alias("cdc_timestamp_ms"),
        payload["source"]["schema"].alias("source_schema"),
        payload["source"]["table"].alias("source_table"),
        payload["source"]["lsn"].alias("lsn"),
        payload["before"].alias("before"),
        payload["after"].alias("after"),
        reason.alias("reject_reason"),
    )


def parse_documents(records: DataFrame, document: T.StructType) -> DataFrame:
    """Kafka records of a document source: the document is JSON text inside the JSON envelope.

    Deletes carry no document, so the key comes from the record key in their place. Reject reasons are
    those of `parse_relational`; a document without an id counts as missing.
    """
    parsed = with_computed_once(records, "data", F.from_json(F.col("value").cast("string"), _noting_damage(DOCUMENT_ENVELOPE)))
    payload = F.col("data.payload")
    parsed = with_computed_once(parsed, "doc", F.from_json(payload["after"], _noting_damage(document)))
    key_text = F.get_json_object(F.col("key").cast("string"), "$.id")
    parsed = parsed.withColumn("mongo_id", object_id(F.coalesce(F.col("doc._id"), key_text)))
    no_document = payload["after"].isNull() | F.col("doc").isNull() | F.col("doc._id").isNull()
    damaged = F.col(f"data.{_DAMAGED}").isNotNull() | F.coalesce(F.col(f"doc.{_DAMAGED}").isNotNull(), F.lit(False))
    reason = _reject_reason(F.col("value"), payload, no_document, F.col("mongo_id").isNull(), damaged)
    return parsed.select(
        *RECORD_COLUMNS,
        F.col("timestamp").alias("kafka_timestamp"),
        payload["op"].alias("operation"),
        payload["ts_ms"].alias("cdc_timestamp_ms"),
        payload["source"]["collection"].alias("source_collection"),
        "mongo_id",
        F.col("doc").dropFields(_DAMAGED).alias("doc"),
        reason.alias("reject_reason"),
    )


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject_reason").isNotNull())


def flatten_image(changes: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """Lift the fields of the after image to columns, next to the change's own columns."""
    names = fields or changes.schema["after"].dataType.fieldNames()
    own = [c for c in changes.columns if c not in ("before", "after")]
    return changes.select(*own, *[F.col("after").getField(n).alias(n) for n in names])


def flatten_keyed(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """As `flatten_image`, but the keys of a delete come from its before image."""
    flat = flatten_image(changes.withColumn("_before", F.col("before")))
    filled = {k: F.coalesce(F.col(k), F.col("_before").getField(k)) for k in keys}
    return flat.withColumns(filled).drop("_before")


def flatten_event_documents(parsed: DataFrame) -> DataFrame:
    """Customer event documents as columns. `parsed` used `EVENT_DOCUMENT`."""
    assert parsed.schema["doc"].dataType == EVENT_DOCUMENT
    meta = F.col("doc.metadata")
    return parsed.select(
        "offset", "kafka_timestamp", "operation",
        F.col("cdc_timestamp_ms").alias("event_timestamp"),
        "source_collection", "mongo_id", "doc.event_id", "doc.customer_id", "doc.event_type",
        F.col("doc.timestamp").alias("event_occurred_at"),
        *[meta[n].alias(n) for n in ("page", "device", "session_id", "ip_address", "processed")],
    )


def flatten_inventory_documents(parsed: DataFrame) -> DataFrame:
    """Inventory snapshot documents as columns. `parsed` used `INVENTORY_DOCUMENT`."""
    assert parsed.schema["doc"].dataType == INVENTORY_DOCUMENT
    return parsed.select(
        "offset", "kafka_timestamp", "operation",
        F.col("cdc_timestamp_ms").alias("event_timestamp"),
        "source_collection", "mongo_id",
        *[F.col(f"doc.{n}") for n in INVENTORY_DOCUMENT.fieldNames() if n != "_id"],
    )


def route_topic(event_json: Column, default: str = "debezium.cdc.events") -> Column:
    """Topic of an event: its own, else server.schema.table of its source, else the default."""
    source = F.get_json_object(event_json, "$.payload.source")
    named = F.concat_ws(
        ".",
        F.coalesce(F.get_json_object(source, "$.name"), F.lit("unknown")),
        F.coalesce(F.get_json_object(source, "$.schema"), F.lit("public")),
        F.coalesce(F.get_json_object(source, "$.table"), F.lit("unknown")),
    )
    explicit = F.get_json_object(event_json, "$.topic")
    return F.coalesce(F.when(explicit != "", explicit), F.when(source.isNotNull(), named), F.lit(default))


def write_by_topic(events: DataFrame, event_json: Column, path: str) -> None:
    """Append events to one folder per topic they belong to."""
    events.withColumn("topic", route_topic(event_json)).write.mode("append").partitionBy("topic").parquet(path)


def rename_topic(topic: Column, pattern: str = "^.*$", replacement: str = "data:$0") -> Column:
    return F.regexp_replace(topic, pattern, replacement)


def include_only(
    changes: DataFrame,
    schemas: Sequence[str] | None = None,
    tables: Sequence[str] | None = None,
    collections: Sequence[str] | None = None,
) -> DataFrame:
    """Keep the changes of the listed schemas, `schema.table`s and `db.collection`s or bare names."""
    out = changes
    if schemas:
        out = out.filter(F.col("source_schema").isin(*schemas))
    if tables:
        qualified = F.concat_ws(".", "source_schema", "source_table")
        out = out.filter(F.col("source_table").isin(*tables) | qualified.isin(*tables))
    if collections:
        out = out.filter(F.col("source_collection").isin(*collections))
    return out


def snapshot_then_changes(snapshot: DataFrame, changes: DataFrame) -> DataFrame:
    """Snapshot rows as reads, followed by the changes; columns either side lacks are null."""
    return snapshot.withColumn("operation", F.lit("r")).unionByName(changes, allowMissingColumns=True)
