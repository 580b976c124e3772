"""Change streams derived from the given tables.

`events` plays the change log: the event type gives the operation, the user is the key, and
(time, event id) is the order. Everything here is a projection, so queries keep the tables'
size and partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.operators.envelope import parse_documents, parse_relational
from driftline.operators.wire import json_decoder
from driftline.schemas import CUSTOMER_ROW, EVENT_DOCUMENT, INT, INVENTORY_DOCUMENT, LONG, TEXT, row_type
from driftline.session import spread

TOPIC = "shop.public.customers"
DOCUMENT_TOPIC = "docs.shop.customer_events"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Times without zone are read as UTC throughout, as the checking database does.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table about to be turned into messages and parsed again, on all cores."""
    return spread(table(spark, sf_dir, name))


def micros(ts: str | Column) -> Column:
    return F.unix_micros((F.col(ts) if isinstance(ts, str) else ts).cast("timestamp"))


def millis(ts: str) -> Column:
    return F.expr(f"unix_micros(cast({ts} as timestamp)) div 1000")


def operation() -> Column:
    kind = F.col("event_type")
    return F.when(kind == "view", "r").when(kind == "signup", "c").when(kind == "error", "d").otherwise("u")


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat changes with their order, as read from the audit table."""
    return table(spark, sf_dir, "events").select(
        F.lit(TOPIC).alias("topic"),
        F.pmod("user_id", F.lit(4)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("kafka_timestamp"),
        operation().alias("operation"),
        millis("ts").alias("cdc_timestamp_ms"),
        F.col("user_id").alias("customer_id"),
        "event_type",
        "value",
    )


def history_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes(spark, sf_dir).drop("topic", "partition", "kafka_timestamp")


def with_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested changes: both images as structs."""
    image = F.struct("customer_id", "event_type", "value")
    prior = F.struct("customer_id", F.lit("view").alias("event_type"), "value")
    return changes(spark, sf_dir).select(
        "topic", "partition", "offset", "kafka_timestamp", "operation", "cdc_timestamp_ms", "customer_id",
        F.when(F.col("operation").isin("u", "d"), prior).alias("before"),
        F.when(F.col("operation") != "d", image).alias("after"),
    )


def _record(value: Column, key: Column, topic: Column | str) -> list[Column]:
    return [
        F.to_json(key).cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        (F.lit(topic) if isinstance(topic, str) else topic).alias("topic"),
        F.pmod("user_id", F.lit(4)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    ]


def relational_payload() -> Column:
    op = operation()
    customer = F.col("user_id").cast("int").alias("customer_id")
    before = F.struct(customer, F.concat(F.lit("was."), "user_id", F.lit("@example.com")).alias("email"))
    after = F.struct(
        customer,
        F.concat("event_type", F.lit("."), "user_id", F.lit("@example.com")).alias("email"),
        F.concat(F.lit("User "), "user_id").alias("full_name"),
        F.get_json_object("props", "$.k").alias("phone"),
        micros("ts").alias("created_at"),
        micros("ts").alias("updated_at"),
    )
    source = F.struct(
        F.lit("2.5").alias("version"), F.lit("postgresql").alias("connector"), F.lit("shop").alias("name"),
        millis("ts").alias("ts_ms"), F.lit("shop").alias("db"), F.lit("public").alias("schema"),
        F.lit("customers").alias("table"), (F.col("event_id") * 8).alias("lsn"),
    )
    return F.struct(
        op.alias("op"), millis("ts").alias("ts_ms"), source.alias("source"),
        F.when(op.isin("u", "d"), before).alias("before"), F.when(op != "d", after).alias("after"),
    )


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broker records with JSON envelopes of customer changes."""
    value = F.to_json(F.struct(relational_payload().alias("payload")))
    key = F.struct(F.col("user_id").alias("customer_id"))
    return spread_table(spark, sf_dir, "events").select(*_record(value, key, TOPIC))


def damaged_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As `records`, with one record in seven made unusable in one of nine ways."""
    good = F.struct(relational_payload().alias("payload"))
    text = F.to_json(good)
    bare = F.to_json(F.struct(F.struct(F.lit("u").alias("op"), millis("ts").alias("ts_ms")).alias("payload")))
    odd = F.to_json(F.struct(F.struct(F.lit("x").alias("op"), millis("ts").alias("ts_ms")).alias("payload")))
    keyless = F.to_json(F.struct(F.struct(F.lit("d").alias("op"), millis("ts").alias("ts_ms")).alias("payload")))
    after_of = lambda **fields: F.to_json(F.struct(F.struct(F.lit("c").alias("op"), millis("ts").alias("ts_ms"), F.struct(
        F.lit("a@b.example").alias("email"), *[v.alias(n) for n, v in fields.items()]).alias("after")).alias("payload")))
    nameless = F.to_json(F.struct(F.struct(F.lit("d").alias("op"), millis("ts").alias("ts_ms"), F.struct(
        F.lit("a@b.example").alias("email")).alias("before")).alias("payload")))
    case = F.pmod("event_id", F.lit(63))
    value = (
        F.when(case == 0, F.lit(None).cast("string"))
        .when(case == 35, after_of())
        .when(case == 42, after_of(customer_id=F.lit("abc")))
        .when(case == 49, after_of(customer_id=F.lit(3_000_000_000)))
        .when(case == 56, nameless)
        .when(case == 7, F.lit("{bad"))
        .when(case == 14, odd)
        .when(case == 21, bare)
        .when(case == 28, keyless)
        .otherwise(text)
    )
    key = F.struct(F.col("user_id").alias("customer_id"))
    return spread_table(spark, sf_dir, "events").select(*_record(value, key, TOPIC))


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_relational(records(spark, sf_dir), CUSTOMER_ROW, ["customer_id"])


def document_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broker records of event documents; ids and times come as text or as objects, by turns."""
    kind = F.col("event_type")
    name = (
        F.when(kind == "view", "page_view").when(kind == "click", "add_to_cart")
        .when(kind == "error", "remove_from_cart").when(kind == "signup", "login").otherwise(kind)
    )
    number = F.get_json_object("props", "$.k")
    meta = F.struct(
        F.concat(F.lit("/p/"), number).alias("page"),
        F.element_at(F.array(F.lit("desktop"), F.lit("mobile"), F.lit("tablet")), (F.pmod("user_id", F.lit(3)) + 1).cast("int")).alias("device"),
        F.concat(F.lit("s"), "user_id").alias("session_id"),
        F.concat(F.lit("10.0.0."), number).alias("ip_address"),
        (F.pmod("event_id", F.lit(2)) == 0).alias("processed"),
    ).alias("metadata")
    oid = F.concat(F.lit("e"), "event_id")
    fields = [
        F.concat(F.lit("E"), "event_id").alias("event_id"),
        F.col("user_id").cast("int").alias("customer_id"),
        name.alias("event_type"),
    ]
    iso = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    plain = F.to_json(F.struct(oid.alias("_id"), *fields, iso.alias("timestamp"), meta))
    typed = F.to_json(F.struct(F.struct(oid.alias("$oid")).alias("_id"), *fields, F.struct(millis("ts").alias("$date")).alias("timestamp"), meta))
    document = F.when(F.pmod("event_id", F.lit(2)) == 0, typed).otherwise(plain)
    op = operation()
    source = F.struct(F.lit("mongodb").alias("connector"), F.lit("docs").alias("name"), F.lit("shop").alias("db"), F.lit("customer_events").alias("collection"))
    payload = F.struct(op.alias("op"), millis("ts").alias("ts_ms"), source.alias("source"), F.when(op != "d", document).alias("after"))
    key = F.struct(F.to_json(F.struct(oid.alias("$oid"))).alias("id"))
    return spread_table(spark, sf_dir, "events").select(*_record(F.to_json(F.struct(payload.alias("payload"))), key, DOCUMENT_TOPIC))


def parsed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_documents(document_records(spark, sf_dir), EVENT_DOCUMENT)


def inventory_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broker records of inventory documents, one per line item."""
    iso = F.date_format(F.col("l_shipdate").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss")
    document = F.to_json(F.struct(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("_id"),
        F.concat(F.lit("SKU-"), "l_partkey").alias("product_id"),
        F.concat(F.lit("WH-"), F.pmod("l_suppkey", F.lit(4))).alias("warehouse"),
        (F.col("l_quantity").cast("int") - 10).alias("quantity"),
        (F.col("l_linenumber") * 5).alias("reorder_point"),
        F.col("l_extendedprice").alias("unit_cost"),
        iso.alias("last_updated"),
        F.when(F.col("l_linestatus") == "O", "active").otherwise("inactive").alias("status"),
    ))
    op = F.when(F.col("l_returnflag") == "R", "u").when(F.col("l_returnflag") == "A", "c").otherwise("r")
    source = F.struct(F.lit("mongodb").alias("connector"), F.lit("docs").alias("name"), F.lit("shop").alias("db"), F.lit("inventory_snapshots").alias("collection"))
    payload = F.struct(op.alias("op"), millis("l_shipdate").alias("ts_ms"), source.alias("source"), document.alias("after"))
    return spread_table(spark, sf_dir, "lineitem").select(
        F.lit(None).cast("binary").alias("key"),
        F.to_json(F.struct(payload.alias("payload"))).cast("binary").alias("value"),
        F.lit("docs.shop.inventory_snapshots").alias("topic"),
        F.lit(0).alias("partition"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("offset"),
        F.col("l_shipdate").cast("timestamp").alias("timestamp"),
    )


def parsed_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_documents(inventory_records(spark, sf_dir), INVENTORY_DOCUMENT)


VALUE_21 = row_type(customer_id=INT, email=TEXT)
VALUE_22 = row_type(customer_id=INT, email=TEXT, phone=TEXT)


def _body(value: T.StructType) -> T.StructType:
    return row_type(before=value, after=value, op=TEXT, ts_ms=LONG)


# Two versions of one schema, the later with a column more.
DECODERS = {21: json_decoder(_body(VALUE_21)), 22: json_decoder(_body(VALUE_22))}


def frame(schema_id: Column, body: Column) -> Column:
    """A wire frame: zero byte, four-byte id, body."""
    return F.concat(F.unhex(F.lit("00")), F.unhex(F.lpad(F.hex(schema_id.cast("bigint")), 8, "0")), body.cast("binary"))


def framed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Framed records under two schema ids; the later half of the offsets' residues use the newer."""
    newer = F.pmod("event_id", F.lit(5)) >= 2
    op = operation()
    base = [F.col("user_id").cast("int").alias("customer_id"), F.concat("event_type", F.lit("@example.com")).alias("email")]
    phone = F.get_json_object("props", "$.k").alias("phone")

    def body(fields: list[Column]) -> Column:
        image = F.struct(*fields)
        return F.to_json(F.struct(
            F.when(op.isin("u", "d"), image).alias("before"), F.when(op != "d", image).alias("after"),
            op.alias("op"), millis("ts").alias("ts_ms"),
        ))

    value = F.when(newer, frame(F.lit(22), body([*base, phone]))).otherwise(frame(F.lit(21), body(base)))
    key = F.struct(F.col("user_id").alias("customer_id"))
    return spread_table(spark, sf_dir, "events").select(*_record(value, key, TOPIC))


# The same streams as common table expressions for the checking SQL.
CHANGES_SQL = """changes AS (
  SELECT event_id AS "offset", ts AS kafka_timestamp, CAST(user_id % 4 AS INTEGER) AS "partition",
         'shop.public.customers' AS topic,
         CASE event_type WHEN 'view' THEN 'r' WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS operation,
         epoch_us(ts) // 1000 AS cdc_timestamp_ms, epoch_us(ts) AS us,
         user_id AS customer_id, event_type, value, props
  FROM events)"""
SCD2_SQL = CHANGES_SQL + """, stepped AS (
  SELECT *, lead(cdc_timestamp_ms) OVER k AS next_ms,
         CAST(sum(CASE WHEN operation <> 'd' THEN 1 ELSE 0 END) OVER (k ROWS UNBOUNDED PRECEDING) AS INTEGER) AS version
  FROM changes WINDOW k AS (PARTITION BY customer_id ORDER BY cdc_timestamp_ms, "offset")
), scd2 AS (
  SELECT customer_id, event_type, value, next_ms IS NULL AS is_current,
         make_timestamp(cdc_timestamp_ms * 1000) AS valid_from, make_timestamp(next_ms * 1000) AS valid_to, version
  FROM stepped WHERE operation <> 'd')"""
