"""Queries: records, envelopes, frames and the column functions on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline import functions as fn
from driftline.operators import envelope as env
from driftline.operators import wire
from driftline.operators.bronze import operation_counts, stamp
from driftline.operators.history import scd2
from driftline.plans import given
from driftline.plans.given import CHANGES_SQL
from driftline.plans.registry import Catalog
from driftline.schemas import CUSTOMER_ROW, EVENT_TYPE_MAP, UPSERTS
from driftline.session import shared_dir
from driftline.sources import kafka

CATALOG = Catalog()

_FLAT_SQL = """SELECT "offset", kafka_timestamp, operation, cdc_timestamp_ms AS event_timestamp, 'customers' AS source_table,
  "offset" * 8 AS lsn,
  CASE WHEN operation <> 'd' THEN CAST(customer_id AS INTEGER) END AS customer_id,
  CASE WHEN operation <> 'd' THEN event_type || '.' || customer_id || '@example.com' END AS email,
  CASE WHEN operation <> 'd' THEN 'User ' || customer_id END AS full_name,
  CASE WHEN operation <> 'd' THEN props->>'$.k' END AS phone,
  CASE WHEN operation <> 'd' THEN us END AS created_at,
  CASE WHEN operation <> 'd' THEN us END AS updated_at
FROM changes"""


@CATALOG.add("envelope_to_history", f"""WITH {CHANGES_SQL}, k AS (
  SELECT *, lead(cdc_timestamp_ms) OVER w AS next_ms,
    CAST(sum(CASE WHEN operation <> 'd' THEN 1 ELSE 0 END) OVER (w ROWS UNBOUNDED PRECEDING) AS INTEGER) AS version
  FROM changes WINDOW w AS (PARTITION BY customer_id ORDER BY cdc_timestamp_ms, "offset"))
SELECT CAST(customer_id AS INTEGER) AS customer_id, event_type || '.' || customer_id || '@example.com' AS email,
  'User ' || customer_id AS full_name, props->>'$.k' AS phone, us AS created_at, us AS updated_at,
  next_ms IS NULL AS is_current, make_timestamp(cdc_timestamp_ms * 1000) AS valid_from,
  make_timestamp(next_ms * 1000) AS valid_to, version
FROM k WHERE operation <> 'd'""")
def envelope_to_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From JSON envelopes to versions: parse, drop rejects, key deletes by their before image, version."""
    changes = env.accepted(given.parsed(spark, sf_dir))
    flat = env.flatten_keyed(changes, ["customer_id"])
    return scd2(flat.select(*CUSTOMER_ROW.fieldNames(), "operation", "cdc_timestamp_ms", "offset"), ["customer_id"])


@CATALOG.add("s1_bounded_topic_read", f"""WITH {CHANGES_SQL}
SELECT topic, "partition", count(*) AS messages, min("offset") AS first_offset, max("offset") AS last_offset,
  max(kafka_timestamp) AS last_time, count(*) FILTER (operation = 'd') AS deletes FROM changes GROUP BY topic, "partition\"""")
def bounded_topic_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the records as a table with the broker's columns and read that range back."""
    landing = shared_dir(spark, "landing")
    given.records(spark, sf_dir).write.parquet(landing)
    op = F.get_json_object(F.col("value").cast("string"), "$.payload.op")
    return kafka.read_landing(spark, landing).groupBy("topic", "partition").agg(
        F.count("*").alias("messages"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"),
        F.max("timestamp").alias("last_time"), F.count_if(op == "d").alias("deletes"),
    )


@CATALOG.add("p2_flatten_relational", f"WITH {CHANGES_SQL} {_FLAT_SQL}")
def flatten_relational(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = env.flatten_image(env.accepted(given.parsed(spark, sf_dir)))
    return flat.drop("topic", "partition", "source_schema").withColumnRenamed("cdc_timestamp_ms", "event_timestamp")


_DOC_SQL = """docs AS (SELECT *, 'e' || "offset" AS mongo_id,
  CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'add_to_cart' WHEN 'error' THEN 'remove_from_cart'
       WHEN 'signup' THEN 'login' ELSE event_type END AS kind,
  CASE customer_id % 3 WHEN 0 THEN 'desktop' WHEN 1 THEN 'mobile' ELSE 'tablet' END AS device FROM changes)"""


@CATALOG.add("p3_flatten_event_documents", f"""WITH {CHANGES_SQL}, {_DOC_SQL}
SELECT "offset", kafka_timestamp, operation, cdc_timestamp_ms AS event_timestamp, 'customer_events' AS source_collection, mongo_id,
  CASE WHEN operation <> 'd' THEN 'E' || "offset" END AS event_id,
  CASE WHEN operation <> 'd' THEN CAST(customer_id AS INTEGER) END AS customer_id,
  CASE WHEN operation <> 'd' THEN kind END AS event_type,
  CASE WHEN operation <> 'd' THEN make_timestamp(CASE WHEN "offset" % 2 = 0 THEN us // 1000 * 1000 ELSE us END) END AS occurred_at,
  CASE WHEN operation <> 'd' THEN '/p/' || (props->>'$.k') END AS page,
  CASE WHEN operation <> 'd' THEN device END AS device,
  CASE WHEN operation <> 'd' THEN 's' || customer_id END AS session_id,
  CASE WHEN operation <> 'd' THEN '10.0.0.' || (props->>'$.k') END AS ip_address,
  CASE WHEN operation <> 'd' THEN "offset" % 2 = 0 END AS processed
FROM docs""")
def flatten_event_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with both spellings of ids and times; deletes keep the id of their record key."""
    flat = env.flatten_event_documents(env.accepted(given.parsed_documents(spark, sf_dir)))
    return flat.withColumn("occurred_at", fn.document_time(F.col("event_occurred_at"))).drop("event_occurred_at")


INVENTORY_SQL = """inventory AS (SELECT l_orderkey * 10 + l_linenumber AS "offset", l_shipdate AS kafka_timestamp,
  CASE l_returnflag WHEN 'R' THEN 'u' WHEN 'A' THEN 'c' ELSE 'r' END AS operation,
  l_orderkey || '-' || l_linenumber AS mongo_id, 'SKU-' || l_partkey AS product_id, 'WH-' || (l_suppkey % 4) AS warehouse,
  CAST(l_quantity AS INTEGER) - 10 AS quantity, CAST(l_linenumber * 5 AS INTEGER) AS reorder_point, l_extendedprice AS unit_cost,
  l_shipdate AS last_updated, CASE WHEN l_linestatus = 'O' THEN 'active' ELSE 'inactive' END AS status FROM lineitem)"""


@CATALOG.add("p4_flatten_inventory_documents", f"""WITH {INVENTORY_SQL}
SELECT "offset", kafka_timestamp, operation, epoch_us(kafka_timestamp) // 1000 AS event_timestamp,
  'inventory_snapshots' AS source_collection, mongo_id, product_id, warehouse, quantity, reorder_point, unit_cost,
  strftime(last_updated, '%Y-%m-%dT%H:%M:%S') AS last_updated, status FROM inventory""")
def flatten_inventory_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return env.flatten_inventory_documents(env.accepted(given.parsed_inventory(spark, sf_dir)))


@CATALOG.add("p5_flatten_frames", f"""WITH {CHANGES_SQL}
SELECT topic, "partition", "offset", kafka_timestamp, CASE WHEN "offset" % 5 >= 2 THEN 22 ELSE 21 END::BIGINT AS schema_id,
  operation, cdc_timestamp_ms,
  CASE WHEN operation IN ('u', 'd') THEN CAST(customer_id AS INTEGER) END AS before_id,
  CASE WHEN operation <> 'd' THEN CAST(customer_id AS INTEGER) END AS after_id,
  CASE WHEN operation <> 'd' THEN event_type || '@example.com' END AS after_email,
  CASE WHEN operation <> 'd' AND "offset" % 5 >= 2 THEN props->>'$.k' END AS after_phone
FROM changes""")
def flatten_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two schema versions in one topic, each message decoded under its own."""
    decoded = wire.decode_frames(wire.split_frames(given.framed_records(spark, sf_dir)), given.DECODERS)
    flat = env.accepted(wire.flatten_frames(decoded))
    return flat.select(
        *[c for c in flat.columns if c not in ("before", "after")],
        F.col("before.customer_id").alias("before_id"), F.col("after.customer_id").alias("after_id"),
        F.col("after.email").alias("after_email"), F.col("after.phone").alias("after_phone"),
    )


@CATALOG.add("w4_decode_per_schema", f"""WITH {CHANGES_SQL}
SELECT CASE WHEN "offset" % 5 >= 2 THEN 22 ELSE 21 END::BIGINT AS schema_id, operation, count(*) AS messages,
  count(CASE WHEN operation <> 'd' AND "offset" % 5 >= 2 THEN props->>'$.k' END) AS with_phone FROM changes GROUP BY ALL""")
def decode_per_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = wire.decode_frames(wire.split_frames(given.framed_records(spark, sf_dir)), given.DECODERS)
    return wire.flatten_frames(decoded).groupBy("schema_id", "operation").agg(
        F.count("*").alias("messages"), F.count("after.phone").alias("with_phone")
    )


@CATALOG.add("p15_latest_schema_only", f"""WITH {CHANGES_SQL}
SELECT "offset", operation, cdc_timestamp_ms FROM changes WHERE "offset" % 5 >= 2""")
def latest_schema_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = wire.split_frames(given.framed_records(spark, sf_dir))
    decoded = wire.decode_frames(frames, {22: given.DECODERS[22]}, latest_only=True)
    return wire.flatten_frames(decoded).select("offset", "operation", "cdc_timestamp_ms")


@CATALOG.add("a5_schema_census", """SELECT CASE WHEN event_id % 5 >= 2 THEN 22 ELSE 21 END::BIGINT AS schema_id, count(*) AS messages,
  min(event_id) AS first_offset, max(event_id) AS last_offset FROM events GROUP BY ALL""")
def schema_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wire.schema_census(wire.split_frames(given.framed_records(spark, sf_dir)))


@CATALOG.add("f13_split_frames", """SELECT doc_id, '00' AS magic, 4294967040 + doc_id % 200 AS schema_id, md5(text) AS body_md5,
  strlen(text)::BIGINT AS body_bytes FROM documents""")
def split_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames around whole texts, under ids beyond the signed range; bodies come back uncut."""
    docs = given.table(spark, sf_dir, "documents")
    schema_id = F.lit(4294967040) + F.pmod("doc_id", F.lit(200))
    frames = docs.select("doc_id", given.frame(schema_id, F.col("text")).alias("value"))
    split = wire.split_frames(frames)
    return split.select(
        "doc_id", F.hex("magic_byte").alias("magic"), "schema_id", F.md5("body").alias("body_md5"),
        F.octet_length("body").cast("bigint").alias("body_bytes"),
    )


@CATALOG.add("p7_operation_set", f"WITH {CHANGES_SQL} SELECT \"offset\", operation FROM changes WHERE operation IN ('r', 'c', 'u')")
def operation_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given.changes(spark, sf_dir).filter(F.col("operation").isin(*UPSERTS)).select("offset", "operation")


@CATALOG.add("p9_stamped_changes", f"""WITH {CHANGES_SQL}
SELECT "offset", topic AS source_topic, TIMESTAMP '2024-02-01 00:00:00' AS ingestion_time,
  TIMESTAMP '2024-02-01 00:00:00' AS _migration_ts, CAST(CAST(kafka_timestamp AS DATE) AS VARCHAR) AS event_date, 'postgres_local' AS source_system FROM changes""")
def stamped_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.lit("2024-02-01 00:00:00").cast("timestamp")
    stamped = stamp(given.changes(spark, sf_dir), run_ts=at, migration_ts=True)
    system = F.lit("postgres_local").alias("source_system")
    day = F.col("event_date").cast("string").alias("event_date")
    return stamped.select("offset", "source_topic", "ingestion_time", "_migration_ts", day, system)


@CATALOG.add("p12_topic_rename", """SELECT 'data:shop.public.' || event_type AS topic, count(*) AS messages FROM events GROUP BY event_type""")
def topic_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = given.table(spark, sf_dir, "events").select(F.concat(F.lit("shop.public."), "event_type").alias("topic"))
    return named.groupBy(env.rename_topic(F.col("topic")).alias("topic")).agg(F.count("*").alias("messages"))


@CATALOG.add("p13_topic_routing", """SELECT event_id, CASE event_type WHEN 'view' THEN 'own.topic' WHEN 'signup' THEN 'shop.public.users'
  WHEN 'purchase' THEN 'unknown.public.sales' WHEN 'click' THEN 'web.log.unknown' ELSE 'debezium.cdc.events' END AS topic FROM events""")
def topic_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that name their topic, some or none of its parts."""
    def source(**parts: str):
        fields = [F.lit(v).alias(k) for k, v in parts.items()]
        return F.to_json(F.struct(F.struct(F.struct(*fields).alias("source")).alias("payload")))

    kind = F.col("event_type")
    event = (
        F.when(kind == "view", F.to_json(F.struct(F.lit("own.topic").alias("topic"))))
        .when(kind == "signup", source(name="shop", schema="public", table="users"))
        .when(kind == "purchase", source(table="sales"))
        .when(kind == "click", source(name="web", schema="log"))
        .otherwise(F.to_json(F.struct("value")))
    )
    return given.table(spark, sf_dir, "events").select("event_id", env.route_topic(event).alias("topic"))


@CATALOG.add("s16_include_list", f"""WITH {CHANGES_SQL}
SELECT CASE WHEN customer_id % 3 = 0 THEN 'sales' ELSE 'public' END AS source_schema, event_type AS source_table, count(*) AS kept
FROM changes WHERE customer_id % 3 <> 0 AND event_type IN ('view', 'click') GROUP BY ALL""")
def include_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = F.when(F.pmod("customer_id", F.lit(3)) == 0, "sales").otherwise("public")
    changes = given.changes(spark, sf_dir).select(schema.alias("source_schema"), F.col("event_type").alias("source_table"))
    kept = env.include_only(changes, schemas=["public"], tables=["public.view", "click"])
    return kept.groupBy("source_schema", "source_table").agg(F.count("*").alias("kept"))


@CATALOG.add("s17_snapshot_then_changes", f"""WITH {CHANGES_SQL}
SELECT c_custkey AS customer_id, 'r' AS operation, CAST(0 AS BIGINT) AS cdc_timestamp_ms, CAST(-1 AS BIGINT) AS "offset", CAST(NULL AS VARCHAR) AS event_type FROM customer
UNION ALL SELECT customer_id, operation, cdc_timestamp_ms, "offset", event_type FROM changes""")
def snapshot_then_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapshot = given.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.lit(0).cast("bigint").alias("cdc_timestamp_ms"), F.lit(-1).cast("bigint").alias("offset")
    )
    changes = given.changes(spark, sf_dir).select("customer_id", "operation", "cdc_timestamp_ms", "offset", "event_type")
    return env.snapshot_then_changes(snapshot, changes)


_REJECT_SQL = """CASE event_id % 63 WHEN 0 THEN 'null_value' WHEN 7 THEN 'unparsable' WHEN 14 THEN 'unknown_op'
  WHEN 21 THEN 'missing_after' WHEN 28 THEN 'missing_key'
  WHEN 35 THEN 'missing_key' WHEN 42 THEN 'bad_field' WHEN 49 THEN 'bad_field' WHEN 56 THEN 'missing_key' END"""


@CATALOG.add("q8_rejected_records", f"SELECT event_id AS \"offset\", {_REJECT_SQL} AS reject_reason FROM events WHERE event_id % 7 = 0")
def rejected_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = env.parse_relational(given.damaged_records(spark, sf_dir), CUSTOMER_ROW, ["customer_id"])
    return env.rejected(parsed).select("offset", "reject_reason")


@CATALOG.add("q8_record_conformance", f"SELECT coalesce({_REJECT_SQL}, 'accepted') AS outcome, count(*) AS messages FROM events GROUP BY ALL")
def record_conformance(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = env.parse_relational(given.damaged_records(spark, sf_dir), CUSTOMER_ROW, ["customer_id"])
    outcome = F.coalesce("reject_reason", F.lit("accepted"))
    return parsed.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("messages"))


@CATALOG.add("q8_frame_conformance", """SELECT CASE event_id % 4 WHEN 0 THEN 'bad_magic' WHEN 1 THEN 'short_frame' WHEN 2 THEN 'unknown_schema' ELSE 'accepted' END AS outcome,
  count(*) AS messages FROM events GROUP BY ALL""")
def frame_conformance(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.to_json(F.struct(F.lit("r").alias("op"), given.millis("ts").alias("ts_ms")))
    good = given.frame(F.lit(21), body)
    case = F.pmod("event_id", F.lit(4))
    value = (
        F.when(case == 0, F.concat(F.unhex(F.lit("01")), F.substr(good, F.lit(2))))
        .when(case == 1, F.substring(good, 1, 3))
        .when(case == 2, given.frame(F.lit(99), body))
        .otherwise(good)
    )
    records = given.table(spark, sf_dir, "events").select(F.col("event_id").alias("offset"), value.alias("value"))
    decoded = wire.decode_frames(wire.split_frames(records), given.DECODERS)
    return decoded.groupBy(F.coalesce("reject_reason", F.lit("accepted")).alias("outcome")).agg(F.count("*").alias("messages"))


@CATALOG.add("a2_operation_counts", f"WITH {CHANGES_SQL} SELECT operation, count(*) AS change_count FROM changes GROUP BY operation")
def operation_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operation_counts(env.accepted(given.parsed(spark, sf_dir)))


@CATALOG.add("a3_operation_topic_counts", f"WITH {CHANGES_SQL} SELECT operation, topic AS source_topic, count(*) AS change_count FROM changes GROUP BY ALL")
def operation_topic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operation_counts(stamp(given.changes(spark, sf_dir)), "source_topic")


@CATALOG.add("a8_daily_mix", f"WITH {CHANGES_SQL} SELECT operation, CAST(CAST(kafka_timestamp AS DATE) AS VARCHAR) AS event_date, count(*) AS change_count FROM changes GROUP BY ALL")
def daily_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = operation_counts(stamp(given.changes(spark, sf_dir)), "event_date")
    return counts.withColumn("event_date", F.col("event_date").cast("string"))


@CATALOG.add("f3_object_ids", """SELECT event_id, 'e' || event_id AS id FROM events""")
def object_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = given.table(spark, sf_dir, "events")
    plain = F.concat(F.lit("e"), "event_id")
    mixed = F.when(F.pmod("event_id", F.lit(2)) == 0, F.to_json(F.struct(plain.alias("$oid")))).otherwise(plain)
    return events.select("event_id", fn.object_id(mixed).alias("id"))


@CATALOG.add("f4_struct_to_json", """SELECT event_id, CAST(props->>'$.k' AS INTEGER) AS k, value AS v, value > 100 AS has_note FROM events""")
def struct_to_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON written and read back; a null field is left out of the text."""
    events = given.table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int").alias("k")
    note = fn.null_when(F.col("value") <= 100, F.lit("big")).alias("note")
    text = F.to_json(F.struct(k, F.col("value").alias("v"), note))
    return events.select("event_id", text.alias("doc")).select(
        "event_id",
        F.from_json("doc", "k INT").getField("k").alias("k"),
        F.from_json("doc", "v DOUBLE").getField("v").alias("v"),
        F.col("doc").contains('"note"').alias("has_note"),
    )


@CATALOG.add("f5_json_field", "SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k FROM events")
def json_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = F.try_parse_json("props")
    return given.table(spark, sf_dir, "events").select("event_id", F.try_variant_get(parsed, "$.k", "bigint").alias("k"))


@CATALOG.add("f6_epoch_times", """SELECT event_id, ts AS from_micros, date_trunc('second', ts) AS from_micros_seconds,
  make_timestamp(epoch_us(ts) // 1000 * 1000) AS from_millis, epoch_us(ts) // 1000000 AS iso_seconds FROM events""")
def epoch_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    us, ms = given.micros("ts"), given.millis("ts")
    iso = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    text = F.when(F.pmod("event_id", F.lit(2)) == 0, iso).otherwise(fraction)
    return given.table(spark, sf_dir, "events").select(
        "event_id", fn.from_micros(us).alias("from_micros"), fn.from_micros(us, whole_seconds=True).alias("from_micros_seconds"),
        fn.from_millis(ms).alias("from_millis"), fn.epoch_seconds(text).alias("iso_seconds"),
    )


@CATALOG.add("f9_document_times", """SELECT event_id, CASE event_id % 5 WHEN 0 THEN make_timestamp(epoch_us(ts) // 1000 * 1000)
  WHEN 1 THEN ts WHEN 2 THEN make_timestamp(epoch_us(ts) // 1000 * 1000) WHEN 3 THEN date_trunc('second', ts) END AS at FROM events""")
def document_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ISO text with and without fraction, numeric and textual `$date` objects, and text that is no time."""
    ts = F.col("ts").cast("timestamp")
    ms = given.millis("ts")
    case = F.pmod("event_id", F.lit(5))
    long_form = F.struct(ms.cast("string").alias("$numberLong"))
    text = (
        F.when(case == 0, F.to_json(F.struct(ms.alias("$date"))))
        .when(case == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
        .when(case == 2, F.to_json(F.struct(long_form.alias("$date"))))
        .when(case == 3, F.to_json(F.struct(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("$date"))))
        .otherwise(F.lit("soon"))
    )
    return given.table(spark, sf_dir, "events").select("event_id", fn.document_time(text).alias("at"))


@CATALOG.add("f10_value_shaping", """SELECT event_id,
  CASE event_type WHEN 'view' THEN 'view' WHEN 'click' THEN 'cart_add' WHEN 'error' THEN 'cart_remove' ELSE event_type END AS mapped,
  CASE WHEN event_type = 'signup' THEN NULL WHEN value - 50 < 0 THEN 0 ELSE value - 50 END AS clamped,
  CASE WHEN value > 100 THEN NULL ELSE value END AS unless_big,
  CASE WHEN value > 100 THEN value ELSE -1 END AS defaulted,
  substr('+49 555 0123456789 ' || event_id, 1, 20) AS phone,
  CAST(event_id * 8 AS VARCHAR) AS cdc_lsn FROM events""")
def value_shaping(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, kind, value = given.table(spark, sf_dir, "events"), F.col("event_type"), F.col("value")
    raw = F.when(kind == "view", "page_view").when(kind == "click", "add_to_cart").when(kind == "error", "remove_from_cart").otherwise(kind)
    return events.select(
        "event_id",
        fn.map_values(raw, EVENT_TYPE_MAP).alias("mapped"),
        fn.clamp_at_zero(fn.null_when(kind == "signup", value - 50)).cast("double").alias("clamped"),
        fn.null_when(value > 100, value).alias("unless_big"),
        fn.default_to(fn.null_when(value <= 100, value), -1.0).alias("defaulted"),
        fn.truncate_text(F.concat(F.lit("+49 555 0123456789 "), "event_id"), 20).alias("phone"),
        (F.col("event_id") * 8).cast("string").alias("cdc_lsn"),
    )


@CATALOG.add("f24_set_in_struct", """SELECT event_id, event_id % 2 = 0 OR value > 100 AS processed, CASE WHEN value > 100 THEN 'late' ELSE 's' || user_id END AS session_id FROM events""")
def set_in_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    from driftline.operators.relations import set_in_struct as set_fields

    meta = F.struct((F.pmod("event_id", F.lit(2)) == 0).alias("processed"), F.concat(F.lit("s"), "user_id").alias("session_id"))
    docs = given.table(spark, sf_dir, "events").select("event_id", "value", meta.alias("metadata"))
    late = F.col("value") > 100
    updated = set_fields(docs, "metadata", {
        "processed": F.when(late, True).otherwise(F.col("metadata.processed")),
        "session_id": F.when(late, "late").otherwise(F.col("metadata.session_id")),
    })
    return updated.select("event_id", "metadata.processed", "metadata.session_id")


@CATALOG.add("p16_document_predicates", f"""WITH {CHANGES_SQL}, {_DOC_SQL} SELECT mongo_id, kind AS event_type FROM docs
WHERE operation <> 'd' AND "offset" % 2 = 0 AND us // 1000 * 1000 < epoch_us(TIMESTAMP '2024-01-20 00:00:00')""")
def document_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed documents older than a moment."""
    flat = env.flatten_event_documents(env.accepted(given.parsed_documents(spark, sf_dir)))
    old = fn.document_time(F.col("event_occurred_at")) < F.lit("2024-01-20 00:00:00").cast("timestamp")
    return flat.filter(old & F.col("processed")).select("mongo_id", "event_type")
