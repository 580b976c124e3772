"""Queries: audit table, loading targets, tracking."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.operators import envelope as env
from driftline.operators import targets
from driftline.operators.bronze import batch_log, read_batch_log, read_bronze, stamp, write_batch
from driftline.operators.history import as_of_batch, read_history, scd2, write_history
from driftline.plans import given
from driftline.plans.given import CHANGES_SQL
from driftline.plans.records import _DOC_SQL, INVENTORY_SQL
from driftline.plans.registry import Catalog
from driftline.session import shared_dir
from driftline.sources import tables

CATALOG = Catalog()
RUN_TS = "2024-02-01 00:00:00"
KEYS = ["customer_id"]

# Batches by third of the month: 0, 1, 2.
_BATCH = "CAST(least((day(kafka_timestamp) - 1) // 10, 2) AS BIGINT)"
LATEST_SQL = """latest AS (SELECT * FROM changes
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY cdc_timestamp_ms DESC, "offset" DESC) = 1)"""


def _run_ts() -> Column:
    return F.lit(RUN_TS).cast("timestamp")


def _third() -> Column:
    return F.least(F.floor((F.dayofmonth("kafka_timestamp") - 1) / 10), F.lit(2))


def stored_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change log written as three batches, the second one twice."""
    path = shared_dir(spark, "bronze")
    changes = stamp(given.changes(spark, sf_dir), run_ts=F.col("kafka_timestamp"))
    for batch_id in (0, 1, 2, 1):
        write_batch(changes.filter(_third() == batch_id), path, batch_id)
    return read_bronze(spark, path)


@CATALOG.add("s6_append_batches", f"""WITH {CHANGES_SQL} SELECT {_BATCH} AS batch_id, CAST(CAST(kafka_timestamp AS DATE) AS VARCHAR) AS event_date, count(*) AS n FROM changes GROUP BY ALL""")
def append_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = stored_bronze(spark, sf_dir)
    return bronze.groupBy("batch_id", F.col("event_date").cast("string").alias("event_date")).agg(F.count("*").alias("n"))


@CATALOG.add("u7_batch_log", f"""WITH {CHANGES_SQL}, b AS (SELECT {_BATCH} AS batch_id, max(kafka_timestamp) AS committed_at, count(*) AS rows_added FROM changes GROUP BY ALL)
SELECT batch_id, committed_at, 'append' AS operation, rows_added, CAST(sum(rows_added) OVER (ORDER BY batch_id) AS BIGINT) AS total_rows FROM b""")
def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_log(stored_bronze(spark, sf_dir)).drop("stream")


# Two streams that number their batches alike: of the even partitions by third of the month, of the odd ones by half.
_STREAM = "CASE WHEN \"partition\" % 2 = 0 THEN 'even' ELSE 'odd' END"
_STREAM_BATCH = f"CAST(CASE WHEN \"partition\" % 2 = 0 THEN {_BATCH} ELSE least((day(kafka_timestamp) - 1) // 15, 1) END AS BIGINT)"
_TWO_STREAMS_SQL = f"""b AS (SELECT {_STREAM} AS stream, {_STREAM_BATCH} AS batch_id, max(kafka_timestamp) AS committed_at, count(*) AS rows_added FROM changes GROUP BY ALL),
  log AS (SELECT stream, batch_id, committed_at, 'append' AS operation, rows_added,
    CAST(sum(rows_added) OVER (ORDER BY committed_at, stream, batch_id) AS BIGINT) AS total_rows FROM b)"""


def _two_streams(spark: SparkSession, sf_dir: str) -> str:
    """The change log ingested by two streams, batches of one written again later."""
    path = shared_dir(spark, "bronze")
    changes = stamp(given.changes(spark, sf_dir), run_ts=F.col("kafka_timestamp"))
    even = F.pmod("partition", F.lit(2)) == 0
    half = F.least(F.floor((F.dayofmonth("kafka_timestamp") - 1) / 15), F.lit(1))
    for stream, part, batch, number in (("even", even, _third(), (0, 1, 2, 1)), ("odd", ~even, half, (0, 1))):
        for batch_id in number:
            write_batch(changes.filter(part & (batch == batch_id)), path, batch_id, stream=stream)
    return path


@CATALOG.add("u7_two_streams", f"""WITH {CHANGES_SQL}, {_TWO_STREAMS_SQL} SELECT * FROM log""")
def batches_of_two_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch log as ingest wrote it, read without the audit table."""
    return read_batch_log(spark, _two_streams(spark, sf_dir))


@CATALOG.add("t7_two_streams", f"""WITH {CHANGES_SQL}, {_TWO_STREAMS_SQL}, by_then AS (
    SELECT b.stream, b.batch_id FROM log b, log m WHERE m.stream = 'odd' AND m.batch_id = 0
      AND (b.committed_at, b.stream, b.batch_id) <= (m.committed_at, m.stream, m.batch_id))
SELECT c."partition", CAST(CAST(kafka_timestamp AS DATE) AS VARCHAR) AS event_date, count(*) AS n FROM changes c
JOIN by_then t ON {_STREAM} = t.stream AND {_STREAM_BATCH} = t.batch_id GROUP BY ALL""")
def table_as_of_two_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit table as it stood when one stream's first batch was committed, with what the other had by then."""
    path = _two_streams(spark, sf_dir)
    then = as_of_batch(read_bronze(spark, path), 0, "odd", read_batch_log(spark, path))
    return then.groupBy("partition", F.col("event_date").cast("string").alias("event_date")).agg(F.count("*").alias("n"))


@CATALOG.add("t7_as_of_batch", f"""WITH {CHANGES_SQL}, seen AS (SELECT * FROM changes WHERE {_BATCH} <= 1), s AS (
  SELECT *, lead(cdc_timestamp_ms) OVER k AS next_ms, CAST(sum(CASE WHEN operation <> 'd' THEN 1 ELSE 0 END) OVER (k ROWS UNBOUNDED PRECEDING) AS INTEGER) AS version
  FROM seen WINDOW k AS (PARTITION BY customer_id ORDER BY cdc_timestamp_ms, "offset"))
SELECT customer_id, event_type, value, next_ms IS NULL AS is_current, make_timestamp(cdc_timestamp_ms * 1000) AS valid_from,
  make_timestamp(next_ms * 1000) AS valid_to, version FROM s WHERE operation <> 'd'""")
def history_as_of_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History as it stood after the second batch."""
    seen = as_of_batch(stored_bronze(spark, sf_dir), 1)
    return scd2(seen.select("customer_id", "event_type", "value", "operation", "cdc_timestamp_ms", "offset"), KEYS)


@CATALOG.add("s7_partitioned_history", f"""WITH {given.SCD2_SQL} SELECT is_current, count(*) AS versions, count(DISTINCT customer_id) AS customers FROM scd2 GROUP BY is_current""")
def partitioned_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History stored by currentness, so that the current rows are found without reading the rest."""
    path = shared_dir(spark, "silver")
    write_history(scd2(given.history_input(spark, sf_dir), KEYS), path)
    stored = read_history(spark, path)
    per_key = stored.groupBy("is_current", "customer_id").agg(F.count("*").alias("n"))
    return per_key.groupBy("is_current").agg(F.sum("n").alias("versions"), F.count("*").alias("customers"))


@CATALOG.add("s13_table_lifecycle", """SELECT o_orderstatus, count(*) * 2 AS orders, CAST(sum(o_custkey) * 2 AS BIGINT) AS custkeys, 3::BIGINT AS columns, 1::BIGINT AS tables
FROM orders GROUP BY o_orderstatus""")
def table_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog table created if it is not there, filled by position twice, replaced, dropped beside another, listed and described."""
    database = f"lifecycle_{uuid.uuid4().hex[:12]}"
    tables.ensure_database(spark, database, shared_dir(spark, "database"))
    orders = given.table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("long"), "o_orderstatus", F.col("o_orderkey").cast("long"))
    name, other = f"{database}.orders", f"{database}.other"
    for _ in range(2):
        tables.ensure_table(spark, name, orders.select("o_orderkey", "o_custkey", "o_orderstatus").schema, ["o_orderstatus"])
        # The columns come in another order, and go where their names are.
        tables.append_table(orders, name)
    tables.replace_table(orders.limit(1), other)
    tables.drop_table(spark, other)
    columns = tables.describe_table(spark, name).filter("NOT col_name LIKE '#%'").select("col_name").distinct().agg(F.count("*").alias("columns"))
    listed = tables.list_tables(spark, database).agg(F.count("*").alias("tables"))
    counts = tables.read_table(spark, name).groupBy("o_orderstatus").agg(F.count("*").alias("orders"), F.sum("o_custkey").alias("custkeys"))
    # Two single rows beside the counts.
    return counts.withColumn("one", F.lit(1)).join(columns.withColumn("one", F.lit(1)), "one").join(listed.withColumn("one", F.lit(1)), "one").drop("one")


@CATALOG.add("u1_blind_append", f"""WITH {CHANGES_SQL} SELECT customer_id, count(*) * 2 AS copies FROM changes WHERE operation <> 'd' GROUP BY customer_id""")
def blind_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loading the same rows twice by plain append leaves two copies of each."""
    path = shared_dir(spark, "append")
    rows = given.changes(spark, sf_dir).filter("operation <> 'd'").select("customer_id", "event_type")
    for _ in range(2):
        rows.write.mode("append").parquet(path)
    return spark.read.parquet(path).groupBy("customer_id").agg(F.count("*").alias("copies"))


@CATALOG.add("u2_insert_or_ignore", """WITH first AS (SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
   ORDER BY epoch_us(l_shipdate) // 1000, l_partkey, l_suppkey, CAST(round(l_extendedprice * 100) AS BIGINT)) = 1)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM first
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')""")
def insert_or_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as inserts, where the target already has the lines of some orders."""
    lines = given.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        given.millis("l_shipdate").alias("ms"), F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"),
    )
    pending = given.table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    present = lines.join(pending, "l_orderkey", "left_semi").select("l_orderkey", "l_linenumber").distinct()
    added = targets.insert_or_ignore(present, lines, ["l_orderkey", "l_linenumber"], ["ms", "l_partkey", "l_suppkey", "cents"])
    return added.drop("ms", "cents")


@CATALOG.add("u3_apply_changes", f"""WITH {CHANGES_SQL}, {LATEST_SQL} SELECT customer_id, event_type, value FROM latest WHERE operation <> 'd'""")
def apply_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two halves of the log applied newest first: order of arrival does not matter."""
    changes = given.history_input(spark, sf_dir)
    late = F.pmod("offset", F.lit(2)) == 0
    state = targets.apply_changes(None, changes.filter(~late), KEYS)
    # This state is computed rather than stored, so it is ranked with the changes, not read twice.
    state = targets.apply_changes(state, changes.filter(late), KEYS, broadcast_bytes=0)
    return targets.live(state).select("customer_id", "event_type", "value")


@CATALOG.add("u3_target_table", f"""WITH {CHANGES_SQL}, {LATEST_SQL} SELECT customer_id, event_type, value FROM latest WHERE operation <> 'd'""")
def target_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through a stored target: later batches first, one repeated, folded halfway."""
    table = targets.TargetTable(spark, shared_dir(spark, "target"), ("customer_id",))
    changes = given.changes(spark, sf_dir)
    for batch_id, third in enumerate((2, 0, 1)):
        part = changes.filter(_third() == third).drop("topic", "partition", "kafka_timestamp")
        table.apply_batch(part, batch_id)
        table.apply_batch(part, batch_id)
        if batch_id == 1:
            table.compact()
    return table.read().select("customer_id", "event_type", "value")


@CATALOG.add("u4_customer_rows", f"""WITH {CHANGES_SQL} SELECT CAST(customer_id AS INTEGER) AS customer_id, event_type || '.' || customer_id || '@example.com' AS email,
  'User ' || customer_id AS full_name, props->>'$.k' AS phone, kafka_timestamp AS created_at, kafka_timestamp AS updated_at,
  'postgres_local' AS source_system, TIMESTAMP '{RUN_TS}' AS migrated_at, CAST("offset" * 8 AS VARCHAR) AS cdc_lsn FROM changes WHERE operation <> 'd'""")
def customer_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = env.flatten_image(env.accepted(given.parsed(spark, sf_dir)))
    return targets.shape_customers(flat, _run_ts())


@CATALOG.add("u4_event_rows", f"""WITH {CHANGES_SQL}, {_DOC_SQL} SELECT 'E' || "offset" AS event_id, CAST(customer_id AS INTEGER) AS customer_id,
  CASE kind WHEN 'page_view' THEN 'view' WHEN 'add_to_cart' THEN 'cart_add' WHEN 'remove_from_cart' THEN 'cart_remove' ELSE kind END AS event_type,
  '{{"page":"/p/' || (props->>'$.k') || '","device":"' || device || '","session_id":"s' || customer_id || '","ip_address":"10.0.0.' || (props->>'$.k') || '"}}' AS event_data,
  make_timestamp(CASE WHEN "offset" % 2 = 0 THEN us // 1000 * 1000 ELSE us END) AS event_timestamp,
  'mongodb_atlas' AS source_system, TIMESTAMP '{RUN_TS}' AS migrated_at, mongo_id AS mongo_object_id FROM docs WHERE operation IN ('r', 'c')""")
def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = env.flatten_event_documents(env.accepted(given.parsed_documents(spark, sf_dir)))
    return targets.shape_events(flat, _run_ts())


@CATALOG.add("u4_inventory_rows", f"""WITH {INVENTORY_SQL} SELECT mongo_id AS snapshot_id, product_id, CASE WHEN quantity < 0 THEN 0 ELSE quantity END AS quantity,
  warehouse AS warehouse_location, reorder_point, unit_cost, status, last_updated AS snapshot_timestamp, 'mongodb_atlas' AS source_system,
  TIMESTAMP '{RUN_TS}' AS migrated_at, mongo_id AS mongo_object_id FROM inventory WHERE operation IN ('r', 'c')""")
def inventory_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = env.flatten_inventory_documents(env.accepted(given.parsed_inventory(spark, sf_dir)))
    rows = targets.shape_inventory(flat, _run_ts())
    data = F.from_json("snapshot_data", "reorder_point INT, unit_cost DOUBLE, status STRING")
    return rows.select(*[c for c in rows.columns if c != "snapshot_data"], data.alias("d")).select("*", "d.*").drop("d")


@CATALOG.add("u5_tracking", f"""WITH {CHANGES_SQL}, loaded AS (
  SELECT CASE event_type WHEN 'view' THEN 'target_customers' WHEN 'click' THEN 'target_orders' WHEN 'signup' THEN 'target_order_items' ELSE 'target_customer_events' END AS target_table,
    "offset", kafka_timestamp FROM changes), counted AS (
  SELECT target_table, count(*) AS n, max(kafka_timestamp) AS last_at, max("offset") AS o FROM loaded GROUP BY 1), seeds(source_table, target_table) AS (VALUES
  ('customers', 'target_customers'), ('orders', 'target_orders'), ('order_items', 'target_order_items'),
  ('customer_events', 'target_customer_events'), ('inventory_snapshots', 'target_inventory_snapshots'))
SELECT source_table, s.target_table, CAST(NULL AS VARCHAR) AS kafka_topic, coalesce(n, 0)::BIGINT AS total_records_migrated,
  last_at AS last_migrated_at, 'in_progress' AS migration_status, o AS last_kafka_offset
FROM seeds s LEFT JOIN counted c ON s.target_table = c.target_table""")
def tracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracking rows after the log arrived in three batches, one of them recorded twice."""
    kind = F.col("event_type")
    target = (
        F.when(kind == "view", "target_customers").when(kind == "click", "target_orders")
        .when(kind == "signup", "target_order_items").otherwise("target_customer_events")
    )
    loaded = given.changes(spark, sf_dir).withColumns({"target": target, "migrated_at": F.col("kafka_timestamp")})
    path = shared_dir(spark, "tracking")
    for batch_id in (0, 1, 2, 1):
        counts = targets.load_counts(loaded.filter(_third() == batch_id), F.col("target"))
        targets.record_loads(counts, path, batch_id)
    return targets.update_tracking(targets.seed_tracking(spark), targets.recorded_loads(spark, path))
