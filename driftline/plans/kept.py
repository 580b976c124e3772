"""Queries: figures and tables kept up to date batch by batch, and differences found from digests."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.functions.canonical import canonical
from driftline.operators import envelope as env
from driftline.operators import kept, targets, validate
from driftline.operators.chunks import merge_chunks, state_of
from driftline.operators.digest_tree import diff_by_tree
from driftline.operators.relations import Reference, cascade_graph
from driftline.plans import given
from driftline.plans.cutover import _COLUMNS, _DIFF_SQL, _TARGET_SQL, _digest_sql, _target_orders, _text_sql
from driftline.plans.given import CHANGES_SQL
from driftline.plans.loads import _BATCH, _third
from driftline.plans.registry import Catalog
from driftline.schemas import ORDER_ITEM_ROW, ORDER_ROW
from driftline.session import shared_dir

CATALOG = Catalog()
KEYS = ["customer_id"]


def _kept(spark: SparkSession, sf_dir: str) -> Iterator[tuple[DataFrame, int]]:
    """What each third of the month changes in the customers' state, the second third once more."""
    table = targets.TargetTable(spark, shared_dir(spark, "target"), tuple(KEYS))
    changes = given.changes(spark, sf_dir).withColumn("phone", F.pmod("offset", F.lit(101)))
    for batch_id in (0, 1, 2, 1):
        batch = changes.filter(_third() == batch_id).drop("topic", "partition", "kafka_timestamp")
        yield kept.effects(table.state(), batch, KEYS), batch_id
        table.apply_batch(batch, batch_id)


_STATE_SQL = """state AS (SELECT * FROM changes QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY cdc_timestamp_ms DESC, "offset" DESC) = 1)"""


@CATALOG.add("v2_kept_checksum", f"""WITH {CHANGES_SQL}, {_STATE_SQL}
SELECT count(*) AS row_count, {_digest_sql(f'customer_id, {_text_sql("event_type")}, round(value * 100)::BIGINT')} AS checksum FROM state WHERE operation <> 'd'""")
def kept_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checksum of the customers' state, moved by what each batch changes, against one of the whole state."""
    path = shared_dir(spark, "checksum")
    columns = ["customer_id", "event_type", F.round(F.col("value") * 100).cast("bigint")]
    for effect, batch_id in _kept(spark, sf_dir):
        kept.record_checksum(effect, columns, path, batch_id)
    return kept.kept_checksum(spark, path)


@CATALOG.add("q2_unique_kept", f"""WITH {CHANGES_SQL}, {_STATE_SQL} SELECT "offset" % 101 AS value, count(*) AS holders FROM state WHERE operation <> 'd' GROUP BY 1 HAVING count(*) > 1""")
def unique_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers that several customers have, from signed counts of what each batch changes."""
    path = shared_dir(spark, "values")
    for effect, batch_id in _kept(spark, sf_dir):
        kept.record_values(effect, "phone", path, batch_id)
    return kept.duplicate_values(spark, path)


@CATALOG.add("q2_violations_kept", f"""WITH {CHANGES_SQL}, b AS (SELECT unnest([0, 1, 2]) AS batch_id), states AS (
    SELECT b.batch_id, c.* FROM b JOIN changes c ON {_BATCH} <= b.batch_id
    QUALIFY row_number() OVER (PARTITION BY b.batch_id, customer_id ORDER BY cdc_timestamp_ms DESC, "offset" DESC) = 1),
  held AS (SELECT batch_id, "offset" % 101 AS value, count(*) AS holders FROM states WHERE operation <> 'd' GROUP BY ALL),
  steps AS (SELECT v.value, b.batch_id, coalesce(h.holders, 0) AS holders FROM (SELECT DISTINCT value FROM held) v CROSS JOIN b LEFT JOIN held h ON h.value = v.value AND h.batch_id = b.batch_id),
  moved AS (SELECT *, lag(holders, 1, 0) OVER (PARTITION BY value ORDER BY batch_id) AS before FROM steps)
SELECT value, 'batch' AS stream, batch_id::BIGINT AS batch_id, CASE WHEN holders > 1 THEN 'begin' ELSE 'end' END AS event, holders
FROM moved WHERE (holders > 1) <> (before > 1)""")
def violations_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When a number came to be shared and when it ceased to be."""
    path = shared_dir(spark, "values")
    for effect, batch_id in _kept(spark, sf_dir):
        kept.record_values(effect, "phone", path, batch_id)
    return kept.violations(spark, path)


@CATALOG.add("v3_digest_tree", f"WITH {_TARGET_SQL} {_DIFF_SQL}")
def digest_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The differences between the orders and their copy, in the key ranges alone whose digests differ."""
    return diff_by_tree(given.table(spark, sf_dir, "orders"), _target_orders(spark, sf_dir), "o_orderkey", _COLUMNS)


@CATALOG.add("s17_chunked_snapshot", f"""WITH {CHANGES_SQL} SELECT customer_id, event_type, value FROM changes
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY "offset" DESC) = 1""")
def chunked_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot read in four chunks, each at its own moment between two marks, merged with the changes after the first mark."""
    changes = given.table(spark, sf_dir, "events").select(F.col("event_id").alias("offset"), F.col("user_id").alias("customer_id"), "event_type", "value", F.lit("u").alias("operation"))
    last = changes.agg(F.max("offset")).first()[0]
    chunks = None
    for chunk in range(4):
        low, high = last * (2 * chunk + 1) // 10, last * (2 * chunk + 3) // 10
        read_at = (low + high) // 2
        rows = changes.filter((F.pmod("customer_id", F.lit(4)) == chunk) & (F.col("offset") <= read_at)).groupBy("customer_id").agg(
            F.max_by(F.struct("event_type", "value"), "offset").alias("row")
        )
        rows = rows.select("customer_id", "row.*", F.lit(low).cast("long").alias("low"), F.lit(high).cast("long").alias("high"))
        chunks = rows if chunks is None else chunks.unionByName(rows)
    merged = merge_chunks(chunks, changes.filter(F.col("offset") > last // 10), KEYS)
    return state_of(merged, KEYS).select("customer_id", "event_type", "value")


@CATALOG.add("j5_cascade_graph", """WITH RECURSIVE gone(t, k) AS (
    SELECT 'region', 1::BIGINT UNION SELECT 'event', 5::BIGINT
    UNION (
      SELECT 'nation', n_nationkey::BIGINT FROM gone JOIN nation ON t = 'region' AND n_regionkey = k UNION ALL
      SELECT 'customer', c_custkey::BIGINT FROM gone JOIN customer ON t = 'nation' AND c_nationkey = k UNION ALL
      SELECT 'supplier', s_suppkey::BIGINT FROM gone JOIN supplier ON t = 'nation' AND s_nationkey = k UNION ALL
      SELECT 'orders', o_orderkey::BIGINT FROM gone JOIN orders ON t = 'customer' AND o_custkey = k UNION ALL
      SELECT 'event', event_id::BIGINT FROM gone JOIN events ON t = 'event' AND event_id < 2000 AND (event_id * 7 + 3) % 2000 = k UNION ALL
      SELECT 'event', event_id::BIGINT FROM gone JOIN events ON t = 'event' AND event_id >= 2000 AND event_id // 3 = k))
SELECT t AS table_name, k AS key FROM gone""")
def cascade_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything that goes with a region and an event: five tables in a row, and events that refer to events, in cycles and in trees."""
    tables = {t: given.table(spark, sf_dir, t) for t in ("region", "nation", "customer", "supplier", "orders")}
    linked = F.when(F.col("event_id") < 2000, F.pmod(F.col("event_id") * 7 + 3, F.lit(2000))).otherwise(F.floor(F.col("event_id") / 3))
    tables["event"] = given.table(spark, sf_dir, "events").select("event_id", linked.cast("long").alias("refers_to"))
    keys = {"region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"], "supplier": ["s_suppkey"], "orders": ["o_orderkey"], "event": ["event_id"]}
    references = [
        Reference("nation", "n_regionkey", "region", "r_regionkey"), Reference("customer", "c_nationkey", "nation", "n_nationkey"),
        Reference("supplier", "s_nationkey", "nation", "n_nationkey"), Reference("orders", "o_custkey", "customer", "c_custkey"),
        Reference("event", "refers_to", "event", "event_id"),
    ]
    start = {"region": tables["region"].filter("r_regionkey = 1"), "event": tables["event"].filter("event_id = 5")}
    gone = cascade_graph(tables, keys, references, start)
    named = [rows.select(F.lit(t).alias("table_name"), F.col(keys[t][0]).cast("long").alias("key")) for t, rows in gone.items()]
    out = named[0]
    for rows in named[1:]:
        out = out.unionByName(rows)
    return out


def _order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broker records with JSON envelopes of orders."""
    row = F.struct(
        F.col("o_orderkey").cast("int").alias("order_id"), F.col("o_custkey").cast("int").alias("customer_id"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("total_amount"),
        F.when(F.col("o_orderstatus") == "F", "delivered").when(F.col("o_orderstatus") == "O", "confirmed").alias("status"),
        F.lower("o_orderpriority").alias("payment_method"), given.micros("o_orderdate").alias("created_at"), given.micros("o_orderdate").alias("updated_at"),
    )
    source = F.struct(F.lit("shop").alias("db"), F.lit("public").alias("schema"), F.lit("orders").alias("table"), F.col("o_orderkey").cast("long").alias("lsn"))
    payload = F.struct(F.lit("c").alias("op"), given.millis("o_orderdate").alias("ts_ms"), source.alias("source"), row.alias("after"))
    return given.spread_table(spark, sf_dir, "orders").select(
        F.lit(None).cast("binary").alias("key"), F.to_json(F.struct(payload.alias("payload"))).cast("binary").alias("value"),
        F.lit("shop.public.orders").alias("topic"), F.lit(0).alias("partition"), F.col("o_orderkey").cast("long").alias("offset"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"),
    )


# What the statuses of these orders are called at the target.
_STATUSES = {"delivered": "completed", "confirmed": "processing"}


@CATALOG.add("u4_order_rows", """SELECT o_orderkey::INTEGER AS order_id, o_custkey::INTEGER AS customer_id, round(o_totalprice * 100)::BIGINT AS cents,
  CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'processing' ELSE 'pending' END AS status, lower(o_orderpriority) AS payment_method,
  o_orderdate::TIMESTAMP AS created_at, o_orderkey::VARCHAR AS cdc_lsn FROM orders""")
def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = env.flatten_image(env.accepted(env.parse_relational(_order_records(spark, sf_dir), ORDER_ROW, ["order_id"])))
    rows = targets.shape_orders(flat, F.lit("2024-02-01").cast("timestamp"), _STATUSES)
    cents = (F.col("total_amount") * 100).cast("bigint").alias("cents")
    return rows.select("order_id", "customer_id", cents, "status", "payment_method", "created_at", "cdc_lsn")


@CATALOG.add("u4_order_item_rows", """SELECT (l_orderkey * 10 + l_linenumber)::INTEGER AS item_id, l_orderkey::INTEGER AS order_id, 'SKU-' || l_partkey AS product_name,
  l_quantity::INTEGER AS quantity, round(l_extendedprice * 100)::BIGINT AS cents, l_shipdate::TIMESTAMP AS created_at, l_suppkey::VARCHAR AS cdc_lsn FROM lineitem""")
def order_item_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = F.struct(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("int").alias("item_id"), F.col("l_orderkey").cast("int").alias("order_id"),
        F.concat(F.lit("SKU-"), "l_partkey").alias("product_name"), F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("price"), given.micros("l_shipdate").alias("created_at"),
    )
    source = F.struct(F.lit("shop").alias("db"), F.lit("public").alias("schema"), F.lit("order_items").alias("table"), F.col("l_suppkey").cast("long").alias("lsn"))
    payload = F.struct(F.lit("c").alias("op"), given.millis("l_shipdate").alias("ts_ms"), source.alias("source"), row.alias("after"))
    records = given.spread_table(spark, sf_dir, "lineitem").select(
        F.lit(None).cast("binary").alias("key"), F.to_json(F.struct(payload.alias("payload"))).cast("binary").alias("value"),
        F.lit("shop.public.order_items").alias("topic"), F.lit(0).alias("partition"), F.col("l_orderkey").cast("long").alias("offset"),
        F.col("l_shipdate").cast("timestamp").alias("timestamp"),
    )
    flat = env.flatten_image(env.accepted(env.parse_relational(records, ORDER_ITEM_ROW, ["item_id"])))
    rows = targets.shape_order_items(flat, F.lit("2024-02-01").cast("timestamp"))
    return rows.select("item_id", "order_id", "product_name", "quantity", (F.col("price") * 100).cast("bigint").alias("cents"), "created_at", "cdc_lsn")


# A price's digits without needless zeros.
_PRICE_SQL = r"regexp_replace(printf('%.2f', o_totalprice), '\.?0+$', '')"


@CATALOG.add("v2_canonical_types", f"""SELECT count(*) AS source_rows, count(*) AS target_rows, true AS matches,
  {_digest_sql(f"o_orderkey, {_PRICE_SQL}, epoch_us(o_orderdate), {_text_sql('o_orderpriority')}")} AS checksum FROM orders""")
def canonical_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as one system types them and as another does: equal digests of the same rows."""
    orders = given.table(spark, sf_dir, "orders")
    names = ["o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority"]
    one = orders.select("o_orderkey", F.col("o_totalprice").cast("double"), F.col("o_orderdate").cast("timestamp_ntz"), "o_orderpriority")
    other = orders.select(
        F.col("o_orderkey").cast("decimal(20,2)"), F.round("o_totalprice", 2).cast("decimal(18,4)").alias("o_totalprice"),
        F.col("o_orderdate").cast("timestamp"), "o_orderpriority",
    )
    compared = validate.compare_checksums(one.select(canonical(one, names)), other.select(canonical(other, names)), names)
    return compared.select("source_rows", "target_rows", "matches", F.col("source_checksum").alias("checksum"))
