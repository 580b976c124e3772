"""Queries: projections, joins, counts, orderings and samples on the tables themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.operators import relations as rel
from driftline.operators.keyed import latest_per_key
from driftline.operators.validate import sample_keys
from driftline.plans import given
from driftline.plans.given import CHANGES_SQL
from driftline.plans.registry import Catalog

CATALOG = Catalog()


@CATALOG.add("p1_projection", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")


@CATALOG.add("p6_comparison_filter", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 5000")
def comparison_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given.table(spark, sf_dir, "customer").filter(F.col("c_acctbal") > 5000).select("c_custkey", "c_acctbal")


@CATALOG.add("p8_equality_filter", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F'")
def equality_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given.table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey")


@CATALOG.add("p10_drop_columns", "SELECT event_id, user_id, event_type FROM events")
def drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given.table(spark, sf_dir, "events").drop("ts", "value", "props")


@CATALOG.add("p14_classify_tables", """SELECT CASE WHEN event_type IN ('view', 'error') THEN 'target' WHEN event_type = 'signup' THEN 'tracking' ELSE 'other' END AS role,
  count(*) AS mentions FROM events GROUP BY ALL""")
def classify_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names with a literal underscore and with another character in its place count alike."""
    kind = F.col("event_type")
    name = (
        F.when(kind == "view", F.concat(F.lit("target_"), "user_id")).when(kind == "error", F.concat(F.lit("targetX"), "user_id"))
        .when(kind == "signup", "migration_status").otherwise("target")
    )
    named = given.table(spark, sf_dir, "events").select(name.alias("table_name"))
    return rel.classify_tables(named).groupBy("role").agg(F.count("*").alias("mentions"))


@CATALOG.add("p17_point_lookup", "SELECT * FROM customer WHERE c_custkey = 42")
def point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given.table(spark, sf_dir, "customer").filter(F.col("c_custkey") == 42)


@CATALOG.add("j1_parents_without_children", """SELECT c_custkey, c_name FROM customer c LEFT JOIN
  (SELECT * FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F') o ON c.c_custkey = o.o_custkey WHERE o.o_orderkey IS NULL""")
def parents_without_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = given.table(spark, sf_dir, "orders")
    urgent = orders.filter((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F"))
    customers = given.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return rel.parents_without_children(customers, "c_custkey", urgent, "o_custkey")


@CATALOG.add("j2_inner_join", """SELECT o_orderkey, c_name, n_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""")
def inner_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strategies are left to Spark, which knows the sides' sizes when it runs."""
    orders, customer, nation = (given.table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey).join(nation, customer.c_nationkey == nation.n_nationkey)
    return joined.select("o_orderkey", "c_name", "n_name")


@CATALOG.add("j4_orphans", """SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)""")
def orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of customers that a partial load has left out."""
    loaded = given.table(spark, sf_dir, "customer").filter("c_acctbal >= 0")
    return rel.orphans(given.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_custkey", loaded, "c_custkey")


_CASCADE_SQL = """gone AS (SELECT c_custkey FROM customer WHERE c_acctbal < 0),
  kept_orders AS (SELECT * FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM gone)),
  gone_orders AS (SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM gone)),
  kept_items AS (SELECT * FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM gone_orders))"""


def _cascade(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    deleted = given.table(spark, sf_dir, "customer").filter("c_acctbal < 0")
    return rel.cascade_delete(
        deleted, "c_custkey", given.table(spark, sf_dir, "orders"), "o_custkey", "o_orderkey",
        given.table(spark, sf_dir, "lineitem"), "l_orderkey",
    )


@CATALOG.add("j5_cascade_children", f"WITH {_CASCADE_SQL} SELECT o_orderkey, o_custkey FROM kept_orders")
def cascade_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cascade(spark, sf_dir)[0].select("o_orderkey", "o_custkey")


@CATALOG.add("j5_cascade_grandchildren", f"""WITH {_CASCADE_SQL} SELECT l_orderkey, count(*) AS items, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity FROM kept_items GROUP BY l_orderkey""")
def cascade_grandchildren(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cascade(spark, sf_dir)[1].groupBy("l_orderkey").agg(
        F.count("*").alias("items"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity")
    )


@CATALOG.add("j6_keyed_update", f"""WITH {CHANGES_SQL}, patch AS (
  SELECT customer_id, event_type, value FROM changes WHERE operation = 'u'
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY cdc_timestamp_ms DESC, "offset" DESC) = 1)
SELECT c_custkey, c_name, c_nationkey, CASE WHEN customer_id IS NULL THEN c_acctbal ELSE value END AS c_acctbal,
  CASE WHEN customer_id IS NULL THEN c_mktsegment ELSE event_type END AS c_mktsegment
FROM customer LEFT JOIN patch ON c_custkey = customer_id""")
def keyed_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with the columns their latest update sets."""
    updates = given.history_input(spark, sf_dir).filter("operation = 'u'")
    patch = latest_per_key(updates, ["customer_id"], ["cdc_timestamp_ms", "offset"]).select(
        F.col("customer_id").alias("c_custkey"), F.col("event_type").alias("c_mktsegment"), F.col("value").alias("c_acctbal")
    )
    return rel.apply_patch(given.table(spark, sf_dir, "customer"), patch, ["c_custkey"])


@CATALOG.add("a1_row_count", "SELECT count(*) AS row_count FROM lineitem")
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given.table(spark, sf_dir, "lineitem").agg(F.count("*").alias("row_count"))


@CATALOG.add("a4_having", "SELECT o_custkey, count(*) AS order_count FROM orders GROUP BY o_custkey HAVING count(*) > 10")
def having(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = given.table(spark, sf_dir, "orders")
    return orders.groupBy("o_custkey").agg(F.count("*").alias("order_count")).filter("order_count > 10")


@CATALOG.add("a6_tagged_counts", """SELECT 'customer' AS table_name, count(*) AS row_count FROM customer UNION ALL
  SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem""")
def tagged_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel.tagged_counts({t: given.table(spark, sf_dir, t) for t in ("customer", "orders", "lineitem")})


@CATALOG.add("l1_ordered", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type ORDER BY event_type")
def ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given.table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n")).orderBy("event_type")


@CATALOG.add("l4_latest_five", "SELECT event_id, ts, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 5")
def latest_five(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = given.table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    return events.orderBy(F.desc("ts"), F.desc("event_id")).limit(5)


@CATALOG.add("l5_first_row", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 1")
def first_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").orderBy("o_orderkey").limit(1)


@CATALOG.add("l6_repeatable_sample", "SELECT o_orderkey FROM orders WHERE ('0x' || substr(md5(o_orderkey::VARCHAR), 1, 2))::INTEGER < 16")
def repeatable_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_keys(given.table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"])
