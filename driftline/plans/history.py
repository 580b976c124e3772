"""Queries: versioned history, windows and before/after images."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.operators import history as h
from driftline.operators.keyed import over_key
from driftline.operators.quality import status_changes
from driftline.operators.relations import running_adjustments
from driftline.plans import given
from driftline.plans.given import CHANGES_SQL, SCD2_SQL
from driftline.plans.registry import Catalog
from driftline.session import shared_dir

CATALOG = Catalog()
KEYS = ["customer_id"]


def documented(spark: SparkSession, sf_dir: str) -> DataFrame:
    return h.scd2(given.history_input(spark, sf_dir), KEYS)


@CATALOG.add("t1_scd2_literal", f"""WITH {CHANGES_SQL}, ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY customer_id ORDER BY cdc_timestamp_ms DESC, "offset" DESC) AS INTEGER) AS version,
         date_trunc('second', make_timestamp(cdc_timestamp_ms * 1000)) AS event_time
  FROM changes WHERE operation IN ('r', 'c', 'u'))
SELECT customer_id, event_type, value, event_time, version = 1 AS is_current, event_time AS valid_from,
       CASE WHEN version <> 1 THEN event_time END AS valid_to, version FROM ranked""")
def scd2_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return h.scd2(given.history_input(spark, sf_dir), KEYS, semantics="literal")


@CATALOG.add("t2_scd2_documented", f"WITH {SCD2_SQL} SELECT * FROM scd2")
def scd2_documented(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documented(spark, sf_dir)


@CATALOG.add("t2_scd2_refresh", f"WITH {SCD2_SQL} SELECT * FROM scd2")
def scd2_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History before the last ten days, brought up to date with them: the same as from scratch."""
    changes = given.history_input(spark, sf_dir)
    cut = F.lit(1705795200000)  # 2024-01-21
    earlier, batch = changes.filter(F.col("cdc_timestamp_ms") < cut), changes.filter(F.col("cdc_timestamp_ms") >= cut)
    return h.refresh_scd2(h.scd2(earlier, KEYS), changes, batch, KEYS)


@CATALOG.add("t2_splice_late", f"WITH {SCD2_SQL} SELECT * FROM scd2")
def spliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored history into which two thirds of the changes come late, between those it holds, one batch of them twice."""
    table = h.HistoryTable(spark, shared_dir(spark, "history"), tuple(KEYS))
    changes = given.history_input(spark, sf_dir)
    for part in (1, 0, 2, 0):
        table.apply_batch(changes.filter(F.pmod("offset", F.lit(3)) == part))
    return table.read()


@CATALOG.add("t3_versions_of_key", f"WITH {SCD2_SQL} SELECT * FROM scd2 WHERE customer_id = 7")
def versions_of_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return h.versions_of(documented(spark, sf_dir), "customer_id", 7)


@CATALOG.add("t4_current_state", f"WITH {SCD2_SQL} SELECT * FROM scd2 WHERE is_current")
def current_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return h.current_state(documented(spark, sf_dir))


@CATALOG.add("t4_state_as_of", f"""WITH {SCD2_SQL} SELECT * FROM scd2
WHERE valid_from <= TIMESTAMP '2024-01-15 00:00:00' AND (valid_to IS NULL OR valid_to > TIMESTAMP '2024-01-15 00:00:00')""")
def state_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return h.state_as_of(documented(spark, sf_dir), "2024-01-15 00:00:00")


@CATALOG.add("t4_as_of_join", f"""WITH {SCD2_SQL}, asked AS (SELECT "offset", customer_id, kafka_timestamp - INTERVAL 36 HOUR AS asked_at FROM changes),
  newest AS (SELECT * FROM scd2 QUALIFY row_number() OVER (PARTITION BY customer_id, valid_from ORDER BY version DESC) = 1)
SELECT a."offset", a.customer_id, CASE WHEN v.valid_to IS NULL OR v.valid_to > a.asked_at THEN v.event_type END AS event_type,
  CASE WHEN v.valid_to IS NULL OR v.valid_to > a.asked_at THEN v.version END AS version
FROM asked a ASOF LEFT JOIN newest v ON a.customer_id = v.customer_id AND a.asked_at >= v.valid_from""")
def as_of_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every change the version of its customer that was in force a day and a half before."""
    asked = given.changes(spark, sf_dir).select("offset", "customer_id", (F.col("kafka_timestamp") - F.expr("INTERVAL 36 HOURS")).alias("asked_at"))
    found = h.as_of_join(asked, documented(spark, sf_dir), KEYS, "asked_at")
    return found.select("offset", "customer_id", F.col("in_force.event_type").alias("event_type"), F.col("in_force.version").alias("version"))


@CATALOG.add("t5_keys_with_history", f"""WITH {SCD2_SQL}
SELECT customer_id, count(*) AS version_count FROM scd2 GROUP BY customer_id HAVING count(*) > 1""")
def keys_with_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return h.keys_with_history(documented(spark, sf_dir), KEYS)


@CATALOG.add("a2_current_and_past_counts", f"WITH {SCD2_SQL} SELECT is_current, count(*) AS versions FROM scd2 GROUP BY is_current")
def current_and_past(spark: SparkSession, sf_dir: str) -> DataFrame:
    return h.current_and_past_counts(documented(spark, sf_dir))


@CATALOG.add("t6_changed_fields", f"""WITH {CHANGES_SQL}
SELECT "offset", operation,
  CASE operation WHEN 'u' THEN CASE WHEN event_type = 'view' THEN '' ELSE 'event_type' END
                 ELSE 'customer_id,event_type' || CASE WHEN value IS NULL THEN '' ELSE ',value' END END AS changed_fields
FROM changes""")
def changed_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = h.changed_fields(given.with_images(spark, sf_dir), ["customer_id", "event_type", "value"])
    return marked.select("offset", "operation", F.concat_ws(",", "changed_fields").alias("changed_fields"))


@CATALOG.add("t6_previous_image", f"""WITH {CHANGES_SQL}, p AS (
  SELECT *, lag(event_type) OVER k AS previous_type, lag(value) OVER k AS previous_value
  FROM changes WINDOW k AS (PARTITION BY customer_id ORDER BY cdc_timestamp_ms, "offset"))
SELECT "offset", previous_type, previous_value, event_type IS DISTINCT FROM previous_type AS type_changed FROM p""")
def previous_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = given.history_input(spark, sf_dir).withColumn("doc", F.struct("event_type", "value"))
    seen = h.with_previous_image(changes, KEYS, "doc")
    return seen.select(
        "offset",
        F.col("before.event_type").alias("previous_type"),
        F.col("before.value").alias("previous_value"),
        (~F.col("event_type").eqNullSafe(F.col("before.event_type"))).alias("type_changed"),
    )


@CATALOG.add("w1_rank_newest_first", f"""WITH {CHANGES_SQL}
SELECT "offset", customer_id, row_number() OVER (PARTITION BY customer_id ORDER BY cdc_timestamp_ms DESC, "offset" DESC) AS rank FROM changes""")
def rank_newest_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = given.history_input(spark, sf_dir)
    ranked = over_key(changes, KEYS, h.ORDER, running={"rank": F.lit(1)}, descending=True)
    return ranked.select("offset", "customer_id", "rank")


@CATALOG.add("w2_latest_per_key", f"""WITH {CHANGES_SQL}
SELECT customer_id, operation, event_type, value, cdc_timestamp_ms, "offset" FROM changes
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY cdc_timestamp_ms DESC, "offset" DESC) = 1""")
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return h.latest_changes(given.history_input(spark, sf_dir), KEYS)


_STATUS_SQL = """steps AS (
  SELECT o_custkey, o_orderkey, o_orderdate,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'pending' WHEN '2-HIGH' THEN 'confirmed' WHEN '3-MEDIUM' THEN 'shipped'
         WHEN '4-NOT SPECIFIED' THEN 'delivered' ELSE 'cancelled' END AS status
  FROM orders), stepped AS (
  SELECT *, lag(status) OVER (PARTITION BY o_custkey ORDER BY epoch_us(o_orderdate) // 1000, o_orderkey) AS previous_status FROM steps)"""


@CATALOG.add("w3_status_transitions", f"""WITH {_STATUS_SQL}
SELECT previous_status, status, (previous_status || '>' || status) IN
   ('pending>confirmed', 'pending>cancelled', 'confirmed>shipped', 'confirmed>cancelled', 'shipped>delivered') AS is_allowed,
   count(*) AS steps
FROM stepped WHERE previous_status IS NOT NULL AND previous_status <> status GROUP BY ALL""")
def status_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    from driftline.schemas import STATUS_TRANSITIONS

    steps = order_statuses(spark, sf_dir)
    checked = status_changes(steps, ["o_custkey"], ["ms", "o_orderkey"], "status", STATUS_TRANSITIONS)
    return checked.groupBy("previous_status", "status", "is_allowed").agg(F.count("*").alias("steps"))


def order_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of a customer as consecutive states, the priority standing for the status."""
    p = F.col("o_orderpriority")
    status = (
        F.when(p == "1-URGENT", "pending").when(p == "2-HIGH", "confirmed").when(p == "3-MEDIUM", "shipped")
        .when(p == "4-NOT SPECIFIED", "delivered").otherwise("cancelled")
    )
    orders = given.table(spark, sf_dir, "orders")
    return orders.select("o_custkey", "o_orderkey", given.millis("o_orderdate").alias("ms"), status.alias("status"))


@CATALOG.add("f24_running_quantity", """
SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice,
  CAST(sum(CAST(l_quantity AS BIGINT) - 20) OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_suppkey,
     CAST(round(l_extendedprice * 100) AS BIGINT), CAST(l_quantity AS BIGINT) RANGE UNBOUNDED PRECEDING) AS BIGINT) AS level
FROM lineitem""")
def running_quantity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock level per part after each adjustment."""
    lines = given.table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice",
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"),
        F.col("l_quantity").cast("bigint").alias("q"),
    )
    order = ["l_orderkey", "l_linenumber", "l_suppkey", "cents", "q"]
    levels = running_adjustments(lines, ["l_partkey"], order, {"level": F.col("q") - 20})
    return levels.drop("cents", "q")
