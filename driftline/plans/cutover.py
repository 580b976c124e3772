"""Queries: source against target, lag, readiness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.operators import validate as v
from driftline.operators.targets import apply_changes, live
from driftline.plans import given
from driftline.plans.given import CHANGES_SQL
from driftline.plans.registry import Catalog

CATALOG = Catalog()


def _target_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A copy of the orders with rows missing, added and altered."""
    orders = given.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    key = F.col("o_orderkey")
    altered = orders.filter(F.pmod(key, F.lit(97)) != 5).withColumns({
        "o_orderstatus": F.when(F.pmod(key, F.lit(89)) == 7, "X").otherwise(F.col("o_orderstatus")),
        "o_orderpriority": F.when(F.pmod(key, F.lit(83)) == 11, None).otherwise(F.col("o_orderpriority")),
    })
    added = orders.filter(F.pmod(key, F.lit(101)) == 13).withColumn("o_orderkey", -key - 1)
    return altered.unionByName(added)


_TARGET_SQL = """target AS (
  SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 89 = 7 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
    CASE WHEN o_orderkey % 83 = 11 THEN NULL ELSE o_orderpriority END AS o_orderpriority FROM orders WHERE o_orderkey % 97 <> 5
  UNION ALL SELECT -o_orderkey - 1, o_custkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderkey % 101 = 13)"""
_DIFF_SQL = """SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey,
    CASE WHEN t.o_orderkey IS NULL THEN 'missing' WHEN s.o_orderkey IS NULL THEN 'extra' ELSE 'mismatch' END AS status,
    CASE WHEN s.o_orderkey IS NULL THEN 0 ELSE 1 END::BIGINT AS source_rows, CASE WHEN t.o_orderkey IS NULL THEN 0 ELSE 1 END::BIGINT AS target_rows,
    CASE WHEN s.o_orderkey IS NOT NULL AND t.o_orderkey IS NOT NULL THEN concat_ws(',',
      CASE WHEN s.o_custkey IS DISTINCT FROM t.o_custkey THEN 'o_custkey' END,
      CASE WHEN s.o_orderstatus IS DISTINCT FROM t.o_orderstatus THEN 'o_orderstatus' END,
      CASE WHEN s.o_orderpriority IS DISTINCT FROM t.o_orderpriority THEN 'o_orderpriority' END) END AS columns
  FROM orders s FULL JOIN target t ON s.o_orderkey = t.o_orderkey
  WHERE s.o_orderkey IS NULL OR t.o_orderkey IS NULL OR s.o_custkey IS DISTINCT FROM t.o_custkey
    OR s.o_orderstatus IS DISTINCT FROM t.o_orderstatus OR s.o_orderpriority IS DISTINCT FROM t.o_orderpriority"""
_COLUMNS = ["o_custkey", "o_orderstatus", "o_orderpriority"]


@CATALOG.add("v1_count_comparison", f"""WITH {_TARGET_SQL}, c AS (SELECT 'customer' AS table_name, (SELECT count(*) FROM customer) AS source_count,
    (SELECT count(*) FROM customer WHERE c_acctbal >= 0) AS target_count UNION ALL
  SELECT 'orders', (SELECT count(*) FROM orders), (SELECT count(*) FROM target) UNION ALL SELECT 'lineitem', (SELECT count(*) FROM lineitem), 0)
SELECT *, source_count - target_count AS delta FROM c""")
def count_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = {t: given.table(spark, sf_dir, t) for t in ("customer", "orders", "lineitem")}
    return v.compare_counts(source, {"customer": source["customer"].filter("c_acctbal >= 0"), "orders": _target_orders(spark, sf_dir)})


def _digest_sql(columns: str) -> str:
    return f"sum(('0x' || substr(md5(concat_ws(chr(31), {columns})), 1, 15))::BIGINT)::VARCHAR"


def _text_sql(column: str) -> str:
    return f"coalesce(replace(replace({column}, '\\', '\\\\'), chr(31), '\\s'), '\\N')"


_LINE_COLUMNS = f"l_orderkey, l_linenumber, l_partkey, l_quantity::BIGINT, round(l_extendedprice * 100)::BIGINT, {_text_sql('l_returnflag')}, epoch_us(l_shipdate)"


@CATALOG.add("v2_table_checksum", f"SELECT count(*) AS row_count, {_digest_sql(_LINE_COLUMNS)} AS checksum FROM lineitem")
def table_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.checksum(given.table(spark, sf_dir, "lineitem"), _line_columns())


@CATALOG.add("v2_checksum_by_part", f"SELECT l_returnflag, count(*) AS row_count, {_digest_sql(_LINE_COLUMNS)} AS checksum FROM lineitem GROUP BY l_returnflag")
def checksum_by_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One checksum per part of the table narrows down where two sides differ."""
    return v.checksum(given.table(spark, sf_dir, "lineitem"), _line_columns(), by=["l_returnflag"])


def _line_columns() -> list[str | Column]:
    return [
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").cast("bigint"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint"), "l_returnflag", given.micros("l_shipdate"),
    ]


_ORDER_DIGEST = _digest_sql(f"o_orderkey, o_custkey, {_text_sql('o_orderstatus')}, {_text_sql('o_orderpriority')}")


@CATALOG.add("v2_checksum_comparison", f"""WITH {_TARGET_SQL}, s AS (SELECT count(*) AS source_rows, {_ORDER_DIGEST} AS source_checksum FROM orders),
  t AS (SELECT count(*) AS target_rows, {_ORDER_DIGEST} AS target_checksum FROM target)
SELECT *, source_rows = target_rows AND source_checksum = target_checksum AS matches FROM s, t""")
def checksum_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.compare_checksums(given.table(spark, sf_dir, "orders"), _target_orders(spark, sf_dir), ["o_orderkey", *_COLUMNS])


@CATALOG.add("v3_row_differences", f"WITH {_TARGET_SQL} {_DIFF_SQL}")
def row_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.diff_rows(given.table(spark, sf_dir, "orders"), _target_orders(spark, sf_dir), ["o_orderkey"], _COLUMNS)


@CATALOG.add("v4_sample_differences", f"""WITH {_TARGET_SQL}, d AS ({_DIFF_SQL})
SELECT * FROM d WHERE ('0x' || substr(md5(o_orderkey::VARCHAR), 1, 2))::INTEGER < 64""")
def sample_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.diff_sample(given.table(spark, sf_dir, "orders"), _target_orders(spark, sf_dir), ["o_orderkey"], _COLUMNS, per_256=64)


@CATALOG.add("m1_consumer_lag", f"""WITH {CHANGES_SQL}, ends AS (SELECT topic, "partition", min("offset") AS first_offset, max("offset") AS latest_offset FROM changes GROUP BY ALL),
  done AS (SELECT "partition", max("offset") AS committed_offset FROM changes WHERE kafka_timestamp < TIMESTAMP '2024-01-20' AND "partition" < 3 GROUP BY ALL)
SELECT topic, ends."partition", latest_offset, committed_offset, latest_offset - coalesce(committed_offset, first_offset - 1) AS lag
FROM ends LEFT JOIN done ON ends."partition" = done."partition\"""")
def consumer_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = given.changes(spark, sf_dir)
    done = records.filter((F.col("kafka_timestamp") < F.lit("2024-01-20").cast("timestamp")) & (F.col("partition") < 3))
    return v.consumer_lag(records, done.groupBy("topic", "partition").agg(F.max("offset").alias("committed_offset")))


@CATALOG.add("m1_hourly_growth", f"""WITH {CHANGES_SQL} SELECT date_trunc('hour', kafka_timestamp) AS hour, "partition",
  max("offset") - min("offset") + 1 AS grown_by, count(*) AS messages FROM changes GROUP BY ALL""")
def hourly_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far each partition's end moves per hour, which is what a stopped consumer would lag."""
    hour = F.date_trunc("hour", "kafka_timestamp")
    return given.changes(spark, sf_dir).groupBy(hour.alias("hour"), "partition").agg(
        (F.max("offset") - F.min("offset") + 1).alias("grown_by"), F.count("*").alias("messages")
    )


@CATALOG.add("m2_replication_lag", """SELECT event_id, CASE WHEN event_type <> 'error' THEN event_id * 8 - user_id END AS lag_bytes FROM events""")
def replication_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    slots = given.table(spark, sf_dir, "events").select(
        "event_id", (F.col("event_id") * 8).alias("current_lsn"),
        F.when(F.col("event_type") != "error", F.col("user_id")).alias("confirmed_flush_lsn"),
    )
    return v.replication_lag(slots).select("event_id", "lag_bytes")


# Events as lag samples: an error stands for a lagging one.
_SAMPLES_SQL = """samples AS (SELECT user_id, event_id, epoch_us(ts) // 1000000 AS second, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS lag FROM events)"""


def _samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given.table(spark, sf_dir, "events").select(
        "user_id", "event_id", F.expr("unix_micros(cast(ts as timestamp)) div 1000000").alias("second"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("lag"),
    )


@CATALOG.add("m3_quiet_stretches", f"""WITH {_SAMPLES_SQL}, n AS (SELECT *, sum(lag) OVER (PARTITION BY user_id ORDER BY second, event_id ROWS UNBOUNDED PRECEDING) AS stretch FROM samples)
SELECT user_id, min(second) AS quiet_from, max(second) AS quiet_to, count(*) AS samples, max(second) - min(second) AS quiet_seconds FROM n WHERE lag = 0
GROUP BY user_id, stretch HAVING max(second) - min(second) >= 86400""")
def quiet_stretches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stretches of at least a day without lag."""
    stretches = v.quiet_stretches(_samples(spark, sf_dir), ["user_id"], "second", "event_id", F.col("lag"))
    return stretches.filter(F.col("quiet_seconds") >= 86400)


_READY_SQL = """busy AS (SELECT user_id, max(second) FILTER (lag > 0) AS b, max(second) AS last_sample FROM samples GROUP BY user_id),
  since AS (SELECT s.user_id, min(second) AS zero_since FROM samples s JOIN busy USING (user_id) WHERE b IS NULL OR s.second > b GROUP BY s.user_id),
  ready AS (SELECT busy.user_id, last_sample, zero_since, zero_since IS NOT NULL AND last_sample - zero_since >= 60 AS ready FROM busy LEFT JOIN since USING (user_id))"""


@CATALOG.add("m3_ready_per_source", f"WITH {_SAMPLES_SQL}, {_READY_SQL} SELECT * FROM ready")
def ready_per_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.ready_to_cut_over(_samples(spark, sf_dir), ["user_id"], "second", F.col("lag"))


@CATALOG.add("m4_cutover_gate", f"""WITH {_SAMPLES_SQL}, {_READY_SQL}, {_TARGET_SQL}, g AS (SELECT
  (SELECT bool_and(ready) FROM ready) AS lag_is_zero, (SELECT count(*) FROM orders) = (SELECT count(*) FROM target) AS counts_match,
  (SELECT {_ORDER_DIGEST} FROM orders) = (SELECT {_ORDER_DIGEST} FROM target) AS checksums_match)
SELECT *, lag_is_zero AND counts_match AND checksums_match AS ready_to_cut_over FROM g""")
def cutover_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, target = given.table(spark, sf_dir, "orders"), _target_orders(spark, sf_dir)
    ready = v.ready_to_cut_over(_samples(spark, sf_dir), ["user_id"], "second", F.col("lag"))
    counts = v.compare_counts({"orders": orders}, {"orders": target})
    sums = v.compare_checksums(orders, target, ["o_orderkey", *_COLUMNS])
    return v.cutover_gate(
        lag_is_zero=ready.select("ready"), counts_match=counts.select(F.col("delta") == 0), checksums_match=sums.select("matches")
    )


@CATALOG.add("m4_gate_after_reload", f"""WITH g AS (SELECT
  (SELECT max(epoch_us(o_orderdate)) - min(epoch_us(o_orderdate)) >= 60000000 FROM orders) AS lag_is_zero, (SELECT count(*) FROM orders) = (SELECT count(DISTINCT o_orderkey) FROM orders) AS counts_match,
  (SELECT {_ORDER_DIGEST} FROM orders) = (SELECT {_ORDER_DIGEST} FROM (SELECT DISTINCT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders)) AS checksums_match)
SELECT *, lag_is_zero AND counts_match AND checksums_match AS ready_to_cut_over FROM g""")
def gate_after_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders loaded into a target twice over and caught up: every condition holds."""
    orders = given.table(spark, sf_dir, "orders").select(
        "o_orderkey", *_COLUMNS, F.expr("unix_micros(cast(o_orderdate as timestamp)) div 1000000").alias("second")
    )
    changes = orders.withColumns({"operation": F.lit("c"), "cdc_timestamp_ms": F.lit(0), "offset": F.col("o_orderkey")})
    state = apply_changes(apply_changes(None, changes, ["o_orderkey"]), changes, ["o_orderkey"])
    target = live(state).select(*orders.columns)
    # At each second, the orders of it that the source has and the target has not.
    there = target.groupBy("second").agg(F.count("*").alias("done"))
    samples = orders.groupBy("second").agg(F.count("*").alias("end")).join(there, "second", "left").withColumn("topic", F.lit("orders"))
    lag = F.col("end") - F.coalesce("done", F.lit(0))
    ready = v.ready_to_cut_over(samples, ["topic"], "second", lag)
    counts = v.compare_counts({"orders": orders}, {"orders": target})
    sums = v.compare_checksums(orders, target, ["o_orderkey", *_COLUMNS])
    return v.cutover_gate(
        lag_is_zero=ready.select("ready"), counts_match=counts.select(F.col("delta") == 0), checksums_match=sums.select("matches")
    )
