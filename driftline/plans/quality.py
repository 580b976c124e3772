"""Queries: constraint checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.operators import quality as q
from driftline.plans import given
from driftline.plans.history import order_statuses
from driftline.plans.registry import Catalog
from driftline.schemas import SOURCE_ORDER_STATUS, STATUS_TRANSITIONS, TARGET_EVENT_TYPES, TARGET_ORDER_STATUS

CATALOG = Catalog()


def _violations(df: DataFrame, key: Sequence[str], *rules: q.Rule) -> DataFrame:
    return q.violations(df, key, rules)


@CATALOG.add("q1_primary_key", """SELECT 'primary key l_orderkey, l_linenumber' AS rule, l_orderkey || ',' || l_linenumber AS key, count(*)::VARCHAR AS value
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def primary_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = given.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return _violations(lines, ["l_orderkey", "l_linenumber"], q.primary_key("l_orderkey", "l_linenumber"))


@CATALOG.add("q1_missing_key", """WITH k AS (SELECT CASE WHEN event_id % 100 = 3 THEN NULL ELSE event_id // 2 END AS id FROM events)
SELECT 'primary key id' AS rule, coalesce(id::VARCHAR, 'null') AS key, count(*)::VARCHAR AS value FROM k GROUP BY id HAVING count(*) > 1 OR id IS NULL""")
def missing_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("event_id")
    ids = given.table(spark, sf_dir, "events").select(F.when(F.pmod(number, F.lit(100)) != 3, F.expr("event_id div 2")).alias("id"))
    return _violations(ids, ["id"], q.primary_key("id"))


@CATALOG.add("q2_unique", """WITH e AS (SELECT CASE WHEN user_id % 2 = 0 THEN event_type || user_id END AS email FROM events)
SELECT 'unique email' AS rule, email AS key, count(*)::VARCHAR AS value FROM e WHERE email IS NOT NULL GROUP BY email HAVING count(*) > 1""")
def unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    email = F.when(F.pmod("user_id", F.lit(2)) == 0, F.concat("event_type", "user_id"))
    return _violations(given.table(spark, sf_dir, "events").select(email.alias("email")), ["email"], q.unique("email"))


@CATALOG.add("q3_not_null", """SELECT 'phone not null' AS rule, event_id::VARCHAR AS key, CAST(NULL AS VARCHAR) AS value FROM events WHERE event_type = 'error'""")
def not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = given.table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_type") != "error", F.col("props")).alias("phone"))
    return _violations(rows, ["event_id"], q.not_null("phone"))


@CATALOG.add("q4_foreign_key", """SELECT 'o_custkey references c_custkey' AS rule, o_orderkey::VARCHAR AS key, o_custkey::VARCHAR AS value FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')""")
def foreign_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders against a target that lacks one segment of customers."""
    loaded = given.table(spark, sf_dir, "customer").filter("c_mktsegment <> 'BUILDING'")
    orders = given.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return _violations(orders, ["o_orderkey"], q.references("o_custkey", loaded, "c_custkey"))


_STATUS_SQL = """s AS (SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'pending' WHEN '2-HIGH' THEN 'confirmed' WHEN '3-MEDIUM' THEN 'shipped'
  WHEN '4-NOT SPECIFIED' THEN 'delivered' ELSE 'cancelled' END AS status FROM orders)"""


@CATALOG.add("q5_source_status_in_target", f"""WITH {_STATUS_SQL} SELECT 'status allowed' AS rule, o_orderkey::VARCHAR AS key, status AS value FROM s
WHERE status NOT IN ('pending', 'processing', 'completed', 'cancelled', 'refunded')""")
def source_status_in_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which orders a faithful load would get rejected: the two sides' status sets differ."""
    rows = order_statuses(spark, sf_dir).select("o_orderkey", "status")
    return _violations(rows, ["o_orderkey"], q.allowed("status", TARGET_ORDER_STATUS))


@CATALOG.add("q5_allowed_values", """SELECT rule, key, value FROM (
  SELECT 'event_type allowed' AS rule, event_id::VARCHAR AS key, event_type AS value FROM events WHERE event_type NOT IN ('login', 'logout', 'purchase', 'view', 'cart_add', 'cart_remove')
  UNION ALL SELECT 'status allowed', event_id::VARCHAR, 'lost' FROM events WHERE event_id % 50 = 0)""")
def allowed_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two value rules in one pass; null statuses pass."""
    case = F.pmod("event_id", F.lit(50))
    status = F.when(case == 0, "lost").when(case == 1, None).otherwise("shipped")
    rows = given.table(spark, sf_dir, "events").select("event_id", "event_type", status.alias("status"))
    return _violations(rows, ["event_id"], q.allowed("event_type", TARGET_EVENT_TYPES), q.allowed("status", SOURCE_ORDER_STATUS))


@CATALOG.add("q5_forbidden_transitions", f"""WITH steps AS (
  SELECT o.o_custkey, o.o_orderkey, status, lag(status) OVER (PARTITION BY o.o_custkey ORDER BY epoch_us(o_orderdate) // 1000, o.o_orderkey) AS previous_status
  FROM orders o JOIN (WITH {_STATUS_SQL} SELECT * FROM s) x ON o.o_orderkey = x.o_orderkey)
SELECT o_orderkey, previous_status, status FROM steps WHERE previous_status <> status
  AND (previous_status || '>' || status) NOT IN ('pending>confirmed', 'pending>cancelled', 'confirmed>shipped', 'confirmed>cancelled', 'shipped>delivered')""")
def forbidden_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = q.status_changes(order_statuses(spark, sf_dir), ["o_custkey"], ["ms", "o_orderkey"], "status", STATUS_TRANSITIONS)
    return steps.filter(~F.col("is_allowed")).select("o_orderkey", "previous_status", "status")


@CATALOG.add("q6_length_limits", """SELECT 'text length <= 2000' AS rule, doc_id::VARCHAR AS key, text AS value FROM documents WHERE length(text) > 2000""")
def length_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _violations(given.table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"], q.at_most("text", 2000))


@CATALOG.add("q7_ranges", "SELECT 'c_acctbal >= 0' AS rule, c_custkey::VARCHAR AS key, round(c_acctbal * 100)::BIGINT AS cents FROM customer WHERE c_acctbal < 0")
def ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _violations(given.table(spark, sf_dir, "customer"), ["c_custkey"], q.at_least("c_acctbal", 0))
    return found.select("rule", "key", F.round(F.col("value").cast("double") * 100).cast("bigint").alias("cents"))


@CATALOG.add("q7_quantity_above_zero", """SELECT 'quantity > 0' AS rule, l_orderkey || ',' || l_linenumber AS key, (l_quantity::INTEGER - 10)::VARCHAR AS value
FROM lineitem WHERE l_quantity::INTEGER - 10 <= 0""")
def quantity_above_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = given.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_quantity").cast("int") - 10).alias("quantity"))
    return _violations(lines, ["l_orderkey", "l_linenumber"], q.above("quantity", 0))


def _emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    email = (
        F.when(kind == "view", F.concat(F.lit("User."), "user_id", F.lit("+a@Mail-1.example.COM")))
        .when(kind == "click", F.concat("user_id", F.lit("@nodot")))
        .when(kind == "error", F.concat("user_id", F.lit(" @example.com")))
        .when(kind == "purchase", F.concat("user_id", F.lit("@example.c")))
    )
    return given.table(spark, sf_dir, "events").select("event_id", email.alias("email"))


_EMAIL_SQL = """e AS (SELECT event_id, CASE event_type WHEN 'view' THEN 'User.' || user_id || '+a@Mail-1.example.COM' WHEN 'click' THEN user_id || '@nodot'
  WHEN 'error' THEN user_id || ' @example.com' WHEN 'purchase' THEN user_id || '@example.c' END AS email FROM events),
  bad AS (SELECT event_id, email FROM e WHERE NOT regexp_full_match(email, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}', 'i'))"""


@CATALOG.add("q9_email_shape", f"WITH {_EMAIL_SQL} SELECT 'email is an email' AS rule, event_id::VARCHAR AS key, email AS value FROM bad")
def email_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _violations(_emails(spark, sf_dir), ["event_id"], q.email_shape("email"))


@CATALOG.add("q_rule_summary", f"""WITH {_EMAIL_SQL}, n(rule, violations) AS (
  SELECT 'email is an email', (SELECT count(*) FROM bad) UNION ALL SELECT 'email length <= 255', 0 UNION ALL
  SELECT 'email not null', (SELECT count(*) FROM e WHERE email IS NULL) UNION ALL SELECT 'primary key event_id', 0)
SELECT rule, violations, violations = 0 AS passed FROM n""")
def rule_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [q.email_shape("email"), q.at_most("email", 255), q.not_null("email"), q.primary_key("event_id")]
    return q.rule_summary(_emails(spark, sf_dir), ["event_id"], rules)
