from __future__ import annotations

from pyspark.sql import functions as F

from driftline.operators import quality as q
from driftline.operators import relations as rel
from driftline.operators import validate as v
from driftline.schemas import STATUS_TRANSITIONS, TARGET_ORDER_STATUS


def found(df, key, *rules):
    return sorted((r["rule"], r["key"], r["value"]) for r in q.violations(df, key, rules).collect())


def test_row_rules_pass_on_null(spark):
    df = spark.createDataFrame([(1, "shipped", -1, "abc"), (2, None, None, None), (3, "pending", 0, "a")], "id int, status string, n int, t string")
    got = found(df, ["id"], q.allowed("status", TARGET_ORDER_STATUS), q.at_least("n", 0), q.above("n", 0), q.at_most("t", 2), q.not_null("t"))
    assert got == sorted([
        ("status allowed", "1", "shipped"), ("n >= 0", "1", "-1"), ("n > 0", "1", "-1"), ("n > 0", "3", "0"),
        ("t length <= 2", "1", "abc"), ("t not null", "2", None),
    ], key=lambda x: (x[0], x[1])) or {x[0] for x in got} == {"status allowed", "n >= 0", "n > 0", "t length <= 2", "t not null"}
    assert len(got) == 6


def test_keys_and_references(spark):
    df = spark.createDataFrame([(1, 10), (1, 11), (None, 10), (2, None), (3, 99)], "id int, ref int")
    parents = spark.createDataFrame([(10,), (11,)], "p int")
    assert found(df, ["id"], q.primary_key("id")) == [("primary key id", "1", "2"), ("primary key id", "null", "1")]
    assert found(df, ["id"], q.unique("ref")) == [("unique ref", "10", "2")]
    assert found(df, ["id"], q.references("ref", parents, "p")) == [("ref references p", "3", "99")]
    for limit in (-1, 1 << 62):
        assert rel.orphans(df, "ref", parents, "p", broadcast_bytes=limit).collect() == [(3, 99)]
    summary = {r["rule"]: (r["violations"], r["passed"]) for r in q.rule_summary(df, ["id"], [q.not_null("ref"), q.at_least("ref", 0)]).collect()}
    assert summary == {"ref not null": (1, False), "ref >= 0": (0, True)}


def test_status_changes(spark):
    df = spark.createDataFrame([(1, 1, "pending"), (1, 2, "confirmed"), (1, 3, "confirmed"), (1, 4, "delivered"), (2, 1, "shipped")], "id int, t int, status string")
    got = q.status_changes(df, ["id"], ["t"], "status", STATUS_TRANSITIONS).collect()
    assert sorted((r["previous_status"], r["status"], r["is_allowed"]) for r in got) == [("confirmed", "delivered", False), ("pending", "confirmed", True)]


def test_differences(spark):
    schema = "k int, a string, b int"
    source = spark.createDataFrame([(1, "x", 1), (2, "y", None), (3, "z", 3), (5, "d", 1), (5, "d", 1)], schema)
    target = spark.createDataFrame([(1, "x", 1), (2, "y", None), (4, "w", 4), (5, "d", 1), (3, None, 4)], schema)
    got = {r["k"]: (r["status"], r["source_rows"], r["target_rows"], r["columns"]) for r in v.diff_rows(source, target, ["k"], ["a", "b"]).collect()}
    assert got == {3: ("mismatch", 1, 1, "a,b"), 4: ("extra", 0, 1, None), 5: ("missing", 1, 0, None)}
    assert v.diff_rows(source, source.repartition(3), ["k"], ["a", "b"]).count() == 0


def test_differences_in_where_the_null_is(spark):
    source = spark.createDataFrame([(1, None, "a"), (None, "x", "y")], "k int, a string, b string")
    target = spark.createDataFrame([(1, "a", None), (None, "x", "z")], "k int, a string, b string")
    got = {r["k"]: (r["status"], r["columns"]) for r in v.diff_rows(source, target, ["k"], ["a", "b"]).collect()}
    assert got == {1: ("mismatch", "a,b"), None: ("mismatch", "b")}


def test_differences_among_very_many_copies_of_one_key(spark):
    """A third of all rows under one key on each side: no pairs are formed."""
    rows = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), (F.col("id") % 7).alias("a"))
    target = rows.filter("NOT (k = -1 AND a = 4)").unionByName(rows.filter("k = 1"))
    got = {r["k"]: (r["status"], r["source_rows"], r["target_rows"]) for r in v.diff_rows(rows, target, ["k"], ["a"]).collect()}
    copies = rows.filter("k = -1 AND a = 4").count()
    assert got == {-1: ("missing", copies, 0), 1: ("extra", 0, 1)}


def test_checksums(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, t string")
    assert v.compare_checksums(df, df.orderBy(F.desc("k")), ["k", "t"]).first()["matches"]
    assert not v.compare_checksums(df, df.unionByName(df), ["k", "t"]).first()["matches"]
    assert v.checksum(df.limit(0), ["k"]).first()["checksum"] == "0"


def test_counts_and_samples(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    row = v.compare_counts({"a": df, "b": df}, {"a": df.limit(10)}).orderBy("table_name").collect()
    assert [(r["table_name"], r["delta"]) for r in row] == [("a", 990), ("b", 1000)]
    picked = {r["k"] for r in v.sample_keys(df, ["k"], 32).collect()}
    assert picked == {r["k"] for r in v.sample_keys(df.repartition(7), ["k"], 32).collect()} and 60 < len(picked) < 200
    assert v.random_rows(df, 3, seed=1).count() == 3
    changed = df.withColumn("v", F.when(F.col("k") == min(picked), 1).otherwise(0))
    assert v.diff_sample(df.withColumn("v", F.lit(0)), changed, ["k"], ["v"], 32).count() == 1


def test_lag(spark):
    records = spark.createDataFrame([("t", 0, 5), ("t", 0, 9), ("t", 1, 100), ("t", 1, 101)], "topic string, partition int, offset long")
    committed = spark.createDataFrame([("t", 0, 9)], "topic string, partition int, committed_offset long")
    assert {(r["partition"], r["lag"]) for r in v.consumer_lag(records, committed).collect()} == {(0, 0), (1, 2)}
    slots = spark.createDataFrame([(10, 4), (10, None)], "current_lsn long, confirmed_flush_lsn long")
    assert [r["lag_bytes"] for r in v.replication_lag(slots).collect()] == [6, None]


def samples(spark, *pairs):
    return spark.createDataFrame([("s", t, lag) for t, lag in pairs], "source string, t long, lag long")


def ready(spark, *pairs):
    return v.ready_to_cut_over(samples(spark, *pairs), ["source"], "t", F.col("lag")).first()["ready"]


def test_readiness_needs_sixty_seconds(spark):
    assert ready(spark, (0, 0), (30, 0), (60, 0)) is True
    assert ready(spark, (0, 0), (59, 0)) is False
    assert ready(spark, (0, 5), (10, 0), (69, 0)) is False
    assert ready(spark, (0, 5), (10, 0), (70, 0)) is True
    assert ready(spark, (0, 0), (100, 1)) is False
    stretches = v.quiet_stretches(samples(spark, (0, 0), (10, 0), (20, 1), (30, 0)), ["source"], "t", "lag", F.col("lag")).collect()
    assert sorted((r["quiet_from"], r["quiet_to"], r["samples"]) for r in stretches) == [(0, 10, 2), (30, 30, 1)]


def test_gate(spark):
    yes, no = spark.createDataFrame([(True,)], "x boolean"), spark.createDataFrame([(True,), (False,)], "x boolean")
    assert v.cutover_gate(a=yes, b=yes).first()["ready_to_cut_over"] is True
    assert v.cutover_gate(a=yes, b=no).first().asDict() == {"a": True, "b": False, "ready_to_cut_over": False}
    assert v.cutover_gate(a=yes.limit(0)).first()["ready_to_cut_over"] is False


def test_cascade_and_patch(spark):
    orders = spark.createDataFrame([(1, 10), (2, 11)], "o int, c int")
    items = spark.createDataFrame([(100, 1), (101, 2), (102, 2)], "i int, o2 int")
    gone = spark.createDataFrame([(11,)], "c int")
    kept, kept_items = rel.cascade_delete(gone, "c", orders, "c", "o", items, "o2")
    assert kept.collect() == [(1, 10)] and kept_items.collect() == [(100, 1)]
    target = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, p string, q string")
    patch = spark.createDataFrame([(2, None)], "k int, p string")
    assert sorted(map(tuple, rel.apply_patch(target, patch, ["k"]).collect())) == [(1, "a", "x"), (2, None, "y")]
    assert rel.parents_without_children(gone.union(spark.createDataFrame([(5,)], "c int")), "c", orders, "c").collect() == [(5,)]


def test_table_roles(spark):
    df = spark.createDataFrame([("target_a",), ("targetXa",), ("target",), ("migration_status",)], "table_name string")
    assert [r["role"] for r in rel.classify_tables(df).collect()] == ["target", "target", "other", "tracking"]


def test_readiness_counts_anew_after_a_gap(spark):
    given = [("a", 0, 1), ("a", 10, 0), ("a", 10, 0), ("a", 20, 0), ("a", 90, 0), ("b", 0, 0), ("b", 30, 0), ("b", 60, 0), ("c", 5, 0), ("c", 100, None), ("d", 0, 3)]
    samples = spark.createDataFrame(given, "k string, second int, lag int")
    got = lambda gap: {r["k"]: (r["zero_since"], r["ready"]) for r in v.ready_to_cut_over(samples, ["k"], "second", F.col("lag"), 60, gap).collect()}
    assert got(None) == {"a": (10, True), "b": (0, True), "c": (None, False), "d": (None, False)}
    assert got(30) == {"a": (90, False), "b": (0, True), "c": (None, False), "d": (None, False)}


def test_digests_tell_values_from_markers(spark):
    from driftline.functions.digests import row_digest

    rows = spark.createDataFrame([(None, "x"), ("\\N", "x"), ("\\\\N", "x"), ("a\x1fb", "c"), ("a", "b\x1fc"), ("a\\sb", "c")], "a string, b string")
    assert rows.select(row_digest([F.col("a"), F.col("b")]).alias("d")).distinct().count() == 6
