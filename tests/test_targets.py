from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from driftline.operators import targets as t
from driftline.operators.bronze import batch_log, read_bronze, stamp, unseen, write_batch

SCHEMA = "id int, name string, operation string, cdc_timestamp_ms long, offset long"


def rows(spark, *values):
    return spark.createDataFrame(values, SCHEMA)


def names(state):
    return {r["id"]: r["name"] for r in t.live(state).collect()}


@pytest.mark.parametrize("limit", [64 << 20, -1], ids=["broadcast", "ranked"])
def test_order_of_arrival_does_not_matter(spark, limit):
    state = rows(spark, (1, "new", "u", 20, 5), (2, None, "d", 20, 6), (3, "same", "u", 20, 7))
    late = rows(spark, (1, "old", "u", 10, 1), (2, "revived", "u", 10, 2), (3, "same", "u", 20, 7), (4, "fresh", "c", 1, 3), (4, "fresher", "u", 1, 4))
    once = t.apply_changes(state, late, ["id"], broadcast_bytes=limit)
    assert names(once) == {1: "new", 3: "same", 4: "fresher"}
    again = t.apply_changes(once, late, ["id"], broadcast_bytes=limit)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, once.collect()))
    newer = rows(spark, (1, None, "d", 30, 8), (2, "back", "c", 30, 9))
    assert names(t.apply_changes(again, newer, ["id"], broadcast_bytes=limit)) == {2: "back", 3: "same", 4: "fresher"}


def test_broadcast_form_reads_the_state_without_a_shuffle(spark, tmp_path):
    rows(spark, (1, "a", "c", 1, 1)).write.parquet(str(tmp_path / "s"))
    rows(spark, (2, "b", "c", 2, 2)).write.parquet(str(tmp_path / "c"))
    state, changes = spark.read.parquet(str(tmp_path / "s")), spark.read.parquet(str(tmp_path / "c"))
    kept = t.apply_changes(state, changes, ["id"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 2 and "SortMergeJoin" not in plan
    assert "BroadcastHashJoin" not in t.apply_changes(state, changes, ["id"], broadcast_bytes=1)._jdf.queryExecution().executedPlan().toString()


def test_target_table(spark, tmp_path):
    table = t.TargetTable(spark, str(tmp_path / "target"), ("id",))
    assert table.read() is None
    table.apply_batch(rows(spark, (1, "a", "c", 1, 1), (1, "b", "u", 2, 2), (2, "x", "c", 1, 3)), 0, "s1")
    table.apply_batch(rows(spark, (2, None, "d", 5, 4)), 1, "s1")
    assert names(table.state()) == {1: "b"}
    table.compact()
    table.compact()
    assert names(table.state()) == {1: "b"} and table._pending(table.base.manifest()) == []
    # A repeated batch and a late change after folding, then a stream that starts over.
    table.apply_batch(rows(spark, (2, None, "d", 5, 4)), 1, "s1")
    table.apply_batch(rows(spark, (2, "late", "u", 3, 5)), 2, "s1")
    table.apply_batch(rows(spark, (3, "other", "c", 1, 1)), 0, "s2")
    assert names(table.read()) == {1: "b", 3: "other"}
    table.compact()
    assert names(table.read()) == {1: "b", 3: "other"}
    table.expire()
    assert names(table.read()) == {1: "b", 3: "other"}
    held = {f"v={v}" for v in table.base.manifest().versions.values()}
    assert {p.name for p in (tmp_path / "target" / "base" / "data").iterdir()} == held
    assert [p.name for p in (tmp_path / "target" / "base" / "manifest").iterdir() if not p.name.startswith(".")] == ["v=2.json"]
    assert list((tmp_path / "target" / "delta").iterdir()) == []
    table.apply_batch(rows(spark, (3, None, "d", 9, 9)), 1, "s2")
    assert names(table.read()) == {1: "b"}
    # A number used before, with other changes.
    table.apply_batch(rows(spark, (8, "h", "c", 9, 9)), 0, "s1")
    table.compact()
    assert names(table.read()) == {1: "b", 8: "h"}


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    table = t.TargetTable(spark, str(tmp_path / "target"), ("id",), buckets=8)
    table.apply_batch(rows(spark, *[(i, f"n{i}", "c", 1, i) for i in range(200)]), 0)
    table.compact()

    def files():
        return {str(p.relative_to(tmp_path)): p.stat().st_mtime_ns for p in (tmp_path / "target" / "base" / "data").rglob("*.parquet")}

    before, first = files(), table.base.manifest()
    assert set(first.versions) == set(range(8)) and set(first.versions.values()) == {1}
    table.apply_batch(rows(spark, (3, "changed", "u", 2, 300)), 1)
    table.compact()
    second = table.base.manifest()
    [touched] = [k for k, v in second.versions.items() if v == 2]
    assert {k: v for k, v in second.versions.items() if k != touched} == {k: 1 for k in range(8) if k != touched}
    after = files()
    assert all(after[f] == at for f, at in before.items()) and all(f"v=2/_bucket={touched}/" in f for f in set(after) - set(before))
    # A reader that began before sees the old rows, and the new table only what its manifest names.
    assert table.base.read(first).filter("id = 3").first()["name"] == "n3"
    assert names(table.read()) == {i: f"n{i}" for i in range(200)} | {3: "changed"}
    table.expire()
    kept = files()
    assert names(table.read())[3] == "changed" and not any(f"v=1/_bucket={touched}/" in f for f in kept) and len(kept) < len(after)
    # A bucket whose last row goes is no longer named; an unfinished write is not seen.
    gone = [r["id"] for r in table.base.read(second, [touched]).select("id").collect()]
    table.apply_batch(rows(spark, *[(i, None, "d", 5, 500) for i in gone]), 2)
    table.compact(forget_before=100)
    assert touched not in table.base.manifest().versions and len(names(table.read())) == 200 - len(gone)
    (tmp_path / "target" / "base" / "manifest" / "v=9.json.draft").write_text("{")
    assert len(names(table.read())) == 200 - len(gone)


def test_columns_that_come_later_are_kept(spark, tmp_path):
    table = t.TargetTable(spark, str(tmp_path / "target"), ("id",))
    table.apply_batch(rows(spark, (1, "a", "c", 1, 1), (2, "b", "c", 1, 2)), 0)
    table.compact()
    with_phone = rows(spark, (2, "c", "u", 2, 3)).withColumn("phone", F.lit("123"))
    table.apply_batch(with_phone, 1)
    table.apply_batch(rows(spark, (3, "d", "c", 3, 4)), 2)
    expected = {1: None, 2: "123", 3: None}
    assert {r["id"]: r["phone"] for r in table.read().collect()} == expected
    table.compact()
    table.expire()
    table.apply_batch(with_phone.withColumn("id", F.lit(4)), 3)
    table.apply_batch(rows(spark, (5, "e", "c", 3, 4)), 4)
    assert {r["id"]: r["phone"] for r in table.read().collect()} == expected | {4: "123", 5: None}


def test_names_and_deleted_keys_are_forgotten(spark, tmp_path):
    table = t.TargetTable(spark, str(tmp_path / "target"), ("id",))
    for n in range(3):
        table.apply_batch(rows(spark, (n, "a", "c", n, n), (10 + n, None, "d", n, n)), n)
        table.compact(forget_before=1)
        table.expire()
    assert table.base.manifest().notes == {"folded": ["batch-2"]}
    assert {r["id"] for r in table.state().collect()} == {0, 1, 2, 11, 12}


@pytest.mark.parametrize("limit", [64 << 20, -1], ids=["broadcast", "ranked"])
def test_equal_order_keeps_the_state(spark, limit):
    state, other = rows(spark, (1, "held", "u", 5, 5)), rows(spark, (1, "offered", "u", 5, 5)).withColumn("more", F.lit(1))
    for parts in (1, 7):
        kept = t.apply_changes(state.repartition(parts), other, ["id"], broadcast_bytes=limit)
        assert [(r["name"], r["more"]) for r in kept.collect()] == [("held", None)]


@pytest.mark.parametrize("limit", [64 << 20, -1], ids=["broadcast", "shuffle"])
def test_insert_or_ignore(spark, limit):
    batch = rows(spark, (1, "second", "c", 2, 2), (1, "first", "c", 1, 1), (2, "taken", "c", 1, 3))
    present = rows(spark, (2, "kept", "c", 0, 0))
    added = t.insert_or_ignore(present, batch, ["id"], ["offset"], limit)
    assert [(r["id"], r["name"]) for r in added.collect()] == [(1, "first")]
    assert t.insert_or_ignore(None, batch, ["id"], ["offset"]).count() == 2


def test_customer_shape_drops_rows_without_key(spark):
    flat = spark.createDataFrame(
        [(1, "a@b.co", "A", None, 1_500_000, 2_000_001, 99), (None, None, None, None, None, None, 1)],
        "customer_id int, email string, full_name string, phone string, created_at long, updated_at long, lsn long",
    )
    [row] = t.shape_customers(flat, F.lit("2024-01-01").cast("timestamp")).collect()
    assert row["created_at"] == datetime(1970, 1, 1, 0, 0, 1, 500000) and row["cdc_lsn"] == "99"
    assert row["source_system"] == "postgres_local" and row["migrated_at"] == datetime(2024, 1, 1)


def test_inventory_and_event_shapes(spark):
    flat = spark.createDataFrame(
        [("c", "m1", "SKU", "W", -3, 5, 1.5, "2024-01-01T00:00:00", "active"), ("u", "m2", "S", "W", 1, 1, 1.0, None, "x"), ("r", "m3", "S", "W", None, None, None, '{"$date": 0}', None)],
        "operation string, mongo_id string, product_id string, warehouse string, quantity int, reorder_point int, unit_cost double, last_updated string, status string",
    )
    got = {r["snapshot_id"]: r for r in t.shape_inventory(flat).collect()}
    assert set(got) == {"m1", "m3"}
    assert got["m1"]["quantity"] == 0 and got["m1"]["snapshot_data"] == '{"reorder_point":5,"unit_cost":1.5,"status":"active"}'
    assert got["m3"]["quantity"] is None and got["m3"]["snapshot_data"] == "{}" and got["m3"]["snapshot_timestamp"] == datetime(1970, 1, 1)


def test_tracking(spark):
    seeds = t.seed_tracking(spark, {"orders": "topic.orders"})
    assert seeds.count() == 5
    batch = spark.createDataFrame([(datetime(2024, 1, 1), 7), (datetime(2024, 1, 2), 5)], "migrated_at timestamp, offset long")
    once = t.update_tracking(seeds, t.load_counts(batch, "target_orders"))
    twice = t.update_tracking(once, t.load_counts(batch.limit(1), "target_orders"))
    row = twice.filter("target_table = 'target_orders'").first()
    assert (row["total_records_migrated"], row["last_migrated_at"], row["last_kafka_offset"], row["kafka_topic"]) == (3, datetime(2024, 1, 2), 7, "topic.orders")
    other = twice.filter("target_table = 'target_customers'").first()
    assert (other["total_records_migrated"], other["last_migrated_at"]) == (0, None)


def test_bronze_batches(spark, tmp_path):
    path = str(tmp_path / "bronze")
    raw = spark.createDataFrame(
        [("t", 0, i, datetime(2024, 1, 1 + i % 3), "c") for i in range(9)],
        "topic string, partition int, offset long, kafka_timestamp timestamp, operation string",
    )
    changes = stamp(raw, run_ts=F.lit("2024-02-01").cast("timestamp"), migration_ts=True)
    write_batch(changes.filter("offset < 4"), path, 0)
    write_batch(changes.filter("offset >= 4"), path, 1, rebalance=True)
    write_batch(changes.filter("offset >= 4"), path, 1)
    bronze = read_bronze(spark, path)
    assert bronze.count() == 9
    log = [tuple(r) for r in batch_log(bronze).orderBy("batch_id").select("operation", "rows_added", "total_rows").collect()]
    assert log == [("append", 4, 4), ("append", 5, 9)]
    assert unseen(changes.unionByName(changes), path, 0).count() == 4
    assert unseen(changes, path, 7).count() == 0
    assert unseen(changes, str(tmp_path / "none"), 0).count() == 9
    assert read_bronze(spark, path, []) is None
    plan = bronze.filter("event_date = '2024-01-02' and batch_id <= 0")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan or "event_date" in plan.split("PartitionFilters")[1][:200]


def test_replaced_batch_leaves_no_stale_days(spark, tmp_path):
    path = str(tmp_path / "bronze")
    raw = spark.createDataFrame(
        [("t", 0, i, datetime(2024, 1, 1 + i) if i < 3 else None, "c") for i in range(4)],
        "topic string, partition int, offset long, kafka_timestamp timestamp, operation string",
    )
    changes = stamp(raw, run_ts=F.lit("2024-02-01").cast("timestamp"))
    write_batch(changes, path, 0)
    assert unseen(changes, path, 1).count() == 0  # a record without a day is found too
    write_batch(changes.filter("offset = 9"), path, 0, stream="other")
    write_batch(changes.filter("offset = 2"), path, 0, stream="other")
    write_batch(changes.filter("offset < 2"), path, 0)
    assert sorted(r["offset"] for r in read_bronze(spark, path).collect()) == [0, 1, 2]
    assert unseen(changes, path, 0, stream="other").count() == 2
