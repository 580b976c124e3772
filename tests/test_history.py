from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from driftline.operators import history as h

SCHEMA = "id int, name string, operation string, cdc_timestamp_ms long, offset long"


def changes(spark, *rows):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], SCHEMA)


def shown(df):
    return [
        (r["id"], r["name"], r["version"], r["is_current"], int(r["f"]), r["t"] if r["t"] is None else int(r["t"]))
        for r in df.select("*", F.unix_millis("valid_from").alias("f"), F.unix_millis("valid_to").alias("t")).orderBy("id", "f", "version").collect()
    ]


def test_insert_update_delete(spark):
    rows = changes(spark, (1, "a", "c", 10), (1, "b", "u", 20), (1, None, "d", 30))
    assert shown(h.scd2(rows, ["id"])) == [(1, "a", 1, False, 10, 20), (1, "b", 2, False, 20, 30)]
    assert h.current_state(h.scd2(rows, ["id"])).count() == 0


def test_delete_then_insert_leaves_a_gap(spark):
    history = h.scd2(changes(spark, (1, "a", "c", 10), (1, None, "d", 20), (1, "b", "c", 30)), ["id"])
    assert shown(history) == [(1, "a", 1, False, 10, 20), (1, "b", 2, True, 30, None)]
    at = lambda ms: [r["name"] for r in h.state_as_of(history, F.timestamp_millis(F.lit(ms))).collect()]
    assert (at(9), at(10), at(19), at(20), at(29), at(30)) == ([], ["a"], ["a"], [], [], ["b"])


def test_ties_are_broken_by_offset(spark):
    history = h.scd2(changes(spark, (1, "first", "u", 10), (1, "second", "u", 10)), ["id"])
    assert [(r["name"], r["is_current"]) for r in history.orderBy("version").collect()] == [("first", False), ("second", True)]


def test_literal_semantics(spark):
    rows = changes(spark, (1, "a", "r", 1500), (1, "b", "u", 2700), (1, None, "d", 9000))
    assert shown(h.scd2(rows, ["id"], semantics="literal")) == [(1, "a", 2, False, 1000, 1000), (1, "b", 1, True, 2000, None)]
    with pytest.raises(ValueError):
        h.scd2(rows, ["id"], semantics="other")


def test_snapshot_of_430_customers_and_three_changes(spark):
    """One create, one update and one delete on top of a snapshot."""
    snapshot = [(i, "n", "r", 1) for i in range(430)]
    rows = changes(spark, *snapshot, (430, "new", "c", 2), (5, "renamed", "u", 3), (6, None, "d", 4))
    assert rows.count() == 433
    literal = h.scd2(rows, ["id"], semantics="literal")
    assert literal.count() == 432 and literal.filter("is_current").count() == 431
    documented = h.scd2(rows, ["id"])
    assert documented.count() == 432 and documented.filter("is_current").count() == 430
    assert [r["id"] for r in h.keys_with_history(documented, ["id"]).collect()] == [5]


def test_refresh_touches_only_the_batch_keys(spark):
    rows = changes(spark, (1, "a", "c", 10), (2, "x", "c", 11), (1, "late", "u", 5), (2, None, "d", 20), (3, "n", "c", 21))
    before = h.scd2(rows.filter("offset < 2"), ["id"])
    batch = rows.filter("offset >= 2")
    assert shown(h.refresh_scd2(before, rows, batch, ["id"])) == shown(h.scd2(rows, ["id"]))


def test_versions_and_storage(spark, tmp_path):
    history = h.scd2(changes(spark, (1, "a", "c", 10), (1, "b", "u", 20), (2, "z", "c", 5)), ["id"])
    assert [r["name"] for r in h.versions_of(history, "id", 1).collect()] == ["b", "a"]
    h.write_history(history, str(tmp_path / "silver"))
    stored = h.read_history(spark, str(tmp_path / "silver"))
    assert shown(stored.select(*history.columns)) == shown(history)
    plan = stored.filter("is_current")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(is_current" in plan or "PartitionFilters: [cast(is_current" in plan


def test_changed_fields(spark):
    rows = spark.createDataFrame([((1, "a"), (1, "b")), (None, (1, None)), ((1, None), None)], "before struct<i:int,n:string>, after struct<i:int,n:string>")
    assert [r["changed_fields"] for r in h.changed_fields(rows, ["i", "n"]).collect()] == [["n"], ["i"], ["i"]]


def test_previous_image(spark):
    rows = changes(spark, (1, "a", "c", 10), (1, "b", "u", 20), (2, "z", "c", 5))
    seen = h.with_previous_image(rows, ["id"], "name").select("name", "before").collect()
    assert set(map(tuple, seen)) == {("a", None), ("b", "a"), ("z", None)}
