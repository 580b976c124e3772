from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from driftline.operators.bronze import read_bronze, stamp
from driftline.operators.targets import TargetTable
from driftline.schemas import KAFKA_RECORD, row_type, INT, TEXT, TIME
from driftline.session import estimated_bytes, shared_dir
from driftline.sources import jdbc, kafka, tables
from driftline.streaming.apply import target_writer
from driftline.streaming.ingest import bronze_writer, run_available
from driftline.streaming.monitor import lag_windows


def test_kafka_options():
    assert kafka.topic_options("h:1", "t") == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "earliest", "endingOffsets": "latest",
    }
    assert "endingOffsets" not in kafka.topic_options("h:1", "t", ending=None)
    more = kafka.topic_options("h:1", "t", min_partitions=64, max_offsets_per_trigger=1000, fail_on_data_loss=False)
    assert (more["minPartitions"], more["maxOffsetsPerTrigger"], more["failOnDataLoss"]) == ("64", "1000", "false")


def test_missing_source_is_reported(spark):
    # The session has no broker source, so this fails on loading; an unreachable broker is not tried here.
    attempt = kafka.try_read_topic(spark, "localhost:1", "t")
    assert attempt.records is None and attempt.error is not None


def test_jdbc_addresses():
    conn = jdbc.connection("postgresql://me.project:secret@host:5432/db?sslmode=require")
    assert (conn.url, conn.user, conn.password) == ("jdbc:postgresql://host:5432/db?sslmode=require", "me.project", "secret")
    assert jdbc.connection("postgresql://u:p@h/db?x=1", keep_query=False).url == "jdbc:postgresql://h/db"
    assert "secret" not in repr(conn)
    encoded = jdbc.connection("postgresql://us%40er:p%40s%25%2F@h:1/db")
    assert (encoded.url, encoded.user, encoded.password) == ("jdbc:postgresql://h:1/db", "us@er", "p@s%/")
    with pytest.raises(ValueError):
        jdbc.connection("mysql://u:p@h/db")
    sql = jdbc.insert_from_staging_sql("target", "temp", ["id", "data"], ["id"], ["data"])
    assert sql == "INSERT INTO target (id, data) SELECT id, data::jsonb FROM temp ON CONFLICT (id) DO NOTHING"
    sql = jdbc.insert_from_staging_sql("target", "temp", ["id", "a", "b"], ["id"], update=True)
    assert sql.endswith("ON CONFLICT (id) DO UPDATE SET a = EXCLUDED.a, b = EXCLUDED.b")


def test_catalog_tables(spark):
    tables.ensure_database(spark, "lab")
    tables.ensure_database(spark, "lab")
    tables.drop_table(spark, "lab.users")
    tables.ensure_table(spark, "lab.users", row_type(id=INT, name=TEXT, created_at=TIME, day=TEXT), ["day"])
    rows = spark.createDataFrame([("2024-01-01", "A", 1, datetime(2024, 1, 1))], "day string, name string, id int, created_at timestamp")
    tables.append_table(rows, "lab.users")
    got = tables.read_table(spark, "lab.users").first()
    assert (got["id"], got["name"], got["day"]) == (1, "A", "2024-01-01")
    assert tables.list_tables(spark, "lab").filter("tableName = 'users'").count() == 1
    assert tables.list_databases(spark).filter("namespace = 'lab'").count() == 1
    assert tables.list_catalogs(spark).count() >= 1
    assert tables.describe_table(spark, "lab.users").filter("col_name = 'name'").count() >= 1
    tables.replace_table(rows.limit(0), "lab.users", ["day"])
    assert tables.read_table(spark, "lab.users").count() == 0
    tables.drop_table(spark, "lab.users")
    assert tables.list_tables(spark, "lab").count() == 0


def test_shared_dir_follows_the_session(spark):
    assert shared_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert estimated_bytes(spark.range(10)) == 80


def test_scratch_goes_with_its_run(spark):
    from pathlib import Path

    from driftline.session import scratch, stored

    with scratch(spark):
        kept = shared_dir(spark, "x")
        rows = stored(spark.range(5), "rows")
        with scratch(spark):
            stored(spark.range(2), "inner")
        assert rows.count() == 5 and len(list(Path(kept).parent.iterdir())) == 2
    assert not Path(kept).parent.exists()
    with pytest.raises(ZeroDivisionError), scratch(spark):
        kept = shared_dir(spark, "x")
        stored(spark.range(1), "rows")
        1 / 0
    assert not Path(kept).parent.exists() and "/run-" not in shared_dir(spark, "x")


def land(spark, path, *offsets, at=datetime(2024, 1, 1)):
    rows = [(b"k", str(o).encode(), "t", 0, o, at) for o in offsets]
    spark.createDataFrame(rows, KAFKA_RECORD).coalesce(1).write.mode("append").parquet(path)


def as_changes(batch):
    return stamp(batch.select("topic", "partition", "offset", F.col("timestamp").alias("kafka_timestamp"), F.lit("c").alias("operation")))


def test_stream_restart_and_late_repeats(spark, tmp_path):
    """Records landed again later, even much later, are stored once; nothing is dropped as late."""
    landing, bronze, checkpoint = (str(tmp_path / n) for n in ("landing", "bronze", "checkpoint"))
    land(spark, landing, 1, 2, 3, at=datetime(2024, 5, 1))
    start = lambda cp=checkpoint: run_available(bronze_writer(kafka.stream_landing(spark, landing, 1), as_changes, bronze, cp))
    start()
    land(spark, landing, 0, at=datetime(2020, 1, 1))
    land(spark, landing, 2, 3, at=datetime(2024, 5, 1))
    start()
    start(str(tmp_path / "another"))
    stored = read_bronze(spark, bronze)
    assert sorted(r["offset"] for r in stored.collect()) == [0, 1, 2, 3]


def test_two_streams_share_an_audit_table(spark, tmp_path):
    bronze = str(tmp_path / "bronze")
    for name, offsets in (("one", (1, 2, 3)), ("two", (4, 5))):
        land(spark, str(tmp_path / name), *offsets)
        records = kafka.stream_landing(spark, str(tmp_path / name), 1)
        run_available(bronze_writer(records, as_changes, bronze, str(tmp_path / f"checkpoint-{name}")))
    assert sorted(r["offset"] for r in read_bronze(spark, bronze).collect()) == [1, 2, 3, 4, 5]


def test_stream_upsert_with_repeats(spark, tmp_path):
    landing = str(tmp_path / "landing")
    schema = "id int, name string, operation string, cdc_timestamp_ms long, offset long"
    batches = [[(1, "late winner", "u", 9, 9)], [(1, "loser", "u", 5, 5), (2, "a", "c", 1, 1)], [(2, None, "d", 3, 3)], [(2, "older", "u", 2, 2)]]
    target = TargetTable(spark, str(tmp_path / "target"), ("id",))
    for checkpoint in ("one", "two"):
        for b in batches if checkpoint == "one" else []:
            spark.createDataFrame(b, schema).coalesce(1).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landing)
        run_available(target_writer(stream, target, str(tmp_path / checkpoint), compact_every=2))
        assert {r["id"]: r["name"] for r in target.read().collect()} == {1: "late winner"}


def test_lag_windows_on_a_table(spark):
    rows = [(datetime(2024, 1, 1, 0, 0, s), lag) for s, lag in ((1, 5), (9, 7), (11, 0))]
    got = lag_windows(spark.createDataFrame(rows, "sampled_at timestamp, lag long")).orderBy("window_start").collect()
    assert [(r["max_lag"], r["samples"]) for r in got] == [(7, 2), (0, 1)]
