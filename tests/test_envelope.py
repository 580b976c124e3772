from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline import functions as fn
from driftline.operators import envelope as env
from driftline.operators import wire
from driftline.schemas import (
    CUSTOMER_ROW, EVENT_DOCUMENT, INT, INVENTORY_DOCUMENT, KAFKA_RECORD, LONG, ORDER_ITEM_ROW, ORDER_ROW, TEXT, row_type,
)

AT = datetime(2024, 1, 1)


def records(spark, *values, key=None):
    rows = [(key, v if v is None or isinstance(v, bytes) else v.encode(), "t", 0, i, AT) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, KAFKA_RECORD)


def envelope(op, before=None, after=None, ts=1, **source):
    return json.dumps({"payload": {"op": op, "ts_ms": ts, "source": {"schema": "public", "table": "customers", **source}, "before": before, "after": after}})


def reasons(parsed):
    return {r["offset"]: r["reject_reason"] for r in parsed.collect()}


def test_reject_reasons(spark):
    row = {"customer_id": 1}
    parsed = env.parse_relational(
        records(spark, None, "{bad", envelope("x"), envelope("u"), envelope("d"), envelope("c", after=row), envelope("d", before=row), "", "{}"),
        CUSTOMER_ROW,
    )
    assert reasons(parsed) == {
        0: "null_value", 1: "unparsable", 2: "unknown_op", 3: "missing_after", 4: "missing_key",
        5: None, 6: None, 7: "unparsable", 8: "unparsable",
    }
    assert env.accepted(parsed).count() == 2 and env.rejected(parsed).count() == 7


def test_lost_values_and_keys_are_rejected(spark):
    good, key = {"customer_id": 1}, ["customer_id"]
    values = [
        envelope("c", after={"email": "a"}), envelope("c", after={"customer_id": "abc"}), envelope("u", after={"customer_id": 3_000_000_000}),
        envelope("d", before={"email": "a"}), envelope("u", after={**good, "created_at": "soon"}), envelope("u", before={"customer_id": "x"}, after=good),
        envelope("c", after=good), envelope("d", before=good), envelope("c", after={**good, "unknown": {"a": 1}, "phone": None}),
    ]
    parsed = env.parse_relational(records(spark, *values), CUSTOMER_ROW, key)
    assert reasons(parsed) == {
        0: "missing_key", 1: "bad_field", 2: "bad_field", 3: "missing_key", 4: "bad_field", 5: "bad_field", 6: None, 7: None, 8: None,
    }
    assert env.accepted(parsed).count() + env.rejected(parsed).count() == len(values)
    document = json.dumps({"_id": "a", "quantity": "many"})
    wrapped = json.dumps({"payload": {"op": "c", "ts_ms": 5, "source": {"collection": "i"}, "after": document}})
    assert reasons(env.parse_documents(records(spark, wrapped), INVENTORY_DOCUMENT)) == {0: "bad_field"}


def test_widened_fields_are_decoded(spark):
    old = row_type(after=row_type(a=INT, b=T.DecimalType(10, 2), c=INT), op=TEXT)
    new = row_type(after=row_type(a=LONG, b=T.DoubleType(), c=TEXT), op=TEXT)
    raw = records(spark, frame(21, b'{"op": "c", "after": {"a": 1, "b": 1.25, "c": 7}}'), frame(22, b'{"op": "c", "after": {"a": 5000000000, "b": 0.1, "c": "x"}}'))
    for decoders in ({21: old, 22: new}, {21: new, 22: old}):
        decoded = wire.decode_frames(wire.split_frames(raw), {i: wire.json_decoder(s) for i, s in decoders.items()})
        assert [f.dataType for f in decoded.schema["cdc_event"].dataType["after"].dataType] == [LONG, TEXT, TEXT]
        assert decoded.count() == 2
    decoded = wire.decode_frames(wire.split_frames(raw), {21: wire.json_decoder(old), 22: wire.json_decoder(new)})
    got = {r["schema_id"]: tuple(r["cdc_event"]["after"]) for r in decoded.collect()}
    assert got == {21: (1, "1.25", "7"), 22: (5000000000, "0.1", "x")}


def test_no_digit_is_lost_between_unlike_numbers():
    kinds = {
        (LONG, T.DoubleType()): TEXT, (T.DecimalType(10, 2), T.DoubleType()): TEXT, (LONG, T.FloatType()): TEXT, (INT, T.DoubleType()): T.DoubleType(),
        (T.FloatType(), T.DoubleType()): T.DoubleType(), (INT, LONG): LONG, (LONG, T.DecimalType(10, 2)): T.DecimalType(21, 2), (T.DecimalType(38, 0), T.DecimalType(10, 2)): TEXT,
    }
    for (a, b), wider in kinds.items():
        assert wire._wider(a, b) == wire._wider(b, a) == wider


def test_records_are_parsed_once(spark):
    flat = env.flatten_image(env.accepted(env.parse_relational(records(spark, envelope("c", after={"customer_id": 1})), CUSTOMER_ROW)))
    assert flat._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_flatten_takes_the_key_of_a_delete_from_before(spark):
    parsed = env.parse_relational(records(spark, envelope("d", before={"customer_id": 9, "email": "a"}, lsn=77)), CUSTOMER_ROW)
    row = env.flatten_keyed(parsed, ["customer_id"]).first()
    assert (row["customer_id"], row["email"], row["lsn"], row["operation"]) == (9, None, 77, "d")
    assert env.flatten_image(parsed).first()["customer_id"] is None


def test_money_of_orders_and_items(spark):
    order = env.flatten_image(env.parse_relational(records(spark, envelope("c", after={"order_id": 1, "total_amount": 12.30, "status": "pending"})), ORDER_ROW)).first()
    assert str(order["total_amount"]) == "12.30" and order["payment_method"] is None
    item = env.flatten_image(env.parse_relational(records(spark, envelope("r", after={"item_id": 3, "price": 0.5, "quantity": 2})), ORDER_ITEM_ROW)).first()
    assert (str(item["price"]), item["quantity"]) == ("0.50", 2)


def test_documents(spark):
    def wrapped(doc, op="c"):
        return json.dumps({"payload": {"op": op, "ts_ms": 5, "source": {"collection": "events"}, "after": doc and json.dumps(doc)}})

    parsed = env.parse_documents(
        records(
            spark,
            wrapped({"_id": {"$oid": "a"}, "event_id": "e1", "timestamp": {"$date": 0}, "metadata": {"page": "/", "processed": True}}),
            wrapped({"_id": "a", "event_id": "e2", "timestamp": "2024-01-02T03:04:05.678+01:00"}),
            wrapped(None, "d"),
            wrapped(None, "u"),
            json.dumps({"payload": {"op": "c", "ts_ms": 1, "after": "{broken"}}),
            key=b'{"id": "{\\"$oid\\": \\"gone\\"}"}',
        ),
        EVENT_DOCUMENT,
    )
    assert reasons(parsed) == {0: None, 1: None, 2: None, 3: "missing_after", 4: "missing_after"}
    flat = env.flatten_event_documents(parsed).withColumn("at", fn.document_time(F.col("event_occurred_at")))
    rows = {r["offset"]: r for r in flat.collect()}
    assert rows[0]["mongo_id"] == rows[1]["mongo_id"] == "a" and rows[2]["mongo_id"] == "gone"
    assert rows[0]["at"] == datetime(1970, 1, 1) and rows[1]["at"] == datetime(2024, 1, 2, 2, 4, 5, 678000)
    assert rows[0]["processed"] is True and rows[1]["page"] is None
    with pytest.raises(AssertionError):
        env.flatten_inventory_documents(parsed)
    assert INVENTORY_DOCUMENT["unit_cost"].dataType.typeName() == "double"


def test_topic_routing(spark, tmp_path):
    cases = {
        '{"topic": "own", "payload": {"source": {"name": "n"}}}': "own",
        '{"topic": "", "payload": {"source": {"name": "n", "schema": "s", "table": "t"}}}': "n.s.t",
        '{"payload": {"source": {}}}': "unknown.public.unknown",
        '{"payload": {}}': "debezium.cdc.events",
        "nonsense": "debezium.cdc.events",
    }
    df = spark.createDataFrame([(c,) for c in cases], "e string")
    assert {r["e"]: r["t"] for r in df.select("e", env.route_topic(F.col("e")).alias("t")).collect()} == cases
    env.write_by_topic(df, F.col("e"), str(tmp_path / "routed"))
    counts = spark.read.parquet(str(tmp_path / "routed")).groupBy("topic").count().collect()
    assert {r["topic"]: r["count"] for r in counts} == {"own": 1, "n.s.t": 1, "unknown.public.unknown": 1, "debezium.cdc.events": 2}
    renamed = df.limit(1).select(env.rename_topic(F.lit("a.b")).alias("t"))
    assert renamed.first()["t"] == "data:a.b"


def frame(schema_id, body):
    return b"\x00" + schema_id.to_bytes(4, "big") + body


def test_frames(spark):
    long_body = json.dumps({"op": "c", "ts_ms": 1, "after": {"a": 1, "note": "x" * 150_000}}).encode()
    v21 = row_type(after=row_type(a=INT), op=TEXT, ts_ms=LONG, before=row_type(a=INT))
    v22 = row_type(after=row_type(a=INT, note=TEXT), op=TEXT, ts_ms=LONG, before=row_type(a=INT, note=TEXT))
    raw = records(
        spark, frame(21, b'{"op":"r","ts_ms":4,"after":{"a":8}}'), frame(22, long_body), frame(2**32 - 1, b"{}"),
        b"\x01" + frame(21, b"{}")[1:], b"\x00\x00", None, frame(21, b"{bad"),
    )
    split = wire.split_frames(raw)
    ids = {r["offset"]: r["schema_id"] for r in split.collect()}
    assert (ids[0], ids[1], ids[2]) == (21, 22, 2**32 - 1)
    decoded = wire.decode_frames(split, {21: wire.json_decoder(v21), 22: wire.json_decoder(v22)})
    rows = {r["offset"]: r for r in wire.flatten_frames(decoded).collect()}
    assert rows[0]["after"].asDict() == {"a": 8, "note": None} and rows[0]["before"] is None
    assert len(rows[1]["after"]["note"]) == 150_000
    assert [rows[i]["reject_reason"] for i in range(2, 6)] == ["unknown_schema", "bad_magic", "short_frame", "null_value"]
    assert wire.latest_schema_id(split.filter("offset < 2")).first()[0] == 22
    census = {r["schema_id"]: r["messages"] for r in wire.schema_census(split.filter("offset < 2")).collect()}
    assert census == {21: 1, 22: 1}
    newest = wire.decode_frames(split.filter("offset < 2"), {22: wire.json_decoder(v22)}, latest_only=True)
    assert [r["offset"] for r in newest.collect()] == [1]


def test_avro_needs_its_package(spark):
    """The decoder itself cannot be verified without the package."""
    split = wire.split_frames(records(spark, frame(1, b"\x02u")))
    schema = '{"type": "record", "name": "E", "fields": [{"name": "op", "type": "string"}]}'
    try:
        decoded = wire.decode_frames(split, {1: wire.avro_decoder(schema)})
    except AnalysisException as error:
        assert "spark-avro" in str(error)
        pytest.skip("spark-avro is not on the session")
    assert decoded.first()["cdc_event"]["op"] == "u"


def test_include_lists(spark):
    df = spark.createDataFrame([("public", "a"), ("public", "b"), ("sales", "a")], "source_schema string, source_table string")
    assert env.include_only(df, schemas=["public"], tables=["a"]).collect() == [("public", "a")]
    assert env.include_only(df, tables=["sales.a"]).collect() == [("sales", "a")]
    docs = spark.createDataFrame([("x",), ("y",)], "source_collection string")
    assert env.include_only(docs, collections=["y"]).collect() == [("y",)]
