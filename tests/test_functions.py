from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from driftline import functions as fn


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_times_keep_their_fraction(spark):
    assert one(spark, fn.from_micros(F.lit(1_700_000_000_123_456))) == datetime(2023, 11, 14, 22, 13, 20, 123456)
    assert one(spark, fn.from_micros(F.lit(1_700_000_000_123_456), whole_seconds=True)) == datetime(2023, 11, 14, 22, 13, 20)
    assert one(spark, fn.from_millis(F.lit(1_700_000_000_123))) == datetime(2023, 11, 14, 22, 13, 20, 123000)
    assert one(spark, fn.epoch_seconds(F.lit("2023-11-14T22:13:20.9Z"))) == 1_700_000_000
    assert one(spark, fn.epoch_seconds(F.lit("soon"))) is None


def test_document_times(spark):
    at = datetime(2023, 11, 14, 22, 13, 20)
    for text in ('{"$date": 1700000000000}', '{"$date": {"$numberLong": "1700000000000"}}', '{"$date": "2023-11-14T22:13:20Z"}', "2023-11-14T22:13:20Z", "2023-11-14T23:13:20+01:00"):
        assert one(spark, fn.document_time(F.lit(text))) == at
    assert one(spark, fn.document_time(F.lit("later"))) is None
    assert one(spark, fn.document_time(F.lit(None).cast("string"))) is None


def test_values(spark):
    assert one(spark, fn.clamp_at_zero(F.lit(-3))) == 0
    assert one(spark, fn.clamp_at_zero(F.lit(None).cast("int"))) is None
    assert one(spark, fn.null_when(F.lit(None).cast("boolean"), F.lit(1))) == 1
    assert one(spark, fn.map_values(F.lit("q"), {"a": "b"})) == "q"
    assert one(spark, fn.default_to(F.lit(None).cast("string"), "pending")) == "pending"
    assert one(spark, fn.truncate_text(F.lit("0123456789" * 3), 20)) == "01234567890123456789"
    assert one(spark, fn.object_id(F.lit('{"$oid": "abc"}'))) == one(spark, fn.object_id(F.lit("abc"))) == "abc"


def test_emails(spark):
    good, bad = ["a.B+c@x-1.example.COM", "A@b.co"], ["a@b", "a b@c.de", "a@b.c", "@b.de", ""]
    for text in good + bad:
        assert one(spark, fn.email_is_valid(F.lit(text))) is (text in good)


def test_digest_tells_null_from_nothing(spark):
    rows = [("a", None), (None, "a"), ("a", ""), ("", "a"), ("a|b", "c"), ("a", "b|c")]
    df = spark.createDataFrame(rows, "x string, y string").select(fn.row_digest([F.col("x"), F.col("y")]).alias("d"))
    assert len({r["d"] for r in df.collect()}) == len(rows)


def test_the_same_rows_typed_two_ways_have_one_digest(spark):
    from datetime import datetime, timezone
    from decimal import Decimal

    from pyspark.sql import Row

    from driftline.functions.canonical import canonical
    from driftline.operators.validate import checksum

    one = spark.createDataFrame(
        [(1, 1.5, 0.1, datetime(2024, 3, 31, 1, 30, 0, 120000), '{"b": 1.50, "a": [1e2, "1.0, x"], "c": null}', "é", b"\x0a\xff"),
         (2, -0.0, 3.25, None, None, None, None), (3, 1e10, 100.0, datetime(1969, 12, 31), "not json", "plain", b"")],
        "id int, price double, ratio float, at timestamp_ntz, doc string, name string, raw binary",
    )
    other = spark.createDataFrame(
        [(Decimal("1.00"), Decimal("1.5000"), 0.1, datetime(2024, 3, 31, 1, 30, 0, 120000, timezone.utc), '{ "a":[100,"1.0, x"],"c":null,"b":1.5}', "é", b"\x0a\xff"),
         (Decimal("2.00"), Decimal("0.0000"), 3.25, None, None, None, None), (Decimal("3.00"), Decimal("10000000000.0000"), 100.0, datetime(1969, 12, 31, tzinfo=timezone.utc), "not json", "plain", b"")],
        "id decimal(12,2), price decimal(20,4), ratio double, at timestamp, doc string, name string, raw binary",
    )
    names = one.columns
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for session in ("UTC", "Europe/Berlin"):
            spark.conf.set("spark.sql.session.timeZone", session)
            sums = [checksum(df, canonical(df, names, json=["doc"], compose=True)).first() for df in (one, other)]
            assert sums[0] == sums[1] and sums[0]["row_count"] == 3
        assert checksum(one, canonical(one, names)).first() != checksum(other, canonical(other, names)).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    nested = spark.createDataFrame([Row(d=Row(b=Decimal("1.50"), a=["x"], c=None))], "d struct<b: decimal(5,2), a: array<string>, c: int>")
    text = spark.createDataFrame([('{"c":null,"a":["x"],"b":1.5}',)], "d string")
    assert nested.select(canonical(nested, ["d"])).first() == text.select(canonical(text, ["d"], json=["d"])).first()
    numbers = spark.createDataFrame([(1e300, 1e-7, 0.1 + 0.2, float("nan"), 12345678901234567.0)], "a double, b double, c double, d double, e double")
    assert tuple(numbers.select(canonical(numbers, numbers.columns)).first()) == ("1.0E300", "0.0000001", "0.30000000000000004", "NaN", "12345678901234568")
