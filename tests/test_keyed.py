"""Ordered computations per key, with and without keys that have to be cut."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from driftline.operators.keyed import SkewPolicy, find_cuts, latest_per_key, over_key
from driftline.operators.history import scd2, with_previous_image
from driftline.operators.quality import status_changes
from driftline.operators.relations import running_adjustments
from driftline.operators.validate import quiet_stretches

CUT = SkewPolicy(small_bytes=0, pieces=16)


@pytest.fixture(scope="module")
def skewed(spark):
    """Key 7 and the null key hold a third of the rows each; times repeat, offsets do not."""
    random.seed(3)
    rows = []
    for i in range(6000):
        key = 7 if i % 3 == 0 else None if i % 3 == 1 else random.randrange(400)
        rows.append((key, random.randrange(300), i, random.choice("rcud"), random.randrange(-9, 9)))
    schema = "k long, t long, o long, operation string, v long"
    return spark.createDataFrame(rows, schema).repartition(5).cache()


def brute_force(rows, descending):
    out = set()
    by_key = {}
    for r in rows:
        by_key.setdefault(r["k"], []).append(r)
    for group in by_key.values():
        group.sort(key=lambda r: (r["t"], r["o"]), reverse=descending)
        total = 0
        for i, r in enumerate(group):
            total += r["v"]
            nxt = group[i + 1]["operation"] if i + 1 < len(group) else None
            prev = group[i - 1]["operation"] if i else None
            out.add((r["k"], r["o"], total, nxt, prev))
    return out


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("policy", [SkewPolicy(), CUT])
def test_against_brute_force(skewed, descending, policy):
    got = over_key(
        skewed, ["k"], ["t", "o"], running={"total": F.col("v")}, lead={"nxt": F.col("operation")},
        lag={"prev": F.col("operation")}, descending=descending, policy=policy,
    ).select("k", "o", "total", "nxt", "prev")
    assert {tuple(r) for r in got.collect()} == brute_force(skewed.collect(), descending)


def test_only_large_keys_are_cut(skewed):
    cuts = find_cuts(skewed, ["k"], ["t", "o"], CUT)
    hashes = {r[0] for r in skewed.filter("k = 7 or k is null").select(F.xxhash64("k")).distinct().collect()}
    assert {r["_key_hash"] for r in cuts.by_key.collect()} == hashes


def test_pieces_are_small(skewed):
    from driftline.operators import keyed

    cuts = find_cuts(skewed, ["k"], ["t", "o"], CUT)
    sizes = keyed._place(skewed, ["k"], ["t", "o"], cuts).groupBy("k", "_piece").count()
    assert sizes.agg(F.max("count")).first()[0] < 6000 / 6


def test_one_key_whose_times_are_all_equal(spark):
    rows = spark.range(3000).select(F.lit(1).alias("k"), F.lit(5).alias("t"), F.col("id").alias("o"))
    assert find_cuts(rows, ["k"], ["t", "o"], CUT) is not None
    got = over_key(rows, ["k"], ["t", "o"], running={"n": F.lit(1)}, lead={"nxt": F.col("o")}, policy=CUT)
    assert got.filter(F.col("n") != F.col("o") + 1).count() == 0
    assert got.filter(~F.col("nxt").eqNullSafe(F.when(F.col("o") < 2999, F.col("o") + 1))).count() == 0


def test_small_inputs_are_not_sampled(spark, skewed, tmp_path):
    skewed.write.parquet(str(tmp_path / "rows"))
    assert find_cuts(spark.read.parquet(str(tmp_path / "rows")), ["k"], ["t", "o"]) is None


def test_inputs_of_unknown_size_are_sampled(spark, skewed):
    rows = spark.createDataFrame(skewed.collect(), skewed.schema)
    assert find_cuts(rows, ["k"], ["t", "o"], SkewPolicy(pieces=16)) is not None


def test_order_must_compare_exactly(skewed):
    with pytest.raises(TypeError):
        over_key(skewed.withColumn("x", F.col("t").cast("double")), ["k"], ["x"], running={"n": F.lit(1)})


@pytest.mark.parametrize("semantics", ["documented", "literal"])
def test_history_is_the_same_when_keys_are_cut(skewed, semantics):
    changes = skewed.select(F.col("k").alias("id"), "v", "operation", F.col("t").alias("cdc_timestamp_ms"), F.col("o").alias("offset"))
    whole = scd2(changes, ["id"], semantics=semantics)
    cut = scd2(changes, ["id"], semantics=semantics, policy=CUT)
    assert whole.count() > 3000
    assert whole.exceptAll(cut).count() == 0 and cut.exceptAll(whole).count() == 0


def same(a, b):
    assert a.count() > 0 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_users_of_ordered_keys_agree_when_keys_are_cut(skewed):
    steps = dict(keys=["k"], order=["t", "o"])
    lag = F.when(F.col("v") > 5, 1).otherwise(0)
    cases = [
        lambda p: status_changes(skewed, status="operation", transitions=[("r", "u"), ("u", "d")], policy=p, **steps),
        lambda p: quiet_stretches(skewed, ["k"], "t", "o", lag, policy=p),
        lambda p: running_adjustments(skewed, amounts={"level": F.col("v")}, policy=p, **steps),
        lambda p: with_previous_image(skewed, ["k"], "operation", ["t", "o"], policy=p),
    ]
    for case in cases:
        same(case(SkewPolicy(small_bytes=1 << 62)), case(CUT))


def test_a_plain_history_needs_one_shuffle(spark, skewed, tmp_path):
    skewed.write.parquet(str(tmp_path / "c"))
    changes = spark.read.parquet(str(tmp_path / "c")).select(F.col("k").alias("id"), "v", "operation", F.col("t").alias("cdc_timestamp_ms"), F.col("o").alias("offset"))
    plan = scd2(changes, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Python" not in plan
    pruned = scd2(changes, ["id"]).filter("id = 3").select("version")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(k,3)" in pruned and "ReadSchema: struct<k:bigint,t:bigint,o:bigint,operation:string>" in pruned


def test_latest_keeps_one_row_per_key_before_the_shuffle(skewed):
    latest = latest_per_key(skewed, ["k"], ["t", "o"])
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    best = {}
    for r in skewed.collect():
        if r["k"] not in best or (r["t"], r["o"]) > best[r["k"]]:
            best[r["k"]] = (r["t"], r["o"])
    assert {r["k"]: (r["t"], r["o"]) for r in latest.collect()} == best


def test_cut_sums_equal_plain_ones_with_nulls_and_decimals(spark):
    rows = [(1, i, i, None if i < 150 or i % 3 == 0 else i % 7) for i in range(400)]
    df = spark.createDataFrame(rows, "k long, t long, o long, v long").withColumn("v", F.col("v").cast("decimal(10,2)")).repartition(4)
    for descending in (False, True):
        plain, cut = (
            over_key(df, ["k"], ["t", "o"], running={"total": F.col("v")}, descending=descending, policy=p)
            for p in (SkewPolicy(), SkewPolicy(small_bytes=0, pieces=4))
        )
        assert plain.schema == cut.schema
        assert sorted(map(str, plain.collect())) == sorted(map(str, cut.collect()))


def test_unknown_lag_is_lag(spark):
    from driftline.operators.validate import cutover_gate, ready_to_cut_over

    df = spark.createDataFrame([("a", 0, None), ("a", 100, None), ("b", 0, 0), ("b", 100, 0)], "k string, t long, lag long")
    assert {r["k"]: r["ready"] for r in ready_to_cut_over(df, ["k"], "t", F.col("lag")).collect()} == {"a": False, "b": True}
    assert [r["k"] for r in quiet_stretches(df.withColumn("o", F.col("t")), ["k"], "t", "o", F.col("lag")).collect()] == ["b"]
    unknown = spark.createDataFrame([(True,), (None,)], "ok boolean")
    assert not cutover_gate(lag=unknown).first()["ready_to_cut_over"]
