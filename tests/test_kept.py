"""Tables, figures and comparisons kept up to date, against working them out anew."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from driftline.operators import bronze, history, kept, targets, validate
from driftline.operators.chunks import merge_chunks, state_of
from driftline.operators.digest_tree import diff_by_tree, differing_ranges, range_digests, ranges_of
from driftline.operators.keyed import SkewPolicy, over_key
from driftline.operators.relations import Reference, cascade_graph
from driftline.streaming.ingest import run_available
from driftline.streaming.readiness import readiness, step
from driftline.streaming.references import orphan_stream

CUT = SkewPolicy(small_bytes=0, pieces=16)
CHANGES = "id int, name string, operation string, cdc_timestamp_ms long, offset long"


def random_changes(seed, n=400, keys=12, times=60):
    """Changes with ties in time, deletes, a null key, and one key with a third of all rows."""
    rng = random.Random(seed)
    return [
        (rng.choice([0] * (keys // 2) + [None, *range(keys)]), rng.choice("ab"), rng.choice("rcuud"), rng.randrange(times), i) for i in range(n)
    ]


def versions(df):
    return Counter(tuple(r) for r in df.select("id", "name", "is_current", "valid_from", "valid_to", "version").collect())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_late_changes_are_spliced_as_if_rebuilt(spark, tmp_path, seed):
    rows = random_changes(seed)
    random.Random(seed).shuffle(rows)
    table = history.HistoryTable(spark, str(tmp_path / "history"), ("id",), buckets=4)
    assert table.read() is None
    batches = [rows[:150], rows[150:160], rows[160:390], rows[155:165], rows[390:]]
    seen = []
    for batch in batches:
        seen = list(dict.fromkeys([*seen, *batch]))
        table.apply_batch(spark.createDataFrame(batch, CHANGES), policy=CUT if seed == 3 else SkewPolicy())
        assert versions(table.read()) == versions(history.scd2(spark.createDataFrame(seen, CHANGES), ["id"]))
    assert table.changes().count() == len(rows)


def test_a_late_change_before_an_unseen_delete(spark, tmp_path):
    table = history.HistoryTable(spark, str(tmp_path / "history"), ("id",), buckets=8)
    rows = [(1, "a", "c", 1, 1), (1, None, "d", 5, 2), (1, None, "d", 9, 3)]
    table.apply_batch(spark.createDataFrame(rows, CHANGES))
    before = table.table.manifest()
    table.apply_batch(spark.createDataFrame([(1, "late", "u", 7, 4)], CHANGES))
    got = [(r["name"], r["version"], r["is_current"], r["t"]) for r in table.read().select("*", F.unix_millis("valid_to").alias("t")).orderBy("version").collect()]
    assert got == [("a", 1, False, 5), ("late", 2, False, 9)]
    # Another key's bucket is written without a look at this one's.
    for key in range(2, 9):
        table.apply_batch(spark.createDataFrame([(key, "n", "c", 1, 10 + key)], CHANGES))
    assert len(table.table.manifest().versions) > 1 and len(before.versions) == 1
    assert table.read().count() == 9


@pytest.mark.parametrize("policy", [SkewPolicy(), CUT], ids=["plain", "cut"])
def test_as_of_join(spark, policy):
    rows = random_changes(7, 600)
    versions_of = history.scd2(spark.createDataFrame(rows, CHANGES), ["id"])
    rng = random.Random(8)
    asked = [(rng.choice([0, 0, 0, None, *range(14)]), datetime(1970, 1, 1) + timedelta(milliseconds=rng.randrange(-5, 70)), i) for i in range(500)]
    asked.append((0, None, 999))
    probes = spark.createDataFrame(asked, "id int, at timestamp, n int")
    got = {r["n"]: (r["in_force"]["name"], r["in_force"]["version"]) if r["in_force"] else None for r in history.as_of_join(probes, versions_of, ["id"], "at", policy).collect()}
    held = versions_of.collect()
    expected = {}
    for key, at, n in asked:
        fits = [v for v in held if v["id"] == key and at is not None and v["valid_from"] <= at and (v["valid_to"] is None or v["valid_to"] > at)]
        expected[n] = max((v["version"], v["name"]) for v in fits)[::-1] if fits else None
    assert got == expected
    assert history.as_of_join(probes.limit(0), versions_of, ["id"], "at").count() == 0


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("policy", [SkewPolicy(), CUT], ids=["plain", "cut"])
def test_held_values(spark, policy, descending):
    rng = random.Random(5)
    rows = [(rng.choice([1, 1, None, *range(5)]), rng.randrange(50), i, rng.choice([None, None, i])) for i in range(2000)]
    df = spark.createDataFrame(rows, "k int, t int, o int, v int").repartition(4)
    got = {r["o"]: r["last"] for r in over_key(df, ["k"], ["t", "o"], held={"last": F.col("v")}, descending=descending, policy=policy).collect()}
    expected = {}
    for key in {r[0] for r in rows}:
        last = None
        for _, _, o, v in sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2]), reverse=descending):
            last = v if v is not None else last
            expected[o] = last
    assert got == expected


def test_a_large_costly_input_is_evaluated_once(spark):
    costly = spark.range(3000).withColumn("k", F.lit(1)).groupBy("id").agg(F.max("k").alias("k"))
    plan = over_key(costly, ["k"], ["id"], running={"n": F.lit(1)}, policy=CUT)._jdf.queryExecution().optimizedPlan().toString()
    assert "Relation" in plan and "Range" not in plan


def test_checksum_and_uniqueness_follow_each_batch(spark, tmp_path):
    table = targets.TargetTable(spark, str(tmp_path / "target"), ("id",))
    sums, values = str(tmp_path / "sums"), str(tmp_path / "values")
    rows = random_changes(11, 300, keys=40)
    expected = []
    for number, part in enumerate((rows[200:], rows[:120], rows[120:200], rows[:120])):
        batch = spark.createDataFrame(part, CHANGES)
        number = 1 if number == 3 else number
        effect = kept.effects(table.state(), batch, ["id"])
        for _ in range(2):
            # Recording again alters nothing, whether before the batch is applied or after.
            kept.record_checksum(effect, ["id", F.upper("name")], sums, number)
            kept.record_values(effect, "name", values, number)
        table.apply_batch(batch, number)
        live = table.read()
        assert kept.kept_checksum(spark, sums).first() == validate.checksum(live, ["id", F.upper("name")]).first()
        holders = {r["name"]: r["n"] for r in live.groupBy("name").agg(F.count("*").alias("n")).collect() if r["n"] > 1 and r["name"] is not None}
        assert {r["value"]: r["holders"] for r in kept.duplicate_values(spark, values).collect()} == holders
        expected.append(holders)
    begun = {(r["value"], r["batch_id"]) for r in kept.violations(spark, values).collect() if r["event"] == "begin"}
    before = {}
    for number, holders in enumerate(expected[:3]):
        assert {v for v, b in begun if b == number} == set(holders) - set(before)
        before = holders


def test_violations_end_and_follow_commits(spark, tmp_path):
    path = str(tmp_path / "values")
    state = None
    steps = [("s", 0, [(1, "x", "c", 1, 1), (2, "x", "c", 1, 2)]), ("t", 0, [(2, "y", "u", 2, 3)]), ("s", 1, [(3, "y", "c", 3, 4), (1, None, "d", 3, 5)])]
    for stream, number, rows in steps:
        batch = spark.createDataFrame(rows, CHANGES)
        kept.record_values(kept.effects(state, batch, ["id"]), "name", path, number, stream)
        state = targets.apply_changes(state, batch, ["id"], broadcast_bytes=0)
    commits = spark.createDataFrame([("s", 0, datetime(2024, 1, 1)), ("t", 0, datetime(2024, 1, 2)), ("s", 1, datetime(2024, 1, 3))], "stream string, batch_id long, committed_at timestamp")
    got = {tuple(r) for r in kept.violations(spark, path, commits).collect()}
    assert got == {("x", "s", 0, "begin", 2), ("x", "t", 0, "end", 1), ("y", "s", 1, "begin", 2)}


@pytest.mark.parametrize("as_text", [False, True])
def test_digest_tree_finds_what_a_full_diff_finds(spark, tmp_path, as_text):
    rng = random.Random(4)
    rows = [(i, rng.choice("abc"), i % 7) for i in range(3000)] + [(None, "z", 1), (None, "z", 2)]
    other = [r for r in rows if r[0] not in (5, 2999)] + [(4000, "new", 1), (None, "q", 3), (17, "twice", 1)]
    other = [(k, "altered" if k == 1234 else a, b) for k, a, b in other]
    kind = "string" if as_text else "long"
    source, target = (spark.createDataFrame(r, "k long, a string, b int").withColumn("k", F.col("k").cast(kind)) for r in (rows, other))
    full = Counter(tuple(r) for r in validate.diff_rows(source, target, ["k"], ["a", "b"]).collect())
    for fanout, ranges in ((4, 64), (8, 7), (2, 1)):
        assert Counter(tuple(r) for r in diff_by_tree(source, target, "k", ["a", "b"], ranges, fanout).collect()) == full
    assert diff_by_tree(source, source, "k", ["a", "b"]).count() == 0
    assert diff_by_tree(source.limit(0), target.limit(0), "k", ["a", "b"]).count() == 0


def test_digest_tree_reads_differing_ranges_only(spark, tmp_path):
    spark.range(20_000).withColumn("a", F.col("id") % 9).repartitionByRange(20, "id").sortWithinPartitions("id").write.parquet(str(tmp_path / "s"))
    source = spark.read.parquet(str(tmp_path / "s"))
    source.withColumn("a", F.when(F.col("id") == 7777, -1).otherwise(F.col("a"))).write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    bounds = ranges_of(source, "id", 64)
    digests = [range_digests(side, bounds, ["a"]) for side in (source, target)]
    found = differing_ranges(*digests)
    assert len(found) == 1
    inside = source.filter(bounds.condition(found))
    plan = inside._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "GreaterThanOrEqual(id" in plan and "LessThan(id" in plan
    assert inside.count() < 20_000 / 64 * 2
    got = diff_by_tree(source, target, "id", ["a"], bounds=bounds, source_digests=digests[0], target_digests=digests[1])
    assert [(r["id"], r["status"], r["columns"]) for r in got.collect()] == [(7777, "mismatch", "a")]
    # Many stretches become few, which hold at least the same.
    wide = bounds.condition(list(range(0, 60, 2)), most=3)
    assert source.filter(bounds.condition(list(range(0, 60, 2)))).exceptAll(source.filter(wide)).isEmpty()


@pytest.mark.parametrize("seed", range(4))
def test_chunks_merge_to_the_state_of_the_log(spark, seed):
    rng = random.Random(seed)
    log, state, reads = [], {}, []
    marks = {}
    chunk_at = sorted(rng.sample(range(5, 195), 4))
    for offset in range(200):
        key, op = rng.choice([0, 0, 0, None, *range(20)]), rng.choice("cuud")
        for chunk, at in enumerate(chunk_at):
            if offset == max(0, at - rng.randrange(0, 9)) and chunk not in marks:
                marks[chunk] = offset - 1
            if offset == at:
                marks.setdefault(chunk, at - 1)
                mine = [(k, v) for k, v in state.items() if (k or 0) % 4 == chunk]
                reads.append((chunk, mine, marks[chunk], min(199, at + rng.randrange(0, 9))))
        log.append((key, f"v{offset}" if op != "d" else None, op, offset))
        state.pop(key, None)
        if op != "d":
            state[key] = f"v{offset}"
    chunks = [(k, v, low, high) for _, mine, low, high in reads for k, v in mine]
    first = min(low for _, _, low, _ in reads)
    # Only the log after the first mark is there; the chunks hold what came before.
    schema = "id int, v string, operation string, offset long"
    logged = spark.createDataFrame([r for r in log if r[3] > first], schema)
    rows = spark.createDataFrame(chunks, "id int, v string, low long, high long")
    merged = merge_chunks(rows.unionByName(rows.limit(3)), logged, ["id"])
    got = {r["id"]: r["v"] for r in state_of(merged, ["id"]).collect() if r["operation"] != "d"}
    assert got == state


def plain_cascade(tables, references, start):
    gone, new = set(start), set(start)
    while new:
        found = set()
        for child, column, parent, parent_column in references:
            values = {row[parent_column] for t, row in ((t, dict(r)) for t, r in new) if t == parent and row[parent_column] is not None}
            found |= {(child, tuple(row.items())) for row in tables[child] if row[column] in values}
        new = found - gone
        gone |= new
    return gone


def test_cascades_along_cycles(spark):
    rng = random.Random(2)
    a = [{"id": i, "up": rng.choice([None, *range(40)]), "b": rng.choice([None, *range(30)])} for i in range(40)]
    b = [{"id": i, "code": i % 11, "a": rng.choice([None, *range(40)])} for i in range(30)]
    c = [{"id": i, "code": rng.choice([None, *range(11)])} for i in range(50)]
    rows = {"a": a, "b": b, "c": c}
    references = [("a", "up", "a", "id"), ("a", "b", "b", "id"), ("b", "a", "a", "id"), ("c", "code", "b", "code")]
    schemas = {"a": "id int, up int, b int", "b": "id int, code int, a int", "c": "id int, code int"}
    tables = {t: spark.createDataFrame([tuple(r.values()) for r in own], schemas[t]) for t, own in rows.items()}
    for start in ([("a", 3)], [("b", 1), ("c", 2)], []):
        seeds = [(t, tuple(rows[t][i].items())) for t, i in start]
        expected = {(t, dict(r)["id"]) for t, r in plain_cascade(rows, references, seeds)}
        deleted = {t: tables[t].filter(F.col("id").isin([i for s, i in start if s == t])) for t in {t for t, _ in start}}
        gone = cascade_graph(tables, dict.fromkeys(tables, ["id"]), [Reference(*r) for r in references], deleted)
        assert {(t, r["id"]) for t, found in gone.items() for r in found.collect()} == expected
        assert all(found.count() == found.distinct().count() for found in gone.values())


def test_batch_log_is_written_by_ingest(spark, tmp_path):
    path = str(tmp_path / "bronze")
    assert bronze.read_batch_log(spark, path) is None
    schema = "topic string, partition int, offset long, kafka_timestamp timestamp, operation string"

    def batch(offsets, day, at):
        rows = spark.createDataFrame([("t", 0, o, datetime(2024, 1, day), "c") for o in offsets], schema)
        return bronze.stamp(rows, run_ts=F.lit(at).cast("timestamp"))

    # Two streams number alike; the second one's first batch is committed between the first one's two.
    bronze.write_batch(batch(range(3), 1, "2024-01-05"), path, 0, stream="a")
    bronze.write_batch(batch(range(10, 14), 2, "2024-03-01"), path, 0, stream="b")
    bronze.write_batch(batch(range(3, 5), 1, "2024-02-01"), path, 1, stream="a")
    bronze.write_batch(batch([], 1, "2024-04-01"), path, 2, stream="a")
    bronze.write_batch(batch(range(3, 5), 1, "2024-02-01"), path, 1, stream="a")
    log = bronze.read_batch_log(spark, path)
    got = [(r["stream"], r["batch_id"], r["rows_added"], r["total_rows"]) for r in log.filter("rows_added > 0").orderBy("total_rows").collect()]
    assert got == [("a", 0, 3, 3), ("a", 1, 2, 5), ("b", 0, 4, 9)]
    assert log.count() == 4
    table = bronze.read_bronze(spark, path)
    assert sorted(map(str, bronze.batch_log(table).collect())) == sorted(str(r) for r in log.filter("rows_added > 0").collect())

    def offsets(df):
        return sorted(r["offset"] for r in df.collect())

    assert offsets(history.as_of_batch(table, 0, "b", log)) == [0, 1, 2, 3, 4, 10, 11, 12, 13]
    assert offsets(history.as_of_batch(table, 0, "a", log)) == offsets(history.as_of_batch(table, 0, "a")) == [0, 1, 2]
    assert offsets(history.as_of_batch(table, 1, "a", log)) == [0, 1, 2, 3, 4]
    with pytest.raises(ValueError):
        history.as_of_batch(table, 7, "a", log)


def test_only_batches_of_the_same_offsets_are_compared(spark, tmp_path):
    path = str(tmp_path / "bronze")
    schema = "topic string, partition int, offset long, kafka_timestamp timestamp, operation string"

    def batch(*offsets, partition=0):
        return bronze.stamp(spark.createDataFrame([("t", partition, o, datetime(2024, 1, 1), "c") for o in offsets], schema), run_ts=F.lit("2024-01-02").cast("timestamp"))

    for number, offsets in enumerate(([0, 1, 2], [3, 4, 9], [10, 11])):
        bronze.write_batch(batch(*offsets), path, number)
    bronze.write_batch(batch(5, partition=1), path, 3)

    def compared(df):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        return plan.count("Relation ["), sorted(r["offset"] for r in df.collect())

    assert compared(bronze.unseen(batch(12, 13), path, 4)) == (0, [12, 13])
    assert compared(bronze.unseen(batch(5, 9, 6), path, 4)) == (1, [5, 6])
    assert compared(bronze.unseen(batch(2, 5, partition=1), path, 4)) == (1, [2])
    assert compared(bronze.unseen(batch(10, 11), path, 2)) == (0, [10, 11])
    assert sorted(r["offset"] for r in bronze.unseen(batch(0, 11, 20), path, 9, records=batch(0, 11, 20)).collect()) == [20]


def test_small_files_of_batches_are_put_together(spark, tmp_path):
    path = str(tmp_path / "bronze")
    schema = "topic string, partition int, offset long, kafka_timestamp timestamp, operation string"

    def batch(offsets, days):
        rows = spark.createDataFrame([("t", 0, o, datetime(2024, 1, d) if d else None, "c") for o, d in zip(offsets, days, strict=True)], schema)
        return bronze.stamp(rows, run_ts=F.lit("2024-01-02").cast("timestamp"))

    for number in range(6):
        bronze.write_batch(batch(range(4 * number, 4 * number + 4), [1, 1, 2, None]), path, number, stream="a")
    bronze.write_batch(batch([100, 101], [1, 3]), path, 0, stream="b")

    def rows(df):
        return sorted((r["stream"], r["batch_id"], r["offset"], str(r["event_date"])) for r in df.collect())

    before = rows(bronze.read_bronze(spark, path))
    files = len(list((tmp_path / "bronze").rglob("event_date=*/**/*.parquet")))
    bronze.compact_batches(spark, path, {"a": 3})
    # Old files and new ones are both there; rows count once.
    assert rows(bronze.read_bronze(spark, path)) == before
    bronze.expire_compacted(spark, path)
    assert rows(bronze.read_bronze(spark, path)) == before
    bronze.compact_batches(spark, path, {"a": 4, "b": 0})
    bronze.expire_compacted(spark, path)
    table = bronze.read_bronze(spark, path)
    assert rows(table) == before and len(list((tmp_path / "bronze").rglob("event_date=*/**/*.parquet"))) < files / 2
    assert rows(bronze.read_bronze(spark, path, [datetime(2024, 1, 1).date(), None])) == [r for r in before if r[3] in ("2024-01-01", "None")]
    assert rows(history.as_of_batch(table, 2, "a")) == [r for r in before if r[0] == "a" and r[1] <= 2]
    assert bronze.read_batch_log(spark, path).count() == 7
    # A compacted batch that is written again is passed over; repeats in compacted batches are found.
    bronze.write_batch(batch([5], [1]), path, 1, stream="a")
    assert rows(bronze.read_bronze(spark, path)) == before
    assert sorted(r["offset"] for r in bronze.unseen(batch([3, 9, 21, 50, 101], [None, 1, 1, 1, 3]), path, 9, stream="c").collect()) == [50]
    bronze.compact_batches(spark, path, {"a": 5})
    bronze.expire_compacted(spark, path)
    assert rows(bronze.read_bronze(spark, path)) == before and not list((tmp_path / "bronze").glob("event_date=*"))
    bronze.write_batch(batch([200], [5]), path, 6, stream="a")
    assert len(rows(bronze.read_bronze(spark, path))) == len(before) + 1


def test_readiness_of_samples():
    known, told = (None, None, False), []
    for at, lagging in [(0, True), (10, False), (60, False), (70, False), (80, False), (90, True), (100, False), (300, False), (365, False)]:
        known, new = step(known, at, lagging, 60, 120)
        told += new
    assert told == [("ready", 70, 10), ("lost", 90, 10), ("ready", 365, 300)]
    assert step((0, 100, True), 500, False, 60, 120) == ((500, 500, False), [("lost", 500, 0)])


def test_ready_stream_survives_restarts_and_late_samples(spark, tmp_path):
    rng = random.Random(6)
    start = datetime(2024, 1, 1)
    samples = [(rng.choice("xyz"), start + timedelta(seconds=10 * i + rng.randrange(10)), rng.choice([0] * 30 + [5, None])) for i in range(900)]
    for source in "xyz":
        samples.append((source, start + timedelta(hours=9), 0))
    schema, told = "source string, at timestamp, lag long", {}
    for way in ("whole", "parts"):
        landing, out, checkpoint = (str(tmp_path / f"{way}-{n}") for n in ("in", "out", "cp"))
        # Samples out of order within two minutes; in the second way the stream is stopped and started again after each file.
        ordered = sorted(samples, key=lambda s: s[1].timestamp() + (rng.random() * 110 if way == "parts" else 0))
        pieces = [ordered] if way == "whole" else [ordered[i : i + 130] for i in range(0, len(ordered), 130)]
        for piece in pieces:
            spark.createDataFrame(piece, schema).coalesce(1).write.mode("append").parquet(landing)
            stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landing)
            ready = readiness(stream, "source", "at", F.col("lag"), 300, max_gap=240, delay="2 minutes")
            run_available(ready.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint))
        told[way] = Counter(tuple(r) for r in spark.read.schema(ready.schema).parquet(out).collect())
    expected = Counter()
    last = max(s[1] for s in samples)
    for source in "xyz":
        known, by_second = (None, None, False), {}
        for s, at, lag in samples:
            if s == source:
                second = int((at - datetime(1970, 1, 1)).total_seconds())
                by_second[second] = by_second.get(second, False) or lag is None or lag > 0
        for second in sorted(by_second):
            # What the watermark has not passed stays open.
            if second + 1 <= int((last - datetime(1970, 1, 1)).total_seconds()) - 120:
                known, new = step(known, second, by_second[second], 300, 240)
                expected.update((source, *n) for n in new)
    assert told["whole"] == told["parts"] == expected and {e for _, e, _, _ in expected} == {"ready", "lost"}


def test_orphans_wait_for_their_parents(spark, tmp_path):
    start = datetime(2024, 1, 1)
    children = [(1, 10, 0), (2, 20, 0), (3, 30, 5), (4, None, 5), (5, 10, 200), (6, 50, 5), (7, 99, 500)]
    parents = [(10, 5), (10, 7), (20, 70), (30, -100), (98, 500)]
    for name, rows, schema in (("c", children, "child int, ref int, at timestamp"), ("p", parents, "id int, at timestamp")):
        for n in range(0, len(rows), 3):
            part = [(*r[:-1], start + timedelta(minutes=r[-1])) for r in rows[n : n + 3]]
            spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / name))
    streams = [spark.readStream.schema(s).parquet(str(tmp_path / n)) for n, s in (("c", "child int, ref int, at timestamp"), ("p", "id int, at timestamp"))]
    known = spark.createDataFrame([(50,), (None,)], "id int")
    told = orphan_stream(streams[0], "ref", "at", streams[1], "id", "at", "1 hour", "30 minutes", "1 minute", known)
    assert told.columns == ["child", "ref", "at"]
    run_available(told.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")))
    assert sorted(r["child"] for r in spark.read.schema(told.schema).parquet(str(tmp_path / "out")).collect()) == [2, 3, 5]


def test_order_shapes(spark):
    flat = spark.createDataFrame(
        [(1, 7, "12.345", "shipped", "card", 1_500_000, 2_000_000, 9), (2, 7, None, None, None, None, None, None), (None, 1, "1", "x", "y", 1, 1, 1)],
        "order_id int, customer_id int, total_amount string, status string, payment_method string, created_at long, updated_at long, lsn long",
    )
    got = {r["order_id"]: r for r in targets.shape_orders(flat, F.lit("2024-01-01").cast("timestamp"), {"shipped": "processing"}).collect()}
    assert set(got) == {1, 2} and (got[1]["status"], got[2]["status"]) == ("processing", "pending")
    assert str(got[1]["total_amount"]) == "12.35" and got[1]["cdc_lsn"] == "9" and got[1]["created_at"] == datetime(1970, 1, 1, 0, 0, 1, 500000)
    items = spark.createDataFrame([(1, 2, "p", 3, "4.5", 0, None), (None, 2, "p", 3, "4.5", 0, 1)], "item_id int, order_id int, product_name string, quantity int, price string, created_at long, lsn long")
    [item] = targets.shape_order_items(items, F.lit("2024-01-01").cast("timestamp")).collect()
    assert (str(item["price"]), item["cdc_lsn"], item["source_system"]) == ("4.50", None, "postgres_local")
