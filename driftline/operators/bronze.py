"""The audit table: every change as it came, by day and batch."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.operators.files import completed, expire_notes, located, newest_note, publish_note, remove, table_exists


def stamp(changes: DataFrame, run_ts: Column | None = None, migration_ts: bool = False) -> DataFrame:
    """Add ingestion time, source topic and the day the table is partitioned by.

    `migration_ts` also adds `_migration_ts`, the mark a capture-side transform would insert.
    """
    at = F.current_timestamp() if run_ts is None else run_ts
    columns = {
        "ingestion_time": at,
        "source_topic": F.col("topic"),
        "event_date": F.to_date("kafka_timestamp"),
    }
    if migration_ts:
        columns["_migration_ts"] = at
    return changes.withColumns(columns)


NO_DAY = "__HIVE_DEFAULT_PARTITION__"


LOG = "_batches"
IDENTITY = ("topic", "partition", "offset")


def write_batch(changes: DataFrame, path: str, batch_id: int, rebalance: bool = False, stream: str = "batch") -> None:
    """Write one batch, then its row in the batch log; writing the same batch of the same stream again replaces both and nothing else.

    Batches are numbered within their `stream`, so another stream's batch of the same number is another batch.
    Days that an earlier attempt wrote and this one does not have are removed after it. The changes are evaluated once; what
    the log says is read from the files written.

    A landing area in time order gives each task few days, so no shuffle is made by default.
    `rebalance` evens out files where a batch mixes many days, splitting days that are large.
    """
    spark = changes.sparkSession
    if batch_id <= compacted_up_to(spark, path).get(stream, -1):
        # Its files have been put together with others; a batch that is written again is the same.
        return
    out = changes.withColumns({"stream": F.lit(stream), "batch_id": F.lit(batch_id).cast("bigint")})
    earlier = _day_folders(spark, path, stream, batch_id)
    if rebalance:
        out = out.hint("rebalance", "event_date")
    # What was written is observed on the way, so nothing is evaluated again for it.
    seen = Observation()
    day = F.coalesce(F.col("event_date").cast("string"), F.lit(NO_DAY))
    committed = F.max(F.col("ingestion_time") if "ingestion_time" in changes.columns else F.current_timestamp())
    out = out.observe(seen, F.collect_set(day).alias("days"), F.count(F.lit(1)).alias("rows"), committed.alias("committed_at"))
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("event_date", "stream", "batch_id")
        .parquet(path)
    )
    now = {f"event_date={day}" for day in seen.get["days"]}
    for folder in earlier - now:
        remove(spark, f"{path}/{folder}/stream={stream}/batch_id={batch_id}")
    _log_batch(spark, path, stream, batch_id, sorted(now), changes.schema, seen.get["committed_at"])


def _log_batch(
    spark: SparkSession, path: str, stream: str, batch_id: int, days: Sequence[str], columns: T.StructType, committed_at: datetime | None
) -> None:
    """One row per topic and partition of a batch: its rows and the range of their offsets. A batch without rows has one of its own."""
    folders = [f"{path}/{day}/stream={stream}/batch_id={batch_id}" for day in days]
    folder = f"{path}/{LOG}/stream={stream}/batch_id={batch_id}"
    at = F.lit(committed_at).cast("timestamp").alias("committed_at")
    kinds = dict(zip(IDENTITY, ("string", "int", "bigint"), strict=True))
    own = [c for c in IDENTITY if c in columns.fieldNames()]
    nothing = {"rows_added": F.lit(0).cast("bigint"), "first_offset": F.lit(None).cast("bigint"), "last_offset": F.lit(None).cast("bigint")}
    ranges = spark.range(1).select(F.lit(None).cast("string").alias("topic"), F.lit(None).cast("int").alias("partition"), *[c.alias(n) for n, c in nothing.items()])
    if days:
        rows = spark.read.schema(T.StructType([columns[c] for c in own] or columns.fields)).parquet(*folders)
        place = [(F.col(c) if c in own else F.lit(None)).cast(kinds[c]).alias(c) for c in IDENTITY]
        ranges = rows.select(*place).groupBy("topic", "partition").agg(
            F.count(F.lit(1)).alias("rows_added"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset")
        )
    ranges.select("*", at).write.mode("overwrite").parquet(folder)


BATCH_RANGES = "stream string, batch_id long, topic string, partition int, rows_added long, first_offset long, last_offset long, committed_at timestamp"


def batch_ranges(spark: SparkSession, path: str) -> DataFrame | None:
    """What the batch log holds, a row per batch, topic and partition; None where no batch was logged."""
    if not table_exists(spark, f"{path}/{LOG}"):
        return None
    return spark.read.schema(BATCH_RANGES).option("basePath", f"{path}/{LOG}").parquet(f"{path}/{LOG}")


def read_batch_log(spark: SparkSession, path: str) -> DataFrame | None:
    """The log that ingest wrote, without a look at the audit table: as `batch_log` gives it."""
    ranges = batch_ranges(spark, path)
    if ranges is None:
        return None
    per_batch = ranges.groupBy("stream", "batch_id").agg(F.max("committed_at").alias("committed_at"), F.sum("rows_added").alias("rows_added"))
    return _with_totals(per_batch)


def _with_totals(per_batch: DataFrame) -> DataFrame:
    # A row per batch, in one group.
    order = Window.partitionBy(F.lit(0)).orderBy("committed_at", "stream", "batch_id")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_batch.select(
        "stream", "batch_id", "committed_at", F.lit("append").alias("operation"), "rows_added", F.sum("rows_added").over(so_far).alias("total_rows")
    )


def _day_folders(spark: SparkSession, path: str, stream: str, batch_id: int) -> set[str]:
    """Names of the day folders that hold the batch."""
    fs, folder = located(spark, f"{path}/event_date=*/stream={stream}/batch_id={batch_id}")
    return {s.getPath().getParent().getParent().getName() for s in fs.globStatus(folder) or ()}


def read_bronze(
    spark: SparkSession, path: str, days: Sequence[date | None] | None = None, columns: T.StructType | None = None,
    with_stream: bool = True,
) -> DataFrame | None:
    """The audit table, or only some days of it, whose folders alone are then listed; batches put together by `compact_batches` included.

    Giving the columns spares looking them up in the files. None where there is nothing yet.
    """
    folders = [f"event_date={NO_DAY if day is None else day}" for day in days or ()]
    paths = [p for p in ([path] if days is None else [f"{path}/{f}" for f in folders]) if table_exists(spark, p)]
    stored = None
    if days is not None or _has_days(spark, path):
        stored = _read_days(spark, path, paths, columns)
    _, note = newest_note(spark, f"{path}/{COMPACTED}")
    if note is not None:
        root = f"{path}/{COMPACTED}/data"
        wanted = ["event_date=*"] if days is None else folders
        own = [p for part in note["parts"] for f in wanted if _globbed(spark, p := f"{root}/part={part}/{f}")]
        if stored is not None:
            # What lies in both until the old files are removed counts once.
            for stream, last in note["up_to"].items():
                stored = stored.filter(~((F.col("stream") == stream) & (F.col("batch_id") <= last)))
        if own:
            together = _read_days(spark, root, own, columns, compacted=True)
            stored = together if stored is None else stored.unionByName(together, allowMissingColumns=True)
    if stored is None:
        return None
    return stored if with_stream else stored.drop("stream")


def _has_days(spark: SparkSession, path: str) -> bool:
    return bool(_globbed(spark, f"{path}/event_date=*"))


def _globbed(spark: SparkSession, pattern: str) -> list[str]:
    fs, folder = located(spark, pattern)
    return [s.getPath().toString() for s in fs.globStatus(folder) or ()]


def _read_days(spark: SparkSession, base: str, paths: Sequence[str], columns: T.StructType | None, compacted: bool = False) -> DataFrame | None:
    if not paths:
        return None
    if columns is not None and compacted:
        columns = T.StructType([*columns.fields, T.StructField("batch_id", T.LongType())])
    reader = spark.read.schema(columns) if columns is not None else spark.read
    found = reader.option("basePath", base).parquet(*paths)
    found = found.drop("part") if compacted else found
    return found.withColumns({"batch_id": F.col("batch_id").cast("bigint"), "stream": F.col("stream").cast("string")})


COMPACTED = "_compacted"


def compacted_up_to(spark: SparkSession, path: str) -> dict[str, int]:
    """By stream, the last batch whose files have been put together."""
    _, note = newest_note(spark, f"{path}/{COMPACTED}")
    return {} if note is None else note["up_to"]


def compact_batches(spark: SparkSession, path: str, up_to: dict[str, int]) -> None:
    """Put the small files of each stream's batches up to a number together, into few files a day.

    A row keeps its day, stream and batch, so what was read by them still is; within a file rows lie by batch. What is compacted
    counts from the moment a note says so, which is published last; until `expire_compacted` removes the old files, readers
    leave them out. Give only batches that are committed and will not change: one written again afterwards is passed over.
    """
    version, note = newest_note(spark, f"{path}/{COMPACTED}")
    before = note or {"up_to": {}, "parts": []}
    chosen = F.lit(False)
    for stream, last in up_to.items():
        chosen |= (F.col("stream") == stream) & (F.col("batch_id") <= last) & (F.col("batch_id") > before["up_to"].get(stream, -1))
    if not _has_days(spark, path):
        return
    rows = _read_days(spark, path, [path], None).filter(chosen)
    part = version + 1
    folder = f"{path}/{COMPACTED}/data/part={part}"
    remove(spark, folder)
    # Large days come as several files; a day's rows of one stream lie by batch.
    spread = rows.hint("rebalance", "event_date", "stream").sortWithinPartitions("event_date", "stream", "batch_id")
    spread.write.partitionBy("event_date", "stream").parquet(folder)
    publish_note(spark, f"{path}/{COMPACTED}", part, {"up_to": {**before["up_to"], **up_to}, "parts": [*before["parts"], part]})


def expire_compacted(spark: SparkSession, path: str) -> None:
    """Remove the files that have been put together. Readers that began before must have finished."""
    for stream, last in compacted_up_to(spark, path).items():
        for folder in _globbed(spark, f"{path}/event_date=*/stream={stream}/batch_id=*"):
            if int(folder.rsplit("=", 1)[1]) <= last:
                remove(spark, folder)
                for parent in (folder.rsplit("/", 1)[0], folder.rsplit("/", 2)[0]):
                    if not _globbed(spark, f"{parent}/*"):
                        remove(spark, parent)
    expire_notes(spark, f"{path}/{COMPACTED}")


def unseen(
    changes: DataFrame, path: str, batch_id: int, identity: Sequence[str] = IDENTITY, stream: str = "batch", records: DataFrame | None = None
) -> DataFrame:
    """Changes of a batch that no other batch has stored, each once.

    The batch log tells which batches hold offsets of the same range of a topic and partition; only those are read, and only
    their identity columns, so records that come in order are compared with nothing. `records` are the messages that the changes
    were parsed from, if it is cheaper to look at those for the ranges. A table that has no log is compared by the days that
    the batch touches.
    """
    spark = changes.sparkSession
    once = changes.dropDuplicates(list(identity))
    logged = batch_ranges(spark, path) if tuple(identity) == IDENTITY else None
    columns = T.StructType([changes.schema[c] for c in identity])
    if logged is None:
        days = [r[0] for r in changes.select("event_date").distinct().collect()]
        stored = read_bronze(spark, path, days, columns)
        if stored is None:
            return once
        others = stored.filter((F.col("batch_id") != batch_id) | (F.col("stream") != stream))
        return once.join(others.select(*identity), list(identity), "left_anti")
    # A row per topic and partition, and one per batch that shares offsets with this one.
    own = (changes if records is None else records).groupBy("topic", "partition").agg(F.min("offset").alias("_low"), F.max("offset").alias("_high"))
    meets = logged["topic"].eqNullSafe(own["topic"]) & logged["partition"].eqNullSafe(own["partition"])
    meets &= (F.col("first_offset") <= F.col("_high")) & (F.col("last_offset") >= F.col("_low"))
    near = logged.join(F.broadcast(own), meets, "left_semi").filter((F.col("batch_id") != batch_id) | (F.col("stream") != stream))
    near = [(r["stream"], r["batch_id"]) for r in near.select("stream", "batch_id").distinct().collect()]
    if not near:
        return once
    done = compacted_up_to(spark, path)
    apart = [(s, b) for s, b in near if b > done.get(s, -1)]
    others = None
    if apart:
        others = spark.read.schema(columns).parquet(*[f"{path}/event_date=*/stream={s}/batch_id={b}" for s, b in apart])
    if len(apart) < len(near):
        numbers = [b for s, b in near if b <= done.get(s, -1)]
        root = f"{path}/{COMPACTED}/data"
        together = _read_days(spark, root, _globbed(spark, f"{root}/part=*/event_date=*"), columns, compacted=True)
        together = together.filter(F.col("batch_id").between(min(numbers), max(numbers))).select(*identity)
        others = together if others is None else others.select(*identity).unionByName(together)
    return once.join(others.select(*identity), list(identity), "left_anti")


def batch_log(bronze: DataFrame) -> DataFrame:
    """One row per stream and batch: when, what, how many rows, and the table's size after it, in the order of commits.

    This counts the audit table anew; `read_batch_log` reads what ingest has noted. Grouping by batch comes first, so the running
    total's single group is one row per batch.
    """
    if "stream" not in bronze.columns:
        bronze = bronze.withColumn("stream", F.lit("batch"))
    return _with_totals(bronze.groupBy("stream", "batch_id").agg(F.max("ingestion_time").alias("committed_at"), F.count("*").alias("rows_added")))


def operation_counts(changes: DataFrame, *by: str) -> DataFrame:
    """Changes per operation, or per operation and further columns such as topic or day."""
    return changes.groupBy("operation", *by).agg(F.count("*").alias("change_count"))
