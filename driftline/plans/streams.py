"""Queries: the same work as streams, run until the available input is used up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.operators import envelope as env
from driftline.operators.bronze import read_bronze, stamp
from driftline.operators.targets import TargetTable
from driftline.operators.validate import quiet_stretches
from driftline.plans import given
from driftline.plans.given import CHANGES_SQL
from driftline.plans.loads import LATEST_SQL
from driftline.plans.registry import Catalog
from driftline.schemas import CUSTOMER_ROW
from driftline.session import shared_dir
from driftline.sources.kafka import stream_landing
from driftline.streaming.apply import target_writer
from driftline.streaming.ingest import bronze_writer, dedupe_within, run_available
from driftline.streaming.monitor import lag_windows
from driftline.streaming.readiness import readiness
from driftline.streaming.references import orphan_stream

CATALOG = Catalog()
MICRO_BATCHES = 4


def _landed(spark: SparkSession, sf_dir: str, repeats: bool = False) -> str:
    """The records as landing files in arbitrary order; `repeats` lands every third one again."""
    path = shared_dir(spark, "landing")
    records = given.records(spark, sf_dir)
    spread = F.pmod("offset", F.lit(3))
    for part in range(3):
        records.filter(spread == part).write.mode("append").parquet(path)
    if repeats:
        records.filter(spread == 1).write.mode("append").parquet(path)
    return path


def _stream(spark: SparkSession, landing: str) -> DataFrame:
    """The landing files as a stream of a few micro-batches, however many files there are."""
    files = len(spark.read.parquet(landing).inputFiles())
    return stream_landing(spark, landing, files_per_batch=-(-files // MICRO_BATCHES))


@CATALOG.add("x1_stream_to_bronze", f"""WITH {CHANGES_SQL} SELECT "offset", operation, CAST(CAST(kafka_timestamp AS DATE) AS VARCHAR) AS event_date,
  CASE WHEN operation <> 'd' THEN CAST(customer_id AS INTEGER) END AS customer_id FROM changes""")
def stream_to_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing files to the audit table, some records landed twice and stored once."""
    path = shared_dir(spark, "bronze")
    records = _stream(spark, _landed(spark, sf_dir, repeats=True))
    run_available(bronze_writer(
        records, lambda batch: stamp(env.parse_relational(batch, CUSTOMER_ROW, ["customer_id"])), path, shared_dir(spark, "checkpoint"), rebalance=True
    ))
    return read_bronze(spark, path).select(
        "offset", "operation", F.col("event_date").cast("string").alias("event_date"), F.col("after.customer_id").alias("customer_id")
    )


@CATALOG.add("x1_dedupe_within_delay", f"""WITH {CHANGES_SQL} SELECT "partition", count(*) AS messages FROM changes GROUP BY ALL""")
def dedupe_within_delay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeats dropped by bounded state; the delay exceeds the whole range, so nothing is late."""
    out = shared_dir(spark, "deduped")
    records = _stream(spark, _landed(spark, sf_dir, repeats=True))
    kept = dedupe_within(records, "60 days").select("topic", "partition", "offset")
    run_available(kept.writeStream.format("parquet").option("path", out).option("checkpointLocation", shared_dir(spark, "checkpoint")))
    return spark.read.parquet(out).groupBy("partition").agg(F.count("*").alias("messages"))


@CATALOG.add("x2_stream_upsert", f"""WITH {CHANGES_SQL}, {LATEST_SQL} SELECT CAST(customer_id AS INTEGER) AS customer_id,
  event_type || '.' || customer_id || '@example.com' AS email, props->>'$.k' AS phone FROM latest WHERE operation <> 'd'""")
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Micro-batches that interleave in time, applied to a target that folds itself on the way."""
    target = TargetTable(spark, shared_dir(spark, "target"), ("customer_id",))
    records = _stream(spark, _landed(spark, sf_dir))

    def shape(batch: DataFrame) -> DataFrame:
        flat = env.flatten_keyed(env.accepted(env.parse_relational(batch, CUSTOMER_ROW, ["customer_id"])), ["customer_id"])
        return flat.select(*CUSTOMER_ROW.fieldNames(), "operation", "cdc_timestamp_ms", "offset")

    run_available(target_writer(records, target, shared_dir(spark, "checkpoint"), shape, compact_every=2))
    return target.read().select("customer_id", "email", "phone")


_WINDOW_SQL = """w AS (SELECT time_bucket(INTERVAL 10 SECOND, ts) AS window_start, max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS max_lag, count(*) AS samples
  FROM events GROUP BY ALL)"""


def _monitored(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing, out = shared_dir(spark, "samples"), shared_dir(spark, "lag")
    lag = F.when(F.col("event_type") == "error", 1).otherwise(0)
    samples = given.table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("sampled_at"), lag.alias("lag"))
    samples.write.parquet(landing)
    stream = spark.readStream.schema(samples.schema).parquet(landing)

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/b={batch_id}")

    # Update mode also emits the intervals that are still open when the input ends.
    windows = lag_windows(stream, delay="0 seconds").writeStream.outputMode("update")
    run_available(windows.foreachBatch(store).option("checkpointLocation", shared_dir(spark, "checkpoint")))
    emitted = spark.read.parquet(out)
    # An interval emitted more than once only grows.
    return emitted.groupBy("window_start").agg(F.max("max_lag").alias("max_lag"), F.max("samples").alias("samples"))


@CATALOG.add("x3_lag_windows", f"WITH {_WINDOW_SQL} SELECT window_start, max_lag, samples FROM w")
def monitored_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _monitored(spark, sf_dir)


@CATALOG.add("x3_quiet_windows", f"""WITH {_WINDOW_SQL}, n AS (SELECT *, epoch(window_start)::BIGINT AS second, sum(max_lag) OVER (ORDER BY window_start ROWS UNBOUNDED PRECEDING) AS stretch FROM w)
SELECT min(second) AS quiet_from, max(second) AS quiet_to, count(*) AS samples FROM n WHERE max_lag = 0 GROUP BY stretch HAVING max(second) - min(second) >= 60""")
def quiet_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stretches of at least a minute in which no interval saw lag."""
    second = F.unix_seconds("window_start")
    windows = _monitored(spark, sf_dir).select(F.lit("all").alias("source"), second.alias("second"), F.lit(0).alias("tie"), "max_lag")
    stretches = quiet_stretches(windows, ["source"], "second", "tie", F.col("max_lag"))
    return stretches.filter(F.col("quiet_seconds") >= 60).select("quiet_from", "quiet_to", "samples")


HOLD_SECONDS = 3600


@CATALOG.add("x3_ready_stream", f"""WITH s AS (SELECT 's' || user_id % 4 AS source, floor(epoch(ts))::BIGINT AS second, max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS lag
    FROM events WHERE epoch(ts) < (SELECT floor(max(epoch(ts))) FROM events) GROUP BY ALL),
  n AS (SELECT *, sum(lag) OVER (PARTITION BY source ORDER BY second ROWS UNBOUNDED PRECEDING) AS stretch FROM s),
  z AS (SELECT *, min(second) FILTER (lag = 0) OVER (PARTITION BY source, stretch) AS zero_since, max(second) OVER (PARTITION BY source) AS last_second FROM n),
  r AS (SELECT source, stretch, zero_since, min(second) AS ready_at FROM z WHERE lag = 0 AND second - zero_since >= {HOLD_SECONDS} GROUP BY ALL)
SELECT source, 'ready' AS event, ready_at AS at, zero_since FROM r
UNION ALL SELECT r.source, 'lost', n.second, r.zero_since FROM r JOIN n ON r.source = n.source AND n.stretch = r.stretch + 1 AND n.lag = 1""")
def ready_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a running stream tells of four sources' readiness, from samples landing in three parts; the last second is still open."""
    landing, out = shared_dir(spark, "samples"), shared_dir(spark, "ready")
    at = F.col("ts").cast("timestamp")
    samples = given.table(spark, sf_dir, "events").select(
        F.concat(F.lit("s"), F.pmod("user_id", F.lit(4))).alias("source"), at.alias("sampled_at"), F.when(F.col("event_type") == "error", 1).otherwise(0).alias("lag")
    )
    # One file each, in the order of time: no sample comes later than the stream's delay.
    for part in range(3):
        third = F.least(F.floor((F.dayofmonth("sampled_at") - 1) / 10), F.lit(2))
        samples.filter(third == part).coalesce(1).write.mode("append").parquet(landing)
    stream = spark.readStream.schema(samples.schema).option("maxFilesPerTrigger", 1).parquet(landing)
    told = readiness(stream, "source", "sampled_at", F.col("lag"), HOLD_SECONDS, delay="0 seconds")
    run_available(told.writeStream.format("parquet").option("path", out).option("checkpointLocation", shared_dir(spark, "checkpoint")))
    return spark.read.schema(told.schema).parquet(out)


@CATALOG.add("x_orphans_stream", """WITH children AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'), parents AS (SELECT user_id, ts FROM events WHERE event_type = 'signup'),
  ends AS (SELECT least((SELECT max(ts) FROM children), (SELECT max(ts) FROM parents)) AS passed)
SELECT event_id, user_id FROM children c WHERE ts + INTERVAL 1 HOUR < date_trunc('millisecond', (SELECT passed FROM ends))
  AND NOT EXISTS (SELECT 1 FROM parents p WHERE p.user_id = c.user_id AND p.ts >= c.ts - INTERVAL 2 DAY AND p.ts <= c.ts + INTERVAL 1 HOUR)""")
def orphans_from_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases without a signup of the same user in the two days before or the hour after, told once that hour has passed in both streams."""
    events = given.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("at"))
    sides = {}
    for kind in ("purchase", "signup"):
        landing = shared_dir(spark, kind)
        for part in range(3):
            third = F.least(F.floor((F.dayofmonth("at") - 1) / 10), F.lit(2))
            events.filter((F.col("event_type") == kind) & (third == part)).coalesce(1).write.mode("append").parquet(landing)
        sides[kind] = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(landing).drop("event_type")
    told = orphan_stream(sides["purchase"], "user_id", "at", sides["signup"], "user_id", "at", "1 hour", "2 days", "0 seconds")
    out = shared_dir(spark, "orphans")
    run_available(told.writeStream.format("parquet").option("path", out).option("checkpointLocation", shared_dir(spark, "checkpoint")))
    return spark.read.schema(told.schema).parquet(out).select("event_id", "user_id")
