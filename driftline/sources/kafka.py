"""Change records from a broker, or from a landing table with the broker's columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from driftline.schemas import KAFKA_RECORD


def topic_options(
    servers: str, topics: str, starting: str = "earliest", ending: str | None = "latest", *,
    min_partitions: int | None = None, max_offsets_per_trigger: int | None = None, fail_on_data_loss: bool | None = None,
) -> dict[str, str]:
    """Options of a read; without `ending`, and where None is given, the source's own default applies.

    `min_partitions` cuts large topic partitions into more tasks; `max_offsets_per_trigger` bounds a micro-batch.
    """
    options = {"kafka.bootstrap.servers": servers, "subscribe": topics, "startingOffsets": starting}
    if ending:
        options["endingOffsets"] = ending
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if fail_on_data_loss is not None:
        options["failOnDataLoss"] = str(fail_on_data_loss).lower()
    return options


def read_topic(
    spark: SparkSession, servers: str, topics: str, starting: str = "earliest", ending: str | None = "latest", **more: int | bool
) -> DataFrame:
    """Bounded read of topics. Needs the Kafka source package on the session."""
    return spark.read.format("kafka").options(**topic_options(servers, topics, starting, ending, **more)).load()


def stream_topic(spark: SparkSession, servers: str, topics: str, starting: str = "earliest", **more: int | bool) -> DataFrame:
    """Unbounded read of topics. Give `max_offsets_per_trigger`, or the first micro-batch is all there is."""
    return spark.readStream.format("kafka").options(**topic_options(servers, topics, starting, None, **more)).load()


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(KAFKA_RECORD).parquet(path)


def stream_landing(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(KAFKA_RECORD)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


@dataclass(frozen=True)
class Attempt:
    """Outcome of a read that may fail: the records, or the error that prevented them."""

    records: DataFrame | None
    error: Exception | None


def try_read_topic(spark: SparkSession, servers: str, topics: str, **options: str) -> Attempt:
    """Read a topic and hand over the error if the broker cannot be used, so the caller can go on.

    A read contacts the broker only when it runs, so one record is asked for here.
    """
    try:
        records = read_topic(spark, servers, topics, **options)
        records.select("offset").limit(1).collect()
        return Attempt(records, None)
    except Exception as error:
        return Attempt(None, error)
