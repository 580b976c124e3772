"""Checksums and uniqueness kept up to date by what each batch changes, instead of counted anew.

Both rest on the same rows: for each key a batch really changes, its image before and after. What these add and take away is
recorded under the batch's stream and number, before the batch is applied; a batch that has been recorded is not recorded
again, so repeating it alters nothing. The present figure is the sum over the batches.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftline.operators.files import table_exists
from driftline.operators.keyed import latest_per_key
from driftline.operators.targets import ORDER
from driftline.operators.validate import digest_parts, whole_checksum
from driftline.schemas import DELETE


def effects(state: DataFrame | None, changes: DataFrame, keys: Sequence[str], order: Sequence[str] = ORDER) -> DataFrame:
    """The keys with `before` and `after`, images of the rows that applying the changes to the state alters.

    An image is null where the key is absent or deleted. Changes that come too late to win have no effect. Only the newest
    change of each key meets the state.
    """
    newest = latest_per_key(changes, keys, order)
    fields = [c for c in newest.columns if c not in (*keys, *order, "operation")]
    after = F.when(F.col("operation") != DELETE, F.struct(*keys, *fields)).alias("after")
    offered = newest.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.struct(*order).alias("_offered"), after)
    if state is None:
        none = F.lit(None).cast(offered.schema["after"].dataType)
        found = offered.withColumn("before", none)
    else:
        own = [F.col(c) if c in state.columns else F.lit(None).cast(newest.schema[c].dataType).alias(c) for c in fields]
        held = state.select(*keys, F.struct(*order).alias("_held"), F.when(F.col("operation") != DELETE, F.struct(*keys, *own)).alias("before"))
        same = reduce(lambda acc, k: acc & F.col(k).eqNullSafe(F.col(f"_k_{k}")), keys, F.lit(True))
        joined = offered.join(held, same, "left").filter(F.col("_held").isNull() | (F.col("_offered") > F.col("_held")))
        found = joined.drop(*keys, "_held")
    changed = found.filter(~F.col("before").eqNullSafe(F.col("after")))
    return changed.select(*[F.col(f"_k_{k}").alias(k) for k in keys], "before", "after")


def _signed(effect: DataFrame, columns: Sequence[str | Column]) -> DataFrame:
    """The columns of both images, with `_sign` 1 for what comes and -1 for what goes."""
    images = [
        effect.filter(F.col(i).isNotNull()).select(f"{i}.*").select(*columns, F.lit(sign).alias("_sign")) for i, sign in (("after", 1), ("before", -1))
    ]
    return images[0].unionByName(images[1])


def _record(rows: DataFrame, path: str, batch_id: int, stream: str) -> None:
    folder = f"{path}/stream={stream}/batch_id={batch_id}"
    if not table_exists(rows.sparkSession, f"{folder}/_SUCCESS"):
        rows.write.mode("overwrite").parquet(folder)


def _recorded(spark: SparkSession, path: str) -> DataFrame:
    found = spark.read.option("basePath", path).parquet(f"{path}/stream=*")
    return found.withColumns({"stream": F.col("stream").cast("string"), "batch_id": F.col("batch_id").cast("bigint")})


def record_checksum(effect: DataFrame, columns: Sequence[str | Column], path: str, batch_id: int, stream: str = "batch") -> None:
    """Record how far a batch moves the table's row count and checksum."""
    names = [f"_c{i}" for i in range(len(columns))]
    named = [(F.col(c) if isinstance(c, str) else c).alias(n) for c, n in zip(columns, names, strict=True)]
    rows = _signed(effect, named)
    parts = digest_parts(rows, names)
    sums = [F.coalesce(F.sum(p * F.col("_sign")), F.lit(0)).alias(n) for n, p in parts.items()]
    _record(rows.agg(F.coalesce(F.sum("_sign"), F.lit(0)).alias("row_count"), *sums), path, batch_id, stream)


def kept_checksum(spark: SparkSession, path: str) -> DataFrame:
    """Row count and checksum of the table as it is now, as `checksum` gives them, from one row per batch."""
    recorded = _recorded(spark, path)
    names = [c for c in recorded.columns if c.startswith("_p")]
    return whole_checksum(recorded.agg(F.sum("row_count").alias("row_count"), *[F.sum(n).alias(n) for n in names]), names)


def record_values(effect: DataFrame, value: str | Column, path: str, batch_id: int, stream: str = "batch") -> None:
    """Record how many rows more or fewer hold each value after a batch. Null is no value."""
    column = F.col(value) if isinstance(value, str) else value
    rows = _signed(effect, [column.alias("value")]).filter(F.col("value").isNotNull())
    _record(rows.groupBy("value").agg(F.sum("_sign").alias("more")).filter("more <> 0"), path, batch_id, stream)


def duplicate_values(spark: SparkSession, path: str) -> DataFrame:
    """Values that more than one row holds now, with how many: what a unique rule finds in the table itself."""
    held = _recorded(spark, path).groupBy("value").agg(F.sum("more").alias("holders"))
    return held.filter("holders > 1")


def violations(spark: SparkSession, path: str, commits: DataFrame | None = None) -> DataFrame:
    """When each value came to be held more than once and when it ceased to: `value`, `stream`, `batch_id`, `event`, `holders`.

    Batches of one stream follow their numbers. With several streams, `commits` (`stream`, `batch_id`, `committed_at`, as the
    batch log has them) gives the order.
    """
    recorded = _recorded(spark, path)
    order = ["batch_id"]
    if commits is not None:
        recorded = recorded.join(commits.select("stream", "batch_id", "committed_at"), ["stream", "batch_id"])
        order = ["committed_at", "stream", "batch_id"]
    # Few rows of a value: one per batch that changed the number of its holders.
    along = Window.partitionBy("value").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stepped = recorded.withColumn("holders", F.sum("more").over(along)).withColumn("_before", F.col("holders") - F.col("more"))
    event = F.when((F.col("holders") > 1) & (F.col("_before") <= 1), "begin").when((F.col("holders") <= 1) & (F.col("_before") > 1), "end")
    return stepped.withColumn("event", event).filter(F.col("event").isNotNull()).select("value", "stream", "batch_id", "event", "holders")
