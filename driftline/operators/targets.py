"""Loading target tables: shaping, insert-or-ignore, upsert with deletes, tracking.

Parquet tables have no MERGE. A target is therefore a compacted base plus the reduced
changes of the batches since, and reading it takes the newest row of each key. A batch costs
what it changes, not what the table holds; `compact` folds batches into the buckets of the base that they touch.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.functions import clamp_at_zero, document_time, from_micros, map_values
from driftline.operators.buckets import BUCKET, BucketTable, Manifest
from driftline.operators.files import completed, located, remove
from driftline.operators.keyed import latest_per_key
from driftline.schemas import (
    DELETE,
    DOCUMENT_SYSTEM,
    EVENT_TYPE_MAP,
    MONEY,
    RELATIONAL_SYSTEM,
    TRACKING,
)
from driftline.session import BROADCAST_BYTES, estimated_bytes, few_rows

ORDER = ("cdc_timestamp_ms", "offset")


def _now(run_ts: Column | None) -> Column:
    return F.current_timestamp() if run_ts is None else run_ts


def shape_customers(flat: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """Flat customer changes as rows of the customer target. Rows without a key have no place there."""
    return flat.filter(F.col("customer_id").isNotNull()).select(
        "customer_id", "email", "full_name", "phone",
        from_micros(F.col("created_at")).alias("created_at"),
        from_micros(F.col("updated_at")).alias("updated_at"),
        F.lit(RELATIONAL_SYSTEM).alias("source_system"),
        _now(run_ts).alias("migrated_at"),
        F.col("lsn").cast("string").alias("cdc_lsn"),
    )


def shape_orders(flat: DataFrame, run_ts: Column | None = None, statuses: Mapping[str, str] | None = None) -> DataFrame:
    """Flat order changes as rows of the order target. `statuses` says what a source status is called there; others stay as they are,
    for `quality.allowed` to report, and a missing one is pending."""
    status = F.coalesce(map_values(F.col("status"), statuses) if statuses else F.col("status"), F.lit("pending"))
    return flat.filter(F.col("order_id").isNotNull()).select(
        "order_id", "customer_id", F.col("total_amount").cast(MONEY).alias("total_amount"), status.alias("status"), "payment_method",
        from_micros(F.col("created_at")).alias("created_at"),
        from_micros(F.col("updated_at")).alias("updated_at"),
        F.lit(RELATIONAL_SYSTEM).alias("source_system"),
        _now(run_ts).alias("migrated_at"),
        F.col("lsn").cast("string").alias("cdc_lsn"),
    )


def shape_order_items(flat: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """Flat item changes as rows of the order item target."""
    return flat.filter(F.col("item_id").isNotNull()).select(
        "item_id", "order_id", "product_name", "quantity", F.col("price").cast(MONEY).alias("price"),
        from_micros(F.col("created_at")).alias("created_at"),
        F.lit(RELATIONAL_SYSTEM).alias("source_system"),
        _now(run_ts).alias("migrated_at"),
        F.col("lsn").cast("string").alias("cdc_lsn"),
    )


def shape_events(flat: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """Flat event documents as rows of the event target; the details travel as JSON."""
    return flat.filter(F.col("operation").isin("r", "c")).select(
        "event_id", "customer_id",
        map_values(F.col("event_type"), EVENT_TYPE_MAP).alias("event_type"),
        F.to_json(F.struct("page", "device", "session_id", "ip_address")).alias("event_data"),
        document_time(F.col("event_occurred_at")).alias("event_timestamp"),
        F.lit(DOCUMENT_SYSTEM).alias("source_system"),
        _now(run_ts).alias("migrated_at"),
        F.col("mongo_id").alias("mongo_object_id"),
    )


def shape_inventory(flat: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """Flat inventory documents as rows of the inventory target; quantities below zero become zero."""
    return flat.filter(F.col("operation").isin("r", "c")).select(
        F.col("mongo_id").alias("snapshot_id"),
        "product_id",
        clamp_at_zero(F.col("quantity")).alias("quantity"),
        F.col("warehouse").alias("warehouse_location"),
        F.to_json(F.struct("reorder_point", "unit_cost", "status")).alias("snapshot_data"),
        document_time(F.col("last_updated")).alias("snapshot_timestamp"),
        F.lit(DOCUMENT_SYSTEM).alias("source_system"),
        _now(run_ts).alias("migrated_at"),
        F.col("mongo_id").alias("mongo_object_id"),
    )


def insert_or_ignore(
    target: DataFrame | None, rows: DataFrame, keys: Sequence[str], order: Sequence[str], broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """The rows an insert that skips existing keys would add: the first of each key not in the target.

    `order` says which of several rows with one key comes first. The first is found before the
    shuffle, and the target only contributes its keys. Rows of a checked small size broadcast their keys, so
    that the target is read without a shuffle and yields just those keys of theirs that it has.
    """
    from pyspark.sql import Window

    earliest = Window.partitionBy(*keys).orderBy(*[F.col(c) for c in order])
    first = rows.withColumn("_rank", F.row_number().over(earliest)).filter("_rank = 1").drop("_rank")
    if target is None:
        return first
    present = target.select(*keys)
    size = estimated_bytes(rows)
    if size is not None and size <= broadcast_bytes:
        # No more keys than the rows have.
        present = F.broadcast(present.join(F.broadcast(rows.select(*keys).distinct()), list(keys), "left_semi").distinct())
    return first.join(present, list(keys), "left_anti")


def apply_changes(
    state: DataFrame | None,
    changes: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = ORDER,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """State after the changes: the newest row per key wins, wherever it came from.

    `state` has one row per key. Deletes stay as rows, so that an older change that arrives
    later cannot bring the key back. The result does not depend on arrival order, and applying
    a batch again changes nothing. Of rows with one key and equal order the state's stays. A column that only one
    side has is null in the other's rows.

    Changes of a checked small size are joined in by broadcasting their keys, so the state is
    read without a shuffle, though twice: it should be a stored table. Beyond that size both
    are ranked together by key.
    """
    if state is None:
        return latest_per_key(changes, keys, order)
    size = estimated_bytes(changes)
    if size is None or size > broadcast_bytes:
        both = state.withColumn("_held", F.lit(1)).unionByName(changes.withColumn("_held", F.lit(0)), allowMissingColumns=True)
        return latest_per_key(both, keys, [*order, "_held"]).drop("_held")

    newest = latest_per_key(changes, keys, order)
    columns = [*keys, *[c for c in order if c not in keys]]
    marks = F.broadcast(newest.select(*[F.col(c).alias(f"_c_{c}") for c in columns]))
    same_key = reduce(lambda acc, k: acc & F.col(k).eqNullSafe(F.col(f"_c_{k}")), keys, F.lit(True))
    held, offered = F.struct(*order), F.struct(*[F.col(f"_c_{c}").alias(c) for c in order])
    kept = state.join(marks, same_key & (offered > held), "left_anti")
    outdated = state.select(*columns).join(marks, same_key & (offered <= held)).select(
        *[F.col(f"_c_{k}").alias(f"_o_{k}") for k in keys]
    )
    is_outdated = reduce(lambda acc, k: acc & F.col(k).eqNullSafe(F.col(f"_o_{k}")), keys, F.lit(True))
    return kept.unionByName(newest.join(F.broadcast(outdated), is_outdated, "left_anti"), allowMissingColumns=True)


def live(state: DataFrame) -> DataFrame:
    """The rows that exist, without the marks of deleted keys."""
    return state.filter(F.col("operation") != DELETE)


@dataclass(frozen=True)
class TargetTable:
    """A keyed table under `path`: a base in buckets of keys, and in `delta` the batches since.

    The base is a `BucketTable`: `compact` rewrites only buckets that a batch has touched and then publishes a manifest,
    which also names the batches the base contains. So a failed compaction leaves no trace. A repeated batch overwrites its own
    folder. Batches are named by stream and number: a stream that starts over under another
    name never collides with the batches of its predecessor. `buckets` counts for a new table only; choose it so
    that a bucket fits a task.
    """

    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    order: tuple[str, ...] = ORDER
    buckets: int = 16

    @property
    def base(self) -> BucketTable:
        return BucketTable(self.spark, f"{self.path}/base", tuple(self.keys), self.buckets)

    def apply_batch(self, changes: DataFrame, batch_id: int, stream: str = "batch") -> None:
        """Record a batch, reduced to one row per key.

        A number that the base already contains is recorded anew: applying the same changes
        again alters nothing, and other changes under a used number are not lost.
        """
        manifest = self.base.manifest()
        name = f"{stream}-{batch_id}"
        if name in _folded(manifest):
            name += f"-v{manifest.version}"
        newest = self.base.with_bucket(latest_per_key(changes, self.keys, self.order), manifest)
        newest.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.path}/delta/batch={name}")

    def state(self) -> DataFrame | None:
        """Newest row per key, deletes included; None before the first batch."""
        manifest = self.base.manifest()
        held = self.base.read(manifest)
        deltas = self._deltas(self._pending(manifest))
        if deltas is None:
            return None if held is None else held.drop(BUCKET)
        return apply_changes(held, deltas, self.keys, self.order).drop(BUCKET)

    def read(self) -> DataFrame | None:
        state = self.state()
        return None if state is None else live(state)

    def compact(self, forget_before: int | None = None) -> None:
        """Fold all batches so far into the base. Only buckets with changes are read and written; files of others stay.

        Marks of keys deleted before `forget_before` (by the first order column) are dropped in these buckets: give it where no
        older change can arrive any more. Replaced files stay for readers that still use them; names of batches
        that `expire` has removed are dropped.
        """
        manifest = self.base.manifest()
        pending = self._pending(manifest)
        deltas = self._deltas(pending)
        if deltas is None:
            return
        there = set(self._recorded())
        notes = {"folded": sorted({*pending, *(_folded(manifest) & there)})}
        touched = self._touched(pending)
        state = apply_changes(self.base.read(manifest, touched), deltas, self.keys, self.order)
        if forget_before is not None:
            forgotten = (F.col("operation") == DELETE) & (F.col(self.order[0]) < forget_before)
            state = state.filter(~F.coalesce(forgotten, F.lit(False)))
        self.base.replace(state, touched, manifest, notes)

    def expire(self) -> None:
        """Delete what the current base has replaced: older versions of buckets and the batches folded into it.

        Readers that began before the last `compact` must have finished.
        """
        for name in _folded(self.base.manifest()):
            remove(self.spark, f"{self.path}/delta/batch={name}")
        self.base.expire()

    def _deltas(self, names: list[str]) -> DataFrame | None:
        folders = [f"{self.path}/delta/batch={n}" for n in names if self._touched([n])]
        if not folders:
            return None
        # Batches may differ in columns, since a source gains some over time.
        found = self.spark.read.option("mergeSchema", True).option("basePath", f"{self.path}/delta").parquet(*folders)
        return found.drop("batch").withColumn(BUCKET, F.col(BUCKET).cast("int"))

    def _touched(self, names: list[str]) -> list[int]:
        """Buckets that the batches have rows of, by the names of their folders."""
        found = set()
        for name in names:
            fs, folder = located(self.spark, f"{self.path}/delta/batch={name}/{BUCKET}=*")
            found |= {int(s.getPath().getName().split("=")[1]) for s in fs.globStatus(folder) or ()}
        return sorted(found)

    def _pending(self, manifest: Manifest) -> list[str]:
        return sorted(set(self._recorded(_folded(manifest))))

    def _recorded(self, skip: Collection[str] = ()) -> list[str]:
        prefix = "batch="
        found = completed(self.spark, f"{self.path}/delta", skip={f"{prefix}{n}" for n in skip})
        return [n.removeprefix(prefix) for n in found]


def _folded(manifest: Manifest) -> set[str]:
    # One short name per batch.
    return set(manifest.notes.get("folded", ()))


# Which target each source feeds.
TRACKED_PAIRS = (
    ("customers", "target_customers"),
    ("orders", "target_orders"),
    ("order_items", "target_order_items"),
    ("customer_events", "target_customer_events"),
    ("inventory_snapshots", "target_inventory_snapshots"),
)


def seed_tracking(spark: SparkSession, topics: dict[str, str] | None = None) -> DataFrame:
    """Tracking rows before anything has been migrated; `topics` gives the topic of a source."""
    topics = topics or {}
    rows = [(s, t, topics.get(s), 0, None, "in_progress", None) for s, t in TRACKED_PAIRS]
    return few_rows(spark, TRACKING, rows)


def load_counts(rows: DataFrame, target_table: str | Column) -> DataFrame:
    """What a batch adds to a target: rows, last time and highest offset."""
    name = target_table if isinstance(target_table, Column) else F.lit(target_table)
    return rows.groupBy(name.alias("target_table")).agg(
        F.count("*").alias("rows_added"),
        F.max("migrated_at").alias("batch_migrated_at"),
        F.max("offset").alias("batch_offset"),
    )


def record_loads(counts: DataFrame, path: str, batch_id: int, stream: str = "batch") -> None:
    """Keep what a stream's batch added under its number; recording it again replaces it."""
    counts.write.mode("overwrite").parquet(f"{path}/stream={stream}/batch={batch_id}")


def recorded_loads(spark: SparkSession, path: str) -> DataFrame:
    """All recorded batches together, per target."""
    return spark.read.parquet(path).groupBy("target_table").agg(
        F.sum("rows_added").alias("rows_added"),
        F.max("batch_migrated_at").alias("batch_migrated_at"),
        F.max("batch_offset").alias("batch_offset"),
    )


def update_tracking(tracking: DataFrame, counts: DataFrame) -> DataFrame:
    """Tracking rows after a batch. Targets the batch did not touch keep their figures."""
    joined = tracking.join(counts, "target_table", "left")
    return joined.select(
        "source_table", "target_table", "kafka_topic",
        (F.col("total_records_migrated") + F.coalesce("rows_added", F.lit(0))).alias("total_records_migrated"),
        F.greatest("last_migrated_at", "batch_migrated_at").alias("last_migrated_at"),
        "migration_status",
        F.greatest("last_kafka_offset", "batch_offset").alias("last_kafka_offset"),
    )
