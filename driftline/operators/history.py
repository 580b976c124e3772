"""Versioned history of keyed changes, and reading it at a point in time."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.functions import from_millis
from driftline.operators.buckets import BUCKET, BucketTable
from driftline.operators.files import completed, remove
from driftline.operators.keyed import DEFAULT_POLICY, SkewPolicy, latest_per_key, over_key
from driftline.schemas import DELETE, UPSERTS
from driftline.session import if_small, stored

ORDER = ("cdc_timestamp_ms", "offset")


def scd2(
    changes: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = ORDER,
    semantics: str = "documented",
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Slowly changing dimension, type 2, from flat changes.

    `changes` has the keys and attributes as columns, `operation`, and `order`, whose first
    column is the epoch in milliseconds. "documented" counts versions upwards and ends one
    where the next change of the key begins, deletes included. "literal" ranks newest first,
    ignores deletes, and gives a past version its own start as end.
    """
    if semantics == "literal":
        return _literal(changes, keys, order, policy)
    if semantics != "documented":
        raise ValueError(f"unknown semantics {semantics!r}")
    is_version = F.when(F.col("operation") != DELETE, F.lit(1)).otherwise(F.lit(0))
    stepped = over_key(
        changes, keys, order, running={"version": is_version}, lead={"_next_ms": F.col(order[0])}, policy=policy
    )
    return stepped.filter(F.col("operation") != DELETE).select(
        *_attributes(changes, order),
        F.col("_next_ms").isNull().alias("is_current"),
        from_millis(F.col(order[0])).alias("valid_from"),
        from_millis(F.col("_next_ms")).alias("valid_to"),
        F.col("version").cast("int").alias("version"),
    )


def _literal(changes: DataFrame, keys: Sequence[str], order: Sequence[str], policy: SkewPolicy) -> DataFrame:
    kept = changes.filter(F.col("operation").isin(*UPSERTS))
    ranked = over_key(kept, keys, order, running={"version": F.lit(1)}, descending=True, policy=policy)
    at = from_millis(F.col(order[0]), whole_seconds=True)
    current = F.col("version") == 1
    return ranked.select(
        *_attributes(changes, order),
        at.alias("event_time"),
        current.alias("is_current"),
        at.alias("valid_from"),
        F.when(~current, at).alias("valid_to"),
        F.col("version").cast("int").alias("version"),
    )


def write_history(history: DataFrame, path: str) -> None:
    """Store a history by currentness, so that current rows are read without the past.

    Each write goes into a folder of its own, which counts once it is complete: a failed write leaves the last history as it is,
    and the history may be worked out from the one that is stored.
    """
    spark = history.sparkSession
    versions = _versions(spark, path)
    history.write.mode("overwrite").partitionBy("is_current").parquet(f"{path}/v={max(versions, default=0) + 1}")


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """The history last written."""
    newest = f"{path}/v={max(_versions(spark, path))}"
    return spark.read.parquet(newest).withColumn("is_current", F.col("is_current").cast("boolean"))


def expire_history(spark: SparkSession, path: str) -> None:
    """Delete all but the history last written. Readers that began before must have finished."""
    for version in sorted(_versions(spark, path))[:-1]:
        remove(spark, f"{path}/v={version}")


def _versions(spark: SparkSession, path: str) -> list[int]:
    return [int(name[2:]) for name in completed(spark, path)]


def _attributes(changes: DataFrame, order: Sequence[str]) -> list[str]:
    return [c for c in changes.columns if c not in (*order, "operation")]


def refresh_scd2(
    history: DataFrame,
    changes: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = ORDER,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """History after a batch: only keys in the batch are worked out again.

    `changes` holds every change including the batch. Other keys' versions pass through.
    """
    touched = if_small(batch.select(*keys).distinct())
    untouched = _null_safe_join(history, touched, keys, "left_anti")
    again = _null_safe_join(changes, touched, keys, "left_semi")
    return untouched.unionByName(scd2(again, keys, order, policy=policy))


@dataclass(frozen=True)
class HistoryTable:
    """Versioned history under `path`, into which batches of changes are spliced, late ones too.

    Each row is a change: its attributes, `operation`, the order columns, `version` (versions of the key so far) and `next`, the order
    of the key's next change. Deletes stay as rows, since a late change may come to lie before one. The table is a `BucketTable`:
    a batch reads and rewrites only buckets that have keys of it.
    """

    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    order: tuple[str, ...] = ORDER
    buckets: int = 16

    @property
    def table(self) -> BucketTable:
        return BucketTable(self.spark, self.path, tuple(self.keys), self.buckets)

    def apply_batch(self, changes: DataFrame, policy: SkewPolicy = DEFAULT_POLICY) -> None:
        """Splice the changes in. A change is known by its key and order, so a repeated batch alters nothing."""
        manifest = self.table.manifest()
        batch = stored(self.table.with_bucket(changes.dropDuplicates([*self.keys, *self.order]), manifest), "batch")
        # As many numbers as there are buckets.
        touched = [r[0] for r in batch.select(BUCKET).distinct().collect()]
        if touched:
            held = self.table.read(manifest, touched)
            self.table.replace(splice_scd2(held, batch, self.keys, self.order, policy), touched, manifest)

    def changes(self) -> DataFrame | None:
        """Every change with its version, deletes included."""
        rows = self.table.read()
        return None if rows is None else rows.drop(BUCKET)

    def read(self) -> DataFrame | None:
        """The history as `scd2` gives it."""
        rows = self.changes()
        if rows is None:
            return None
        attributes = [c for c in rows.columns if c not in (*self.order, "operation", "version", "next")]
        return rows.filter(F.col("operation") != DELETE).select(
            *attributes, F.col("next").isNull().alias("is_current"), from_millis(F.col(self.order[0])).alias("valid_from"),
            from_millis(F.col(f"next.{self.order[0]}")).alias("valid_to"), "version",
        )


def splice_scd2(
    held: DataFrame | None, changes: DataFrame, keys: Sequence[str], order: Sequence[str] = ORDER, policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Rows of a `HistoryTable` with the changes spliced in, without the log of earlier changes.

    Of a key in the batch, the version in force at its earliest change is found by the change that ends it, and only that and later rows are
    worked out again: the version in force gets a new end, and later versions count on from its number. Everything before it, and
    every other key, passes through. `changes` has each (key, order) once; those that are held already are left out.
    """
    columns = [c for c in changes.columns if c not in ("version", "next")]
    one = F.when(F.col("operation") != DELETE, F.lit(1)).otherwise(F.lit(0))
    at = F.struct(*order)
    if held is None:
        affected, passing = changes.withColumn("_counted", one), None
    else:
        there = held.select(*[F.col(c).alias(f"_h_{c}") for c in (*keys, *order)])
        known = reduce(lambda acc, c: acc & F.col(c).eqNullSafe(F.col(f"_h_{c}")), [*keys, *order], F.lit(True))
        fresh = stored(changes.join(there, known, "left_anti"), "fresh")
        earliest = fresh.groupBy(*[F.col(k).alias(f"_r_{k}") for k in keys]).agg(F.min(at).alias("_from"))
        same = reduce(lambda acc, k: acc & held[k].eqNullSafe(F.col(f"_r_{k}")), keys, F.lit(True))
        marked = held.join(if_small(stored(earliest, "earliest")), same, "left").drop(*[f"_r_{k}" for k in keys])
        again = F.col("_from").isNotNull() & (F.col("next").isNull() | (F.col("next") > F.col("_from")))
        passing = marked.filter(~again).drop("_from")
        # The version in force brings its number; all others add one each.
        counted = F.when(at < F.col("_from"), F.col("version")).otherwise(one)
        affected = marked.filter(again).withColumn("_counted", counted).drop("_from", "version", "next")
        affected = affected.unionByName(fresh.withColumn("_counted", one), allowMissingColumns=True)
        columns = list(dict.fromkeys([*[c for c in held.columns if c not in ("version", "next")], *columns]))
    stepped = over_key(affected, keys, order, running={"version": F.col("_counted")}, lead={"next": at}, policy=policy)
    stepped = stepped.select(*columns, F.col("version").cast("int").alias("version"), "next")
    return stepped if passing is None else passing.unionByName(stepped, allowMissingColumns=True)


def as_of_join(
    rows: DataFrame, history: DataFrame, keys: Sequence[str], time: str, policy: SkewPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Each row with `in_force`, the version of its key that was in force at its `time`, null if there was none.

    Rows and versions are put in one order of time per key, and the last version seen is held to the rows after it: one exchange and no
    range join, so neither many rows nor many versions of a key multiply. Keys that are too large are cut by `over_key`. A version begun
    at the row's very time is in force; one that ended then is not. Null times have none. Columns of the history other than
    the keys are the fields of `in_force`.
    """
    fields = [c for c in history.columns if c not in keys]
    version = history.filter(F.col("valid_from").isNotNull()).select(
        *keys, F.unix_micros("valid_from").alias("_at"), F.lit(0).alias("_kind"), F.col("version").cast("int").alias("_nth"),
        F.struct(*fields).alias("in_force"),
    )
    asked = rows.select(
        *keys, F.unix_micros(F.col(time).cast("timestamp")).alias("_at"), F.lit(1).alias("_kind"), F.lit(0).alias("_nth"), F.struct(*rows.columns).alias("_row")
    )
    both = version.withColumn("_row", F.lit(None).cast(asked.schema["_row"].dataType)).unionByName(
        asked.withColumn("in_force", F.lit(None).cast(version.schema["in_force"].dataType))
    )
    last = over_key(both, keys, ["_at", "_kind", "_nth"], held={"_held": F.col("in_force")}, policy=policy).filter("_kind = 1")
    ended = F.col("_held.valid_to").isNotNull() & (F.unix_micros("_held.valid_to") <= F.col("_at"))
    return last.select("_row.*", F.when(~F.coalesce(ended, F.lit(False)) & F.col("_at").isNotNull(), F.col("_held")).alias("in_force"))


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    other = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys])
    matches = reduce(lambda acc, k: acc & left[k].eqNullSafe(other[f"_r_{k}"]), keys, F.lit(True))
    return left.join(other, matches, how)


def current_state(history: DataFrame) -> DataFrame:
    return history.filter("is_current")


def state_as_of(history: DataFrame, moment: Column | str) -> DataFrame:
    """Versions in force at a moment: begun by then and not yet ended."""
    at = F.lit(moment).cast("timestamp") if isinstance(moment, str) else moment
    return history.filter((F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (F.col("valid_to") > at)))


def versions_of(history: DataFrame, key: str, value: object, newest_first: bool = True) -> DataFrame:
    """Every version of one key, in order."""
    rows = history.filter(F.col(key) == F.lit(value))
    return rows.orderBy(F.col("version").desc() if newest_first else F.col("version").asc())


def keys_with_history(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one version. Counts are combined before the shuffle."""
    return history.groupBy(*keys).agg(F.count("*").alias("version_count")).filter("version_count > 1")


def current_and_past_counts(history: DataFrame) -> DataFrame:
    return history.groupBy("is_current").agg(F.count("*").alias("versions"))


def latest_changes(changes: DataFrame, keys: Sequence[str], order: Sequence[str] = ORDER) -> DataFrame:
    """The newest change of each key, deletes included."""
    return latest_per_key(changes, keys, order)


def changed_fields(changes: DataFrame, fields: Sequence[str], before: str = "before", after: str = "after") -> DataFrame:
    """Add the names of the fields that differ between the two images.

    A missing image differs in every field it would have had that is not null on the other side.
    """
    differing = [
        F.when(~F.col(f"{before}.{n}").eqNullSafe(F.col(f"{after}.{n}")), F.lit(n)) for n in fields
    ]
    return changes.withColumn("changed_fields", F.array_compact(F.array(*differing)))


def with_previous_image(
    changes: DataFrame,
    keys: Sequence[str],
    image: str,
    order: Sequence[str] = ORDER,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Add `before`, the image of the key's preceding change, for sources that send none."""
    return over_key(changes, keys, order, lag={"before": F.col(image)}, policy=policy)


def as_of_batch(bronze: DataFrame, batch_id: int, stream: str = "batch", log: DataFrame | None = None) -> DataFrame:
    """The audit table as it stood after a batch of a stream; batches are partitions, so this prunes.

    Numbers count within a stream, so they say nothing of other streams: without a log only the batch's own stream is given. With
    the batch log, every stream's batches are that had been committed by then.
    """
    if log is None:
        return bronze.filter((F.col("stream") == stream) & (F.col("batch_id") <= batch_id))
    at = F.unix_micros("committed_at")
    moment = log.filter((F.col("stream") == stream) & (F.col("batch_id") == batch_id)).select(at).first()
    if moment is None:
        raise ValueError(f"no batch {batch_id} of stream {stream!r} is logged")
    # Batches of one moment are in the order of the log.
    by_then = F.struct(at.alias("at"), "stream", "batch_id") <= F.struct(
        F.lit(moment[0]).alias("at"), F.lit(stream).alias("stream"), F.lit(batch_id).cast("bigint").alias("batch_id")
    )
    committed = log.filter(by_then).select("stream", "batch_id")
    return bronze.join(if_small(committed), ["stream", "batch_id"], "left_semi")
