"""Source against target: counts, checksums, differences, lag and readiness to cut over."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.functions import row_digest
from driftline.operators.keyed import DEFAULT_POLICY, SkewPolicy, over_key
from driftline.operators.relations import tagged_counts
from driftline.session import if_small, stored


def compare_counts(source: Mapping[str, DataFrame], target: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts of both sides per table, and their difference."""
    left = tagged_counts(source).withColumnRenamed("row_count", "source_count")
    right = tagged_counts(target).withColumnRenamed("row_count", "target_count")
    joined = left.join(right, "table_name", "full_outer")
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("source_count", "target_count")]
    both = joined.select("table_name", *counts)
    return both.withColumn("delta", F.col("source_count") - F.col("target_count"))


def checksum(df: DataFrame, columns: Sequence[str | Column], by: Sequence[str] = ()) -> DataFrame:
    """Row count and the sum of row digests: independent of order, sensitive to duplicates.

    Give columns of a type both systems write alike; money as whole cents, times as micros.
    The sum is exact, as text because it exceeds a long.
    """
    parts = digest_parts(df, columns)
    sums = df.groupBy(*by).agg(F.count("*").alias("row_count"), *[F.coalesce(F.sum(p), F.lit(0)).alias(n) for n, p in parts.items()])
    return whole_checksum(sums, list(parts), by)


def digest_parts(df: DataFrame, columns: Sequence[str | Column]) -> dict[str, Column]:
    """The row digest in three parts of 20 bits: their sums stay longs, and cheap, for eight trillion rows."""
    columns = [F.col(c) if isinstance(c, str) else c for c in columns]
    kinds = [f.dataType for f in df.select(*[c.alias(f"_{i}") for i, c in enumerate(columns)]).schema.fields]
    digest = row_digest(columns, kinds)
    return {f"_p{i}": F.shiftright(digest, 20 * i).bitwiseAND(F.lit((1 << 20) - 1)) for i in range(3)}


def whole_checksum(sums: DataFrame, parts: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Row count and checksum from the sums of `digest_parts`."""
    high, *rest = reversed(parts)
    whole = reduce(
        lambda total, n: total * F.lit(1 << 20).cast("decimal(8,0)") + F.col(n), rest, F.col(high).cast("decimal(20,0)")
    )
    return sums.select(*by, "row_count", whole.cast("decimal(38,0)").cast("string").alias("checksum"))


def compare_checksums(source: DataFrame, target: DataFrame, columns: Sequence[str | Column]) -> DataFrame:
    """Both sides' checksums in one row."""
    a = checksum(source, columns).select(F.col("row_count").alias("source_rows"), F.col("checksum").alias("source_checksum"))
    b = checksum(target, columns).select(F.col("row_count").alias("target_rows"), F.col("checksum").alias("target_checksum"))
    same = (F.col("source_rows") == F.col("target_rows")) & (F.col("source_checksum") == F.col("target_checksum"))
    # Both sides are a single row.
    return a.withColumn("_one", F.lit(1)).join(b.withColumn("_one", F.lit(1)), "_one").drop("_one").withColumn("matches", same)


def diff_rows(source: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows that differ: `missing` in the target, `extra` there, or `mismatch` with the columns named.

    First the keys whose rows differ are found from 128-bit fingerprints, so whole rows are not
    shuffled. Equal fingerprints cancel out in an aggregation that combines before the shuffle, and
    a key repeated on both sides makes no pairs. The rows of those keys are then compared in full.

    Nulls equal nulls. Repeated keys are reported with their row counts; the columns are
    named where each side has one row left.
    """
    marks = _fingerprint(columns)
    sides = source.select(*keys, *marks, F.lit(1).alias("_side")).unionByName(
        target.select(*keys, *marks, F.lit(-1).alias("_side"))
    )
    unbalanced = sides.groupBy(*keys, "_f1", "_f2").agg(F.sum("_side").alias("_n")).filter("_n != 0")
    # Stored, so that its size is known before the full rows are read: few differences are
    # broadcast and then nothing but differing rows is shuffled.
    wanted = if_small(stored(unbalanced.select(*[F.col(k).alias(f"_k_{k}") for k in keys]).distinct(), "differing"))
    hit = reduce(lambda acc, k: acc & F.col(k).eqNullSafe(F.col(f"_k_{k}")), keys, F.lit(True))
    rows = source.select(*keys, *columns, F.lit(1).alias("_side")).unionByName(
        target.select(*keys, *columns, F.lit(-1).alias("_side"))
    )
    return _differences(rows.join(wanted, hit, "left_semi"), keys, columns)


def _fingerprint(columns: Sequence[str]) -> list[Column]:
    # The hash passes over nulls, so where they are is hashed as well.
    parts = [part for c in columns for part in (F.col(c), F.col(c).isNull())]
    return [F.xxhash64(*parts).alias("_f1"), F.xxhash64(F.lit("second"), *parts).alias("_f2")]


def _differences(sides: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    left_over = sides.groupBy(*keys, *columns).agg(F.sum("_side").alias("_n")).filter("_n != 0")
    on_source, on_target = F.col("_n") > 0, F.col("_n") < 0
    by_key = left_over.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(on_source, F.col("_n"))), F.lit(0)).alias("source_rows"),
        F.coalesce(F.sum(F.when(on_target, -F.col("_n"))), F.lit(0)).alias("target_rows"),
        *[F.max(F.when(on_source, F.col(c))).alias(f"_s_{c}") for c in columns],
        *[F.max(F.when(on_target, F.col(c))).alias(f"_t_{c}") for c in columns],
    )
    differing = [F.when(~F.col(f"_s_{c}").eqNullSafe(F.col(f"_t_{c}")), F.lit(c)) for c in columns]
    status = F.when(F.col("target_rows") == 0, "missing").when(F.col("source_rows") == 0, "extra").otherwise("mismatch")
    one_each = (F.col("source_rows") == 1) & (F.col("target_rows") == 1)
    return by_key.select(
        *keys,
        status.alias("status"),
        "source_rows",
        "target_rows",
        F.when(one_each, F.concat_ws(",", *differing)).alias("columns"),
    )


def sample_keys(df: DataFrame, keys: Sequence[str], per_256: int = 16) -> DataFrame:
    """Rows whose key's digest falls under a threshold: the same keys on every side and run."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return df.filter(F.conv(F.substring(F.md5(text), 1, 2), 16, 10).cast("int") < per_256)


def random_rows(df: DataFrame, n: int, seed: int | None = None) -> DataFrame:
    """Some rows at random, for a look at the data."""
    return df.orderBy(F.rand(seed)).limit(n)


def diff_sample(source: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str], per_256: int = 16) -> DataFrame:
    return diff_rows(sample_keys(source, keys, per_256), sample_keys(target, keys, per_256), keys, columns)


def consumer_lag(records: DataFrame, committed: DataFrame) -> DataFrame:
    """Messages not yet taken over, per topic and partition.

    `committed` has topic, partition and `committed_offset`, the last offset processed; a
    partition without one has everything still to do.
    """
    ends = records.groupBy("topic", "partition").agg(
        F.min("offset").alias("first_offset"), F.max("offset").alias("latest_offset")
    )
    reached = F.coalesce("committed_offset", F.col("first_offset") - 1)
    return ends.join(committed, ["topic", "partition"], "left").select(
        "topic", "partition", "latest_offset", "committed_offset", (F.col("latest_offset") - reached).alias("lag")
    )


def replication_lag(slots: DataFrame, current: str = "current_lsn", confirmed: str = "confirmed_flush_lsn") -> DataFrame:
    """Bytes a replication slot is behind; unknown stays null."""
    return slots.withColumn("lag_bytes", F.col(current) - F.col(confirmed))


def quiet_stretches(
    samples: DataFrame,
    keys: Sequence[str],
    time: str,
    tie: str,
    lag: Column,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Stretches of consecutive samples without lag, with their length.

    Counting the lagging samples so far numbers the stretches. `time` is in seconds. An unknown
    lag counts as lag.
    """
    lagging = F.coalesce(lag > 0, F.lit(True))
    busy = F.when(lagging, F.lit(1)).otherwise(F.lit(0))
    numbered = over_key(samples, keys, [time, tie], running={"_stretch": busy}, policy=policy)
    quiet = numbered.filter(~lagging)
    return quiet.groupBy(*keys, "_stretch").agg(
        F.min(time).alias("quiet_from"), F.max(time).alias("quiet_to"), F.count("*").alias("samples")
    ).select(*keys, "quiet_from", "quiet_to", "samples", (F.col("quiet_to") - F.col("quiet_from")).alias("quiet_seconds"))


def ready_to_cut_over(
    samples: DataFrame, keys: Sequence[str], time: str, lag: Column, hold_seconds: int = 60, max_gap: int | None = None
) -> DataFrame:
    """Per key, whether the lag has been zero for long enough up to the last sample.

    Zero counts from the first sample after the last second with lag, and an unknown lag is lag. With `max_gap`,
    it counts anew from a sample that comes more than so many seconds after the one before, since nobody looked in between.
    Samples are first combined to one row per key and second, before the shuffle, so that a
    key's rows in one task are bounded by the time observed.
    """
    from pyspark.sql import Window

    seconds = samples.groupBy(*keys, time).agg(F.max(F.coalesce(lag > 0, F.lit(True))).alias("_lagging"))
    broken = F.lit(False)
    if max_gap is not None:
        broken = F.col(time) - F.lag(time).over(Window.partitionBy(*keys).orderBy(time)) > max_gap
    seconds = seconds.withColumn("_broken", broken)
    ends = seconds.groupBy(*keys).agg(
        F.max(F.when(F.col("_lagging"), F.col(time))).alias("_busy"),
        F.max(F.when(F.col("_broken"), F.col(time))).alias("_anew"),
        F.max(time).alias("last_sample"),
    )
    after = seconds.select(*keys, time).join(ends, list(keys)).filter(F.col("_busy").isNull() | (F.col(time) > F.col("_busy")))
    held = after.groupBy(*keys).agg(F.min(time).alias("_quiet"))
    zero_since = F.when(F.col("_quiet").isNotNull(), F.greatest("_quiet", "_anew"))
    long_enough = F.coalesce(F.col("last_sample") - zero_since >= hold_seconds, F.lit(False))
    return ends.join(held, list(keys), "left").select(*keys, "last_sample", zero_since.alias("zero_since"), long_enough.alias("ready"))


def cutover_gate(**conditions: DataFrame) -> DataFrame:
    """One row that says whether every condition holds. Each condition is a frame with one
    boolean column; it holds when all its rows are true; a null is not true, and an empty one does not hold."""
    parts = [
        d.agg(F.coalesce(F.every(F.coalesce(F.col(d.columns[0]), F.lit(False))), F.lit(False)).alias(name)).withColumn("_one", F.lit(1))
        for name, d in conditions.items()
    ]
    joined = reduce(lambda a, b: a.join(b, "_one"), parts)
    together = reduce(lambda a, b: a & b, [F.col(n) for n in conditions])
    return joined.select(*conditions, together.alias("ready_to_cut_over"))
