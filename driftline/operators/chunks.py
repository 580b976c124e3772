"""Snapshots read in chunks while changes go on, merged with the log."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.operators.keyed import latest_per_key


def merge_chunks(
    chunks: DataFrame, log: DataFrame, keys: Sequence[str], position: str = "offset", low: str = "low", high: str = "high"
) -> DataFrame:
    """The log with the chunks' rows as reads in it, in an order of `position` in which the newest row of a key is right.

    A chunk was read at some moment between two marks in the log, at the positions `low` and `high` that its rows carry. A row whose key has a
    change between the marks may be older or newer than that change, so it yields to the log; every other row is as the
    table was at the high mark, and takes that place: after the changes up to it, before all later ones. A chunk row comes as operation
    "r" with `high` as its position and `from_chunk` set. Columns that either side lacks are null.

    Chunks may overlap and be repeated, and a key deleted before its chunk was read simply is not in it. Keys with null match null.
    """
    seen = log.select(*[F.col(k).alias(f"_l_{k}") for k in keys], F.col(position).alias("_at"))
    # Changes outside all marks cannot displace a row.
    first, last = chunks.agg(F.min(low), F.max(high)).first()
    seen = seen.filter((F.col("_at") > F.lit(first)) & (F.col("_at") <= F.lit(last)))
    same = reduce(lambda acc, k: acc & F.col(k).eqNullSafe(F.col(f"_l_{k}")), keys, F.lit(True))
    between = (F.col("_at") > F.col(low)) & (F.col("_at") <= F.col(high))
    kept = chunks.join(seen, same & between, "left_anti")
    rows = kept.withColumns({"operation": F.lit("r"), position: F.col(high), "from_chunk": F.lit(True)}).drop(low, high)
    return rows.unionByName(log.withColumn("from_chunk", F.lit(False)), allowMissingColumns=True)


def state_of(merged: DataFrame, keys: Sequence[str], position: str = "offset") -> DataFrame:
    """The newest row of each key in merged chunks and changes, deletes included. At one position a change is older than a chunk's row."""
    order = [position, "_read"]
    return latest_per_key(merged.withColumn("_read", F.col("from_chunk").cast("int")), keys, order).drop("_read")
