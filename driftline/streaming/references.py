"""References checked while both sides still arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def orphan_stream(
    children: DataFrame, child_key: str, child_time: str, parents: DataFrame, key: str, parent_time: str,
    patience: str = "1 hour", lookback: str = "1 day", delay: str = "10 minutes", known: DataFrame | None = None,
) -> DataFrame:
    """The children whose parent does not come: a stream of their rows, each given out when its time is up.

    A child is at home if a parent of its key comes from `lookback` before it to `patience` after it, both by their own times. It waits in
    the join's state until then; when the watermark of both streams (`delay` behind the newest row) has passed that moment, it comes
    out as an orphan. Both sides' states hold no more than these intervals. `known` are parents of a stored table, for those that came long
    before: their children do not wait. A child without a reference is no orphan, and one that many parents match is at home once.
    """
    waiting = children.filter(F.col(child_key).isNotNull())
    if known is not None:
        there = known.select(F.col(key).alias("_known")).filter("_known IS NOT NULL").distinct()
        waiting = waiting.join(there, F.col(child_key) == F.col("_known"), "left_anti")
    left = waiting.withWatermark(child_time, delay)
    right = parents.select(F.col(key).alias("_key"), F.col(parent_time).alias("_at")).withWatermark("_at", delay)
    in_time = (F.col("_at") >= F.col(child_time) - F.expr(f"INTERVAL {lookback}")) & (F.col("_at") <= F.col(child_time) + F.expr(f"INTERVAL {patience}"))
    joined = left.join(right, (F.col(child_key) == F.col("_key")) & in_time, "left_outer")
    return joined.filter(F.col("_key").isNull()).drop("_key", "_at")
