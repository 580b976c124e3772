"""Continuous landing: records to the audit table."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from driftline.operators.bronze import IDENTITY, unseen, write_batch


def run_available(writer: DataStreamWriter) -> None:
    """Process what is there and return; raises if the stream failed."""
    writer.trigger(availableNow=True).start().awaitTermination()


def dedupe_within(records: DataFrame, delay: str) -> DataFrame:
    """Drop repeats of a record that come within `delay` of each other.

    Records later than the delay are dropped too, so choose it above the source's real lateness;
    `bronze_writer` with `exact=True` has no such limit.
    """
    return records.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(list(IDENTITY))


def bronze_writer(
    records: DataFrame,
    to_changes: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    exact: bool = True,
    rebalance: bool = False,
) -> DataStreamWriter:
    """Writer that parses each micro-batch and stores it under its stream and batch id.

    The stream is known by its checkpoint, which numbers its batches.

    A repeated micro-batch replaces its own partitions. `exact` also leaves out records an
    earlier batch already stored, for landing areas that may hold a record twice.
    """

    stream = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]

    def store(batch: DataFrame, batch_id: int) -> None:
        changes = to_changes(batch)
        if exact:
            changes = unseen(changes, path, batch_id, stream=stream, records=batch)
        write_batch(changes, path, batch_id, rebalance, stream)

    return records.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
