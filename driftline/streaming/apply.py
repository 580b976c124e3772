"""Continuous upsert: changes to a target table."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from driftline.operators.targets import TargetTable


def target_writer(
    changes: DataFrame,
    target: TargetTable,
    checkpoint: str,
    shape: Callable[[DataFrame], DataFrame] | None = None,
    compact_every: int | None = None,
) -> DataStreamWriter:
    """Writer that applies each micro-batch to the target.

    The newest change of a key wins by its own order, never by arrival, so late changes and
    repeated batches leave the same table.
    """

    # A stream is its checkpoint: batch numbers start over with a new one.
    stream = hashlib.md5(checkpoint.encode()).hexdigest()[:12]

    def apply(batch: DataFrame, batch_id: int) -> None:
        target.apply_batch(shape(batch) if shape else batch, batch_id, stream)
        if compact_every and (batch_id + 1) % compact_every == 0:
            target.compact()

    return changes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
