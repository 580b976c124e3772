"""Continuous lag monitoring."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lag_windows(samples: DataFrame, time: str = "sampled_at", lag: str = "lag", every: str = "10 seconds",
                delay: str = "1 minute", by: tuple[str, ...] = ()) -> DataFrame:
    """Highest lag per interval; works on streams and on tables.

    The aggregate is combined before the shuffle, and a stream keeps only open intervals.
    """
    return (
        samples.withWatermark(time, delay)
        .groupBy(F.window(time, every), *by)
        .agg(F.max(lag).alias("max_lag"), F.count("*").alias("samples"))
        .select(*by, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "max_lag", "samples")
    )
