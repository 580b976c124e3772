"""Columns that are costly to compute."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that later filters and projections read instead of recomputing.

    The optimizer moves a filter below the projection it depends on and repeats the expression
    for every mention, so a filter on parsed JSON would parse each record a dozen times. It does
    not move filters below a generator.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))
