"""Digests over ranges of a key on several levels, so that two tables are compared where they differ alone."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.operators.validate import diff_rows, digest_parts
from driftline.session import stored

# Rows of the sample per range, which reach the driver.
SAMPLE_PER_RANGE = 64
MOST_CONDITIONS = 64


@dataclass(frozen=True)
class Ranges:
    """Sorted keys at which the ranges after the first begin. Null keys lie in a range of their own, -1."""

    key: str
    bounds: tuple

    def place(self) -> Column:
        """The number of bounds that the key has reached, by halving, as compiled conditions."""

        def within(low: int, high: int) -> Column:
            if low == high:
                return F.lit(low)
            middle = (low + high) // 2
            return F.when(F.col(self.key) < F.lit(self.bounds[middle]), within(low, middle)).otherwise(within(middle + 1, high))

        return F.when(F.col(self.key).isNull(), F.lit(-1)).otherwise(within(0, len(self.bounds)))

    def condition(self, ranges: Sequence[int], most: int = MOST_CONDITIONS) -> Column:
        """Whether the key lies in one of the ranges, in plain comparisons that reach the scan.

        Neighbouring ranges are put together; of more than `most` stretches the closest are joined, which reads more, never less.
        """
        stretches: list[list[int]] = []
        for r in sorted(r for r in ranges if r >= 0):
            if stretches and r == stretches[-1][1] + 1:
                stretches[-1][1] = r
            else:
                stretches.append([r, r])
        while len(stretches) > most:
            i = min(range(len(stretches) - 1), key=lambda i: stretches[i + 1][0] - stretches[i][1])
            stretches[i : i + 2] = [[stretches[i][0], stretches[i + 1][1]]]
        found = F.col(self.key).isNull() if -1 in ranges else F.lit(False)
        for low, high in stretches:
            inside = F.col(self.key).isNotNull()
            if low > 0:
                inside &= F.col(self.key) >= F.lit(self.bounds[low - 1])
            if high < len(self.bounds):
                inside &= F.col(self.key) < F.lit(self.bounds[high])
            found |= inside
        return found


def ranges_of(df: DataFrame, key: str, ranges: int = 256) -> Ranges:
    """Ranges of about equal size, from a sample by hash that grows with the number of ranges, not with the table."""
    sample = df.select(key).filter(F.col(key).isNotNull()).orderBy(F.xxhash64(key), key).limit(ranges * SAMPLE_PER_RANGE)
    keys = sorted(r[0] for r in sample.collect())
    return Ranges(key, tuple(sorted({keys[len(keys) * i // ranges] for i in range(1, ranges)})) if keys else ())


def range_digests(df: DataFrame, ranges: Ranges, columns: Sequence[str]) -> DataFrame:
    """Stored rows `range`, `row_count` and the parts of an additive digest: one pass, combined before the exchange.

    A side may keep these, and send them instead of its rows.
    """
    parts = digest_parts(df, [ranges.key, *columns])
    sums = [F.coalesce(F.sum(p), F.lit(0)).alias(n) for n, p in parts.items()]
    return stored(df.groupBy(ranges.place().alias("range")).agg(F.count("*").alias("row_count"), *sums), "digests")


def differing_ranges(source: DataFrame, target: DataFrame, fanout: int = 8) -> list[int]:
    """Ranges in which two sides' digests differ, found from the root down: a node's children are looked at only if it differs.

    No more numbers reach the driver than there are ranges.
    """
    sums = [c for c in source.columns if c != "range"]
    both = source.withColumn("_side", F.lit(1)).unionByName(target.withColumn("_side", F.lit(-1)))
    signed = both.select("range", *[(F.col(c) * F.col("_side")).alias(c) for c in sums])
    top = both.agg(F.max("range")).first()[0]
    if top is None:
        return []
    level = 0
    while fanout**level <= top:
        level += 1
    suspects: list[int] | None = None
    for depth in range(level, -1, -1):
        width = fanout**depth
        # Null keys, range -1, are a node of their own on every level.
        node = F.floor(F.col("range") / width).cast("int")
        parent = F.floor(F.col("range") / (width * fanout)).cast("int")
        rows = signed if suspects is None else signed.filter(parent.isin(*suspects))
        totals = rows.groupBy(node.alias("node")).agg(*[F.sum(c).alias(c) for c in sums])
        suspects = [r["node"] for r in totals.filter(" OR ".join(f"`{c}` <> 0" for c in sums)).select("node").collect()]
        if not suspects:
            return []
    return sorted(suspects)


def diff_by_tree(
    source: DataFrame, target: DataFrame, key: str, columns: Sequence[str], ranges: int = 256, fanout: int = 8,
    bounds: Ranges | None = None, source_digests: DataFrame | None = None, target_digests: DataFrame | None = None,
) -> DataFrame:
    """What `diff_rows` reports, with only those key ranges read whose digests differ.

    Digests that a side keeps are taken as they are; others are computed in one pass over the key and the columns. On tables sorted or
    partitioned by the key the conditions on it spare the files of all other ranges.
    """
    bounds = bounds or ranges_of(source, key, ranges)
    found = differing_ranges(
        range_digests(source, bounds, columns) if source_digests is None else source_digests,
        range_digests(target, bounds, columns) if target_digests is None else target_digests, fanout,
    )
    inside = bounds.condition(found)
    return diff_rows(source.filter(inside), target.filter(inside), [key], columns)
