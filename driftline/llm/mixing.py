"""A training mix of sources whose weights change over time."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.llm.common import WORD, text_or_empty
from driftline.session import stored

MOST_REPEATS = 3
# A source is summed up in 256 pieces at least, so that a large one is spread from the start.
LEAST_PIECE_BITS = 8
BASE_WEIGHTS = (1, 2, 3)
# Change of a source's weight over training, by its rank: falling, steady, rising.
SLOPES = (-1.0, 0.0, 1.0)


def word_count(text_col: str) -> Column:
    return F.regexp_count(text_or_empty(text_col), F.lit(WORD)).cast("long")


def targets(sources: DataFrame, weights: Sequence[float] = BASE_WEIGHTS, most: float = MOST_REPEATS) -> DataFrame:
    """Words wanted of each source, from one row per source with `source` and `source_size`.

    Sources take weights in turn, by code point, null last. The words wanted are all words there
    are, by weight, but of no source more than `most` times what it has: the excess goes to the
    others by weight. With the sources sorted by size per weight, those at their limit come first, so
    the level that the others share is found by running sums over the sources.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sources.withColumn("rank", F.row_number().over(by_name) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod("rank", F.lit(len(weights))) + 1)
    ranked = ranked.withColumn("weight", weight).withColumn("limit", F.col("source_size") * F.lit(float(most)))
    everything = Window.partitionBy()
    earlier = Window.orderBy(F.col("limit") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(earlier), F.lit(0.0))
    left_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))
    levelled = ranked.withColumn("level", left / left_weight)
    full = F.col("limit") < F.col("level") * F.col("weight")
    # The first source below its limit sets the level; those after it would set a lower one.
    marked = levelled.withColumn("full", full)
    level = F.max(F.when(~F.col("full"), F.col("level"))).over(everything)
    target = F.when(F.col("full"), F.col("limit")).otherwise(F.least(level * F.col("weight"), F.col("limit")))
    return marked.select("source", "source_size", "rank", target.alias("target"))


def _position(share: Column, slope: Column) -> Column:
    """When a source's demand reaches a share of its words, training being the interval 0 to 1.

    A weight of 1 - slope/2 + slope t at time t adds up to (1 - slope/2) t + slope t^2 / 2 by then;
    this is that function's inverse.
    """
    base = 1 - slope / 2
    curved = (F.sqrt(base * base + 2 * slope * share) - base) / F.when(slope == 0, F.lit(1.0)).otherwise(slope)
    return F.when(slope == 0, share).otherwise(curved)


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *,
    weights: Sequence[float] = BASE_WEIGHTS, most_repeats: int = MOST_REPEATS, slopes: Sequence[float] = SLOPES,
    rows_per_piece: int = 100_000, keep: Sequence[str] = (),
) -> DataFrame:
    """One row per document with its size, its source's size and target, and what the mix takes of it.

    A source's documents stand in a fixed random order (a hash of id and text). The mix reads that
    order from its start, over and over, until the source's target is met: each document is taken
    `copies` times, whole, and the last pass ends at the document whose middle lies at the target.
    So a source's taken words are within half a document of its target. `positions` says when
    in training each copy comes: the source's weight is a line over time, its integral is the
    demand for the source's words, and the copy's place in the order is put into the inverse.

    The order is summed up in pieces of a source, dealt by the hash, and the pieces in one
    row each, so that a source of any size is spread over the cluster.

    A null text has no words and is never taken; a null source is a source, the last one.
    Repeated rows are taken like others. `keep` names further input columns to carry along.
    """
    order = F.xxhash64(F.col(id_col), text_or_empty(text_col))
    base = docs.select(
        F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), word_count(text_col).alias("_size"), order.alias("_order"),
        *[F.col(c).alias(f"_keep_{i}") for i, c in enumerate(keep)],
    )
    sizes = stored(base.select("_source", "_size", "_order"), "sizes")
    rows = sizes.count()
    bits = max(LEAST_PIECE_BITS, min(20, ceil(rows / rows_per_piece).bit_length()))
    piece = F.shiftrightunsigned("_order", 64 - bits).alias("_piece")
    pieces = stored(sizes.groupBy("_source", piece).agg(F.sum("_size").alias("_words")), "pieces")
    # One row per source from here: a source has at most 2^20 pieces.
    wanted = stored(targets(pieces.groupBy(F.col("_source").alias("source")).agg(F.sum("_words").alias("source_size")), weights, most_repeats), "targets")
    before = Window.partitionBy("_source").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.withColumn("_start", F.coalesce(F.sum("_words").over(before), F.lit(0)))
    starts = starts.join(wanted, F.col("_source").eqNullSafe(F.col("source"))).drop("source", "_words")
    starts = starts.withColumnRenamed("_source", "_of").withColumnRenamed("_piece", "_in")

    within = Window.partitionBy("_source", "_piece").orderBy("_order", "_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = base.withColumn("_piece", piece).withColumn("_before", F.coalesce(F.sum("_size").over(within), F.lit(0)))
    placed = placed.join(starts, F.col("_source").eqNullSafe(F.col("_of")) & (F.col("_piece") == F.col("_in")))
    middle = F.col("_start") + F.col("_before") + F.col("_size") / 2
    passes = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size") + 1e-12), F.lit(most_repeats))).otherwise(0)
    rest = F.col("target") - F.col("passes") * F.col("source_size")
    copies = F.when(F.col("_size") == 0, F.lit(0)).otherwise(
        F.col("passes") + F.when((middle < rest) & (F.col("passes") < most_repeats), F.lit(1)).otherwise(F.lit(0))
    )
    slope = F.element_at(F.array(*[F.lit(float(s)) for s in slopes]), F.pmod("rank", F.lit(len(slopes))) + 1)
    placed = placed.withColumn("passes", passes.cast("int")).withColumn("copies", copies.cast("int")).withColumn("_middle", middle)
    positions = F.transform(
        F.when(F.col("copies") > 0, F.sequence(F.lit(0), F.col("copies") - 1)).otherwise(F.array().cast("array<int>")),
        lambda nth: _position(F.least((nth * F.col("source_size") + F.col("_middle")) / F.col("target"), F.lit(1.0)), slope),
    )
    return placed.select(
        F.col("_id").alias("doc_id"), F.col("_source").alias("source"), F.col("_size").alias("size"), "source_size", "target",
        (F.col("_size") * F.col("copies")).alias("taken"), "copies", positions.alias("positions"),
        *[F.col(f"_keep_{i}") for i in range(len(keep))],
    )


def by_position(mixed: DataFrame) -> DataFrame:
    """The mix as it is trained on: a row for each copy, range-sorted by its position."""
    return mixed.withColumn("position", F.explode("positions")).drop("positions").orderBy("position", "doc_id")
