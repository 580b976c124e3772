"""Balanced shards by histogram sort."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.llm.common import text_or_empty, unused
from driftline.session import stored

ROW_OVERHEAD = 16
# The sort key: 40 bits of the text's hash, then 22 of the row's, used only to cut a group.
GROUP_BITS, ROW_BITS = 40, 22
KEY_BITS = GROUP_BITS + ROW_BITS
FIRST_PROBE_BITS, PROBE_BITS = 12, 10
LARGE_PART = 16


def _group(text: str) -> Column:
    return F.pmod(F.xxhash64(text_or_empty(text)), F.lit(1 << GROUP_BITS))


def _row(id_col: str, text: str) -> Column:
    return F.pmod(F.xxhash64(F.col(id_col), F.length(text_or_empty(text)), F.lit("row")), F.lit(1 << ROW_BITS))


def text_bytes(text: str) -> Column:
    return (F.octet_length(text_or_empty(text)) + ROW_OVERHEAD).cast("long")


def _key(group: Column, row: Column, cut: Sequence[int]) -> Column:
    """Rows of one text share a key, unless the text is one of those to be cut."""
    whole = F.shiftleft(group, ROW_BITS)
    return F.when(group.isin(*cut), whole + row).otherwise(whole) if cut else whole


def _histogram(sizes: DataFrame, shift: int, open_prefixes: Sequence[int] | None, open_shift: int) -> dict[int, int]:
    """Exact bytes below each probe: sums per prefix of the key, over the open intervals only."""
    if open_prefixes is not None:
        sizes = sizes.filter(F.shiftright("key", open_shift).isin(*open_prefixes))
    sums = sizes.groupBy(F.shiftright("key", shift).alias("prefix")).agg(F.sum("size").alias("bytes"))
    return {r["prefix"]: r["bytes"] for r in sums.collect()}


def splitters(sizes: DataFrame, total: int, shards: int, tolerance: float) -> list[int]:
    """Keys at which the shards after the first begin, found by refining probes.

    Each round counts the bytes between evenly spaced probes inside the interval of every
    splitter that is still open, exactly and over all partitions, and keeps the interval
    that holds the wanted count. A splitter is settled when its interval's bytes are within the
    tolerance or its probes cannot be told apart any more; it then takes the nearer end.
    The driver receives at most 4096 sums in the first round and 1024 per splitter later.
    """
    wanted = {j: total * j / shards for j in range(1, shards)}
    settled: dict[int, int] = {}
    # Splitter -> (prefix of its interval, bytes below the interval).
    inside: dict[int, tuple[int, int]] = {}
    shift, before = KEY_BITS, KEY_BITS
    while wanted:
        shift = max(0, before - (FIRST_PROBE_BITS if before == KEY_BITS else PROBE_BITS))
        prefixes = sorted({p for p, _ in inside.values()}) if inside else None
        sums = _histogram(sizes, shift, prefixes, before)
        for j in sorted(wanted):
            parent, below = inside.get(j, (0, 0))
            own = sorted(p for p in sums if p >> (before - shift) == parent)
            for prefix in own:
                if below + sums[prefix] >= wanted[j]:
                    break
                below += sums[prefix]
            inside[j] = (prefix, below)
            if sums[prefix] <= tolerance * total / shards or shift == 0:
                nearer_end = wanted[j] - below > below + sums[prefix] - wanted[j]
                settled[j] = (prefix + nearer_end) << shift
                del wanted[j], inside[j]
        before = shift
    return [settled[j] for j in sorted(settled)]


def _place(key: Column, cuts: Sequence[int]) -> Column:
    """How many of the sorted cuts the key has reached, by halving, as compiled conditions."""

    def within(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(key < cuts[middle], within(low, middle)).otherwise(within(middle + 1, high))

    return within(0, len(cuts))


def shard(
    docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text", *,
    tolerance: float = 0.001, rows_per_piece: int = 200_000,
) -> DataFrame:
    """All rows with `size`, `law`, `shard` and `slot`, under the law of near equal bytes.

    A row's size is the UTF-8 bytes of its text (null: none) plus 16. Rows are ordered by a hash of
    the text, so equal texts share a shard; only a text whose copies outweigh a whole shard is cut
    into the shards it needs. Splitters come from `splitters`; then rows are
    exchanged once. Slots count up from 0 without gaps: a shard is numbered in pieces dealt
    by the row's hash, so neither a large shard nor a repeated text is sorted in one task. Rows of texts with
    more than a 16th of a shard are stored with a number of their own to be dealt by, so rows equal in everything are cut as well.

    Empty input gives no rows. Null ids and repeated rows are rows like any other. Columns
    that the result adds replace input columns of the same name; others may have any name.
    """
    added = ("size", "law", "shard", "slot")
    docs = docs.drop(*(c for c in added if c not in (id_col, text_col)))
    own_key, own_piece, own_row, before, nth = unused(docs, "_key", "_piece", "_row", "_start", "_nth")
    group = _group(text_col)
    # One narrow pass; the rounds below read this table.
    sizes = stored(docs.select(group.alias("group"), _row(id_col, text_col).alias("row"), text_bytes(text_col).alias("size")), "sizes")
    total, rows = sizes.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    fair = total / shards
    # Fewer than 16 times `shards` texts can each hold that much.
    large = sizes.groupBy("group").agg(F.sum("size").alias("bytes")).filter(F.col("bytes") > fair / LARGE_PART).collect()
    cut = [r["group"] for r in large if r["bytes"] > fair]
    given = docs.withColumn(own_row, _row(id_col, text_col))
    if large:
        is_large = group.isin(*[r["group"] for r in large])
        own = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << ROW_BITS))
        numbered = stored(docs.filter(is_large).withColumn(own_row, own), "large")
        given = given.filter(~is_large).unionByName(numbered)
        rest = sizes.filter(~F.col("group").isin(*[r["group"] for r in large]))
        sizes = rest.unionByName(numbered.select(group.alias("group"), F.col(own_row).alias("row"), text_bytes(text_col).alias("size")))
    keyed = sizes.withColumn("key", _key(F.col("group"), F.col("row"), cut))
    cuts = splitters(keyed, total, shards, tolerance) if rows else []
    pieces = max(8, ceil(rows / shards / rows_per_piece))

    def placed(df: DataFrame, key: Column, key_name: str, spread: str, piece_name: str) -> DataFrame:
        return df.withColumn(key_name, key).withColumn("shard", _place(F.col(key_name), cuts)).withColumn(piece_name, F.pmod(spread, F.lit(pieces)))

    counts = placed(keyed, F.col("key"), "key", "row", own_piece).groupBy("shard", own_piece).count()
    # One row per shard and piece: a shard's offsets are sums over its few pieces.
    so_far = F.sum("count").over(Window.partitionBy("shard").orderBy(own_piece).rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("shard", own_piece, F.coalesce(so_far, F.lit(0)).alias(before))
    result = placed(given, _key(group, F.col(own_row), cut), own_key, own_row, own_piece).withColumns({"size": text_bytes(text_col), "law": F.lit("bytes")})
    result = result.withColumn(nth, F.row_number().over(Window.partitionBy("shard", own_piece).orderBy(own_key, id_col, "size")))
    # `shards` x `pieces` rows at most.
    result = result.join(F.broadcast(starts), ["shard", own_piece], "left")
    return result.withColumn("slot", (F.col(before) + F.col(nth) - 1).cast("long")).drop(own_key, own_piece, own_row, before, nth)
