"""Ordered computations per key that hold when one key owns much of the data.

A window partitioned by key puts all rows of a key into one task. Here the input is
first checked for keys that would be too large for that. Such keys are cut into pieces
at sampled points of their own order, the window runs over (key, piece), and what has to
cross a cut (a running total, the neighbouring row) comes from a table with one row per
piece, small enough to broadcast. All other keys take the plain window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftline.session import estimated_bytes, is_plain_read, stored

_HASH, _CUT, _PIECE = "_key_hash", "_cut", "_piece"
_ORDERABLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.StringType, T.DateType)


@dataclass(frozen=True)
class SkewPolicy:
    """When and how finely large keys are cut.

    Inputs below `small_bytes` fit one task whole and are not examined. `sample_rows` rows
    at most reach the driver. A key holding more than one `pieces`-th of the sample
    is cut so that no piece holds much more than that; `pieces` defaults to one for each `small_bytes` of the
    input, and to the number of shuffle partitions at least.
    """

    small_bytes: int = 256 << 20
    pieces: int | None = None
    rows_per_piece: int = 20
    max_sample_rows: int = 400_000


DEFAULT_POLICY = SkewPolicy()


@dataclass(frozen=True)
class Cuts:
    """Sorted cut points per large key, and the largest number of them."""

    by_key: DataFrame
    most: int


def _piece_count(df: DataFrame, policy: SkewPolicy, size: int | None) -> int:
    by_size = 0 if size is None or not policy.small_bytes else size // policy.small_bytes
    pieces = policy.pieces or max(by_size, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return max(2, min(pieces, policy.max_sample_rows // policy.rows_per_piece))


def find_cuts(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], policy: SkewPolicy = DEFAULT_POLICY
) -> Cuts | None:
    """Cut points of the keys that are too large for one task, or None if there are none.

    The sample is the rows with the lowest hash, so it is uniform, repeatable and bounded by
    its limit; the rate filter before it keeps tasks from sorting rows the limit would drop.
    Collected rows are bounded by the sample, hence independent of the data size.
    """
    for name in order:
        if not isinstance(df.schema[name].dataType, _ORDERABLE):
            raise TypeError(f"order column {name} must be an integer, a string or a date")
    size = estimated_bytes(df)
    if size is not None and size <= policy.small_bytes:
        return None
    pieces = _piece_count(df, policy, size)
    wanted = pieces * policy.rows_per_piece
    rows = df.select(F.xxhash64(*keys).alias(_HASH), *order)
    likely_rows = rows.count() if size is None else max(1, size // (8 * len(df.columns)))
    drawn = _draw(rows, order, wanted, likely_rows)
    if size is not None and sum(len(r["points"]) for r in drawn) < wanted // 4:
        # The estimate was far too high, as it can be after joins.
        drawn = _draw(rows, order, wanted, rows.count())
    step = max(1, sum(len(r["points"]) for r in drawn) // pieces)
    # Few large keys come out: each holds more than two steps of the sample.
    cut = [(r[_HASH], list(dict.fromkeys(r["points"][step::step]))) for r in drawn if len(r["points"]) > 2 * step]
    if not cut:
        return None
    point = T.StructType([T.StructField(n, df.schema[n].dataType) for n in order])
    schema = T.StructType([T.StructField(_HASH, T.LongType()), T.StructField("points", T.ArrayType(point))])
    return Cuts(df.sparkSession.createDataFrame(cut, schema), max(len(points) for _, points in cut))


def _draw(rows: DataFrame, order: Sequence[str], wanted: int, likely_rows: int) -> list:
    """Sampled order values per key hash, sorted. The limit bounds every group collected here."""
    draw = F.xxhash64(_HASH, *order, F.lit("cut"))
    rate = 4.0 * wanted / max(1, likely_rows)
    if rate < 1.0:
        rows = rows.filter(F.pmod(draw, F.lit(1 << 40)) < int(rate * (1 << 40)) + 1)
    sample = rows.orderBy(draw, _HASH, *order).limit(wanted)
    return sample.groupBy(_HASH).agg(F.sort_array(F.collect_list(F.struct(*order))).alias("points")).collect()


def _place(df: DataFrame, keys: Sequence[str], order: Sequence[str], cuts: Cuts) -> DataFrame:
    """Add the piece a row lies in: how many of its key's cut points it has reached.

    The points are searched by halving, spelled out as columns so that it stays compiled code.
    """
    # At most one row per cut key, and no more points than the policy's pieces.
    placed = df.withColumn(_HASH, F.xxhash64(*keys)).join(F.broadcast(cuts.by_key), _HASH, "left")
    placed = placed.withColumn(_PIECE, F.lit(0))
    for step in (1 << i for i in reversed(range(cuts.most.bit_length()))):
        reached = F.get("points", F.col(_PIECE) + F.lit(step - 1)) <= F.struct(*order)
        placed = placed.withColumn(_PIECE, F.when(reached, F.col(_PIECE) + F.lit(step)).otherwise(F.col(_PIECE)))
    return placed.withColumn(_CUT, F.col("points").isNotNull()).drop("points")


def over_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    running: Mapping[str, Column] | None = None,
    lead: Mapping[str, Column] | None = None,
    lag: Mapping[str, Column] | None = None,
    held: Mapping[str, Column] | None = None,
    descending: bool = False,
    policy: SkewPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Add running sums, next / previous values, and the last value that is not null (`held`) within each key.

    `order` must identify a row within its key, else the result depends on arrival.
    Running sums and held values include the row itself. An input that is large and more than a plain read of files is stored
    first, so that looking for large keys, the carries and the window do not evaluate it again.
    """
    running, lead, lag, held = dict(running or {}), dict(lead or {}), dict(lag or {}), dict(held or {})
    size = estimated_bytes(df)
    if (size is None or size > policy.small_bytes) and not is_plain_read(df):
        df = stored(df, "keyed")
    cuts = find_cuts(df, keys, order, policy)
    sort = [F.col(c).desc() if descending else F.col(c).asc() for c in order]
    if cuts is None:
        whole = Window.partitionBy(*keys).orderBy(*sort)
        to_here = whole.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumns(
            {n: F.sum(c).over(to_here) for n, c in running.items()}
            | {n: F.lead(c).over(whole) for n, c in lead.items()}
            | {n: F.lag(c).over(whole) for n, c in lag.items()}
            | {n: F.last(c, ignorenulls=True).over(to_here) for n, c in held.items()}
        )

    placed = _place(df, keys, order, cuts)
    carry = _carries(placed, keys, order, running, lead, lag, held, descending)
    local = Window.partitionBy(*keys, _PIECE).orderBy(*sort)
    to_here = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stepped = placed.withColumns(
        {n: F.sum(c).over(to_here) for n, c in running.items()}
        | {n: F.lead(c).over(local) for n, c in lead.items()}
        | {n: F.lag(c).over(local) for n, c in lag.items()}
        | {n: F.last(c, ignorenulls=True).over(to_here) for n, c in held.items()}
        | {"_last": F.lead(F.lit(1)).over(local).isNull(), "_first": F.lag(F.lit(1)).over(local).isNull()}
    )
    same_piece = reduce(
        lambda acc, k: acc & stepped[k].eqNullSafe(carry[f"c_{k}"]), keys, stepped[_PIECE] == carry[f"c_{_PIECE}"]
    )
    # One row per piece, and pieces are bounded by the policy.
    joined = stepped.join(F.broadcast(carry), same_piece, "left")
    out = [stepped[c] for c in df.columns]
    # As the plain window: null only while the key has had no value, and of the same type.
    kinds = {n: df.agg(F.sum(c).alias("total")).schema["total"].dataType for n, c in running.items()}
    out += [
        F.coalesce(stepped[n] + carry[f"r_{n}"], stepped[n], carry[f"r_{n}"]).cast(kinds[n]).alias(n) for n in running
    ]
    out += [F.when(stepped["_last"], carry[f"n_{n}"]).otherwise(stepped[n]).alias(n) for n in lead]
    out += [F.when(stepped["_first"], carry[f"p_{n}"]).otherwise(stepped[n]).alias(n) for n in lag]
    out += [F.coalesce(stepped[n], carry[f"h_{n}"]).alias(n) for n in held]
    return joined.select(*out)


def _carries(placed, keys, order, running, lead, lag, held, descending) -> DataFrame:
    """What each piece takes over from its neighbours; cold keys have no piece and no row here."""
    first, last = (F.max_by, F.min_by) if descending else (F.min_by, F.max_by)
    at = F.struct(*order)
    aggs = [F.sum(c).alias(f"t_{n}") for n, c in running.items()]
    aggs += [first(F.struct(c.alias("v")), at).alias(f"f_{n}") for n, c in lead.items()]
    aggs += [last(F.struct(c.alias("v")), at).alias(f"l_{n}") for n, c in lag.items()]
    # Rows without a value have no place in the order, so the last one with a value is taken.
    aggs += [last(c, F.when(c.isNotNull(), at)).alias(f"k_{n}") for n, c in held.items()]
    pieces = placed.filter(_CUT).groupBy(*keys, _PIECE).agg(F.count("*").alias("n"), *aggs)
    by_piece = Window.partitionBy(*keys).orderBy(F.col(_PIECE).desc() if descending else F.col(_PIECE).asc())
    before = by_piece.rowsBetween(Window.unboundedPreceding, -1)
    return pieces.select(
        *[F.col(k).alias(f"c_{k}") for k in (*keys, _PIECE)],
        *[F.sum(f"t_{n}").over(before).alias(f"r_{n}") for n in running],
        *[F.lead(f"f_{n}").over(by_piece)["v"].alias(f"n_{n}") for n in lead],
        *[F.lag(f"l_{n}").over(by_piece)["v"].alias(f"p_{n}") for n in lag],
        *[F.last(f"k_{n}", ignorenulls=True).over(before).alias(f"h_{n}") for n in held],
    )


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key.

    Filtering the rank right after the window lets Spark keep one row per key and task before
    the shuffle, so a large key arrives at its task already reduced.
    """
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")
