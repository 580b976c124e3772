"""What the operators on vectors share."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.group_ops import PandasCogroupedOps

from driftline.session import if_small, stored


def is_finite(vector: str) -> Column:
    """Whether there is a vector, and all its components are finite numbers."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(fine, F.lit(False))


def numbered(df: DataFrame, id_col: str, vector_col: str, **more: Column) -> DataFrame:
    """Stored rows with finite vectors: `row` (tells repeated rows apart), `vec_id`, `vector`, `dim` and `more`."""
    narrow = df.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("vec_id"),
        F.col(vector_col).cast("array<double>").alias("vector"), *[c.alias(name) for name, c in more.items()],
    )
    return stored(narrow.filter(is_finite("vector")).withColumn("dim", F.size("vector")), "vectors")


def matrix(vectors: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Lists of one length as the rows of a matrix."""
    flat = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


def ids_in_order(ids: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Ids to order ties by; a null id comes last."""
    return ids.fill_null((1 << 63) - 1).to_numpy()


def best_of(groups: np.ndarray, scores: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Positions of the first `most` of each group, by falling score, then by id."""
    order = np.lexsort((ids, -scores, groups))
    of = groups[order]
    begin = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])) if len(of) else np.zeros(0, np.int64)
    nth = np.arange(len(of)) - np.repeat(begin, np.diff(np.append(begin, len(of))))
    return order[nth < most]


def tiles(rows: DataFrame, queries: DataFrame, cell: Sequence[str], rows_each: int, queries_each: int) -> PandasCogroupedOps:
    """Every row with every query of the same cell, in tiles of about `rows_each` times `queries_each`.

    A cell of any size is cut into parts of its rows and chunks of its queries, dealt by the hash of `row`, so no task holds
    more than a few tiles' worth. A row is copied once per chunk and a query once per part: what crosses
    the exchange is a small share of the pairs compared.
    """

    def pieces(members: str, each: int) -> Column:
        return F.ceil(F.col(members) / each).cast("int")

    sizes = rows.groupBy(*cell).agg(F.count(F.lit(1)).alias("_rows")).join(queries.groupBy(*cell).agg(F.count(F.lit(1)).alias("_queries")), list(cell))
    sizes = stored(sizes.select(*cell, pieces("_rows", rows_each).alias("_parts"), pieces("_queries", queries_each).alias("_chunks")), "tiles")

    def dealt(df: DataFrame, own: str, of_own: str, other: str, of_other: str) -> DataFrame:
        both = df.join(if_small(sizes), list(cell)).withColumn(own, F.pmod(F.xxhash64("row"), F.col(of_own)).cast("int"))
        return both.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(of_other) - 1))).drop("_parts", "_chunks")

    keys = [*cell, "_part", "_chunk"]
    left, right = dealt(rows, "_part", "_parts", "_chunk", "_chunks"), dealt(queries, "_chunk", "_chunks", "_part", "_parts")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys))
