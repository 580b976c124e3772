"""Approximate nearest neighbours: probed lists, scanned by dimension."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from math import ceil, isqrt, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.llm.vectors import best_of, ids_in_order, matrix, numbered, tiles
from driftline.session import stored

# Rows that the lists are fitted on: so many a list, at most that many lists.
ROWS_A_LIST, MOST_LISTS = 32, 2048
# Queries that the number of probes is measured on, and the share of their true neighbours to be in probed lists.
MEASURED, WANTED = 128, 0.98
BLOCK = 16
ROWS_EACH, QUERIES_EACH = 1024, 2048
# How surely a candidate must be too far before it is abandoned, in spreads of the estimate.
SURE = 2.1
_PAIRS = 1 << 18


def unit(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors scaled by powers of two, which is exact, so that squares neither overflow nor vanish; their norms."""
    scaled = np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1))[1][:, None])
    return scaled, np.sqrt((scaled * scaled).sum(axis=1))


@dataclass
class Lists:
    """Centres of the lists of one dimension, rotated, and the rotation."""

    rotation: np.ndarray
    centres: np.ndarray

    @classmethod
    def fit(cls, sample: np.ndarray, lists: int, rounds: int = 12, seed: int = 42) -> Lists:
        """Spherical k-means on rows of a sample."""
        rng = np.random.default_rng(seed)
        rotation = np.linalg.qr(rng.standard_normal((sample.shape[1],) * 2))[0]
        turned = cls.turn(sample, rotation)
        centres = turned[rng.choice(len(turned), min(lists, len(turned)), replace=False)]
        for _ in range(rounds):
            of = (turned @ centres.T).argmax(axis=1)
            sums = np.zeros_like(centres)
            np.add.at(sums, of, turned)
            norms = np.linalg.norm(sums, axis=1)
            centres = np.where(norms[:, None] > 1e-12, sums / np.maximum(norms, 1e-12)[:, None], centres)
        return cls(rotation, centres)

    @staticmethod
    def turn(vectors: np.ndarray, rotation: np.ndarray) -> np.ndarray:
        scaled, norms = unit(vectors)
        return (scaled / norms[:, None]) @ rotation

    def turned(self, vectors: np.ndarray) -> np.ndarray:
        return self.turn(vectors, self.rotation)


def _still(partial: np.ndarray, limit: np.ndarray, done: int, dim: int) -> np.ndarray:
    """Whether the whole squared distance may be within the limit, told by that of `done` of `dim` rotated dimensions.

    After a random rotation the partial distance, scaled up, estimates the whole with a relative spread that falls
    with the dimensions seen and ends at none. A candidate is given up if the estimate exceeds the limit by more than `SURE` spreads.
    """
    spread = 1 + SURE / sqrt(done) * sqrt(1 - done / dim)
    return partial * (dim / done) <= limit * spread * spread + 1e-9


def scan(rows: np.ndarray, queries: np.ndarray, limit: np.ndarray, apart: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, row) of rotated unit vectors that are not given up: block after block of columns, candidates drop out.

    While most candidates are left a block is one matrix product; then the rest is looked at one by one.
    `apart` has the row number that is the query itself, or -1.
    """
    dim = rows.shape[1]
    starts = list(range(0, dim, BLOCK))
    columns = [np.ascontiguousarray(rows[:, s : s + BLOCK]) for s in starts]
    squares = [(c * c).sum(axis=1) for c in columns]
    found_q, found_r = [], []
    step = max(1, _PAIRS // max(1, len(rows)))
    for begin in range(0, len(queries), step):
        own = queries[begin : begin + step]
        bound = limit[begin : begin + step]
        partial, alive, pairs = np.zeros((len(own), len(rows))), np.ones((len(own), len(rows)), bool), None
        if apart is not None:
            itself = np.flatnonzero(apart[begin : begin + step] >= 0)
            alive[itself, apart[begin : begin + step][itself]] = False
        for s, column, square in zip(starts, columns, squares, strict=True):
            part, done = own[:, s : s + BLOCK], min(s + BLOCK, dim)
            if pairs is None:
                partial += (part * part).sum(axis=1)[:, None] + square - 2 * (part @ column.T)
                alive &= _still(partial, bound[:, None], done, dim)
                if 4 * np.count_nonzero(alive) < alive.size or done == dim:
                    pairs = np.nonzero(alive)
                    partial = partial[pairs]
            else:
                difference = part[pairs[0]] - column[pairs[1]]
                partial = partial + (difference * difference).sum(axis=1)
                keep = _still(partial, bound[pairs[0]], done, dim)
                pairs, partial = (pairs[0][keep], pairs[1][keep]), partial[keep]
        found_q.append(pairs[0] + begin)
        found_r.append(pairs[1])
    return np.concatenate(found_q), np.concatenate(found_r)


def cosines(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The cosine of each pair of original vectors, summed in the same order for all."""
    (q, q_norms), (r, r_norms) = unit(queries), unit(rows)
    return (q * r).sum(axis=1) / (q_norms * r_norms)


def _indexed(rows: DataFrame, lists: dict[int, Lists]) -> DataFrame:
    """Every row with its list."""
    held = rows.sparkSession.sparkContext.broadcast(lists)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                some = batch.filter(pa.array(dims == dim))
                of = held.value[int(dim)]
                nearest = (of.turned(matrix(some.column("vector"))) @ of.centres.T).argmax(axis=1)
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array(nearest.astype(np.int32))], names=[*some.schema.names, "list"])

    kinds = ", ".join(f"{c} {t}" for c, t in rows.dtypes)
    return rows.mapInArrow(work, f"{kinds}, list int")


def _first_limits(index: DataFrame, lists: dict[int, Lists], most: int) -> DataFrame:
    """The queries with `bound`: the squared distance of the nearest rows in their own part of their own list."""
    held = index.sparkSession.sparkContext.broadcast(lists)

    def work(keys: tuple, block: pa.Table) -> pa.Table:
        asked = np.flatnonzero(block.column("asked").to_numpy())
        turned = held.value[keys[0].as_py()].turned(matrix(block.column("vector")))
        bounds = np.full(len(asked), 4.0)
        for at in range(0, len(asked), 256):
            some = asked[at : at + 256]
            near = turned[some] @ turned.T
            near[np.arange(len(some)), some] = -2
            if near.shape[1] > most:
                bounds[at : at + 256] = 2 - 2 * np.partition(near, -most, axis=1)[:, -most]
        out = block.take(asked).select(["row", "vec_id", "vector", "dim"])
        return out.append_column("bound", pa.array(bounds + 1e-9))

    sizes = stored(index.groupBy("dim", "list").agg(F.ceil(F.count(F.lit(1)) / ROWS_EACH).alias("_parts")), "lists")
    # `lists` has `MOST_LISTS` lists a dimension at most.
    parted = index.join(F.broadcast(sizes), ["dim", "list"]).withColumn("_part", F.pmod(F.xxhash64("row"), "_parts"))
    return parted.drop("_parts").groupBy("dim", "list", "_part").applyInArrow(work, "row long, vec_id long, vector array<double>, dim int, bound double")


def _share_to_probe(index: DataFrame, lists: dict[int, Lists], most: int, wanted: float) -> float:
    """The share of a query's lists, nearest first, that hold `wanted` of the true neighbours.

    Measured exactly on a few queries against all rows. At most `MEASURED` queries and their neighbours reach the driver.
    """
    asked = index.filter("asked").orderBy(F.xxhash64("vec_id", "row")).limit(MEASURED).select("row", "vector", "dim").collect()
    if not asked:
        return 1.0
    queries = {d: (np.array([r["row"] for r in asked if r["dim"] == d]), lists[d].turned(np.array([r["vector"] for r in asked if r["dim"] == d]))) for d in {r["dim"] for r in asked}}
    held = index.sparkSession.sparkContext.broadcast((lists, queries))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, queries = held.value
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in set(np.unique(dims).tolist()) & queries.keys():
                some = batch.filter(pa.array(dims == dim))
                own, turned = queries[dim]
                near = turned @ lists[dim].turned(matrix(some.column("vector"))).T
                near[own[:, None] == some.column("row").to_numpy()] = -3
                of = np.broadcast_to(some.column("list").to_numpy().astype(np.int64), near.shape)
                if dim in best:
                    near, of = np.hstack([best[dim][0], near]), np.hstack([best[dim][1], of])
                top = np.argsort(-near, axis=1, kind="stable")[:, :most]
                best[dim] = (np.take_along_axis(near, top, 1), np.take_along_axis(of, top, 1))
        for dim, (near, of) in best.items():
            keep = near.ravel() > -2.5
            rows = np.repeat(queries[dim][0], near.shape[1])[keep]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(rows), dim, np.int32)), pa.array(rows), pa.array(near.ravel()[keep]), pa.array(of.ravel()[keep])],
                names=["dim", "row", "near", "list"],
            )

    found = index.select("row", "vector", "dim", "list").mapInArrow(work, "dim int, row long, near double, list long")
    nth = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("near"), "list"))
    true = found.withColumn("nth", nth).filter(F.col("nth") <= most).collect()
    if not true:
        return 1.0
    order = {d: np.argsort(np.argsort(-(turned @ lists[d].centres.T), axis=1), axis=1) for d, (_, turned) in queries.items()}
    at = {(d, r): i for d, (rows, _) in queries.items() for i, r in enumerate(rows.tolist())}
    needed = sorted((order[r["dim"]][at[r["dim"], r["row"]], r["list"]] + 1) / len(lists[r["dim"]].centres) for r in true)
    return needed[min(len(needed) - 1, ceil(wanted * len(needed)) - 1)]


def nearest(
    df: DataFrame, asked: Column, id_col: str = "vec_id", vector_col: str = "embedding", *, most: int = 5, wanted: float = WANTED
) -> DataFrame:
    """For each row that `asked` tells, the `most` other rows of largest cosine that were found: `query_id`, `rank`, `vec_id`, `score`.

    Lists are fitted on a bounded sample (`ROWS_A_LIST` rows a list, lists by the root of the rows up to `MOST_LISTS`); every row goes into
    the list of the centre nearest to it. How many lists a query probes is measured: `MEASURED` queries are compared with
    all rows, and as many of a query's lists are probed, nearest first, as hold `wanted` of their true neighbours. A query's own part of its list
    gives the distance to beat. In each probed list, vectors rotated at random lie in blocks of columns; after each block a candidate
    whose partial distance makes it unlikely to be near enough is given up (`_still`). Scores of what is left are taken on the original vectors
    in double precision. Lists of any size are cut into tiles.

    Ties go to the smaller id, a null id being the largest. Null, empty and zero vectors and those with a null or non-finite component take no part.
    Only vectors of one length are compared. Repeated rows are rows of their own: only the query's very row is left out, and a repeated
    query is answered twice. Other columns of the input are not looked at. An empty table gives no rows.
    """
    rows = numbered(df, id_col, vector_col, asked=F.coalesce(asked, F.lit(False)))
    rows = rows.filter(F.exists("vector", lambda x: x != 0))
    spark = df.sparkSession
    counts = {r["dim"]: r["count"] for r in rows.groupBy("dim").count().collect()}
    if not counts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    lists = {}
    for dim, count in counts.items():
        wished = min(MOST_LISTS, max(1, isqrt(count)))
        sample = rows.filter(F.col("dim") == dim).orderBy(F.xxhash64("vec_id", "vector"), "row").limit(wished * ROWS_A_LIST).select("vector")
        lists[dim] = Lists.fit(matrix(sample.toArrow().column("vector")), wished)
    index = stored(_indexed(rows, lists), "index")
    share = _share_to_probe(index, lists, most, wanted)
    queries = stored(_first_limits(index, lists, most), "queries")
    held = spark.sparkContext.broadcast(lists)

    def probes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 64):
                small = batch.slice(begin, 64)
                dims = small.column("dim").to_numpy()
                for dim in np.unique(dims):
                    some = small.filter(pa.array(dims == dim))
                    of = held.value[int(dim)]
                    few = max(1, ceil(share * len(of.centres) - 1e-9))
                    order = np.argsort(-(of.turned(matrix(some.column("vector"))) @ of.centres.T), axis=1, kind="stable")[:, :few]
                    copies = some.take(pa.array(np.repeat(np.arange(some.num_rows), few)))
                    yield pa.RecordBatch.from_arrays([*copies.columns, pa.array(order.ravel().astype(np.int32))], names=[*copies.schema.names, "list"])

    probed = queries.mapInArrow(probes, "row long, vec_id long, vector array<double>, dim int, bound double, list int")
    schema = "query long, query_id long, vec_id long, other long, score double"

    def work(keys: tuple, block: pa.Table, asking: pa.Table) -> pa.Table:
        if not len(block) or not len(asking):
            return pa.table([pa.array([], t) for t in (*[pa.int64()] * 4, pa.float64())], names=["query", "query_id", "vec_id", "other", "score"])
        of = held.value[keys[0].as_py()]
        x, q = matrix(block.column("vector")), matrix(asking.column("vector"))
        own, others = asking.column("row").to_numpy(), block.column("row").to_numpy()
        place = {r: i for i, r in enumerate(others.tolist())}
        itself = np.array([place.get(r, -1) for r in own.tolist()], np.int64)
        at_q, at_x = scan(of.turned(x), of.turned(q), asking.column("bound").to_numpy(), itself)
        scores = np.concatenate([cosines(q[at_q[i : i + 65536]], x[at_x[i : i + 65536]]) for i in range(0, len(at_q), 65536)] or [np.zeros(0)])
        keep = best_of(at_q, scores, ids_in_order(block.column("vec_id"))[at_x], most)
        at_q, at_x = at_q[keep], at_x[keep]
        return pa.table(
            [pa.array(own[at_q]), asking.column("vec_id").take(pa.array(at_q)), block.column("vec_id").take(pa.array(at_x)), pa.array(others[at_x]), pa.array(scores[keep])],
            names=["query", "query_id", "vec_id", "other", "score"],
        )

    found = tiles(index.drop("asked"), probed, ["dim", "list"], ROWS_EACH, QUERIES_EACH).applyInArrow(work, schema)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "other")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)
    return ranked.select("query_id", "rank", "vec_id", "score")
