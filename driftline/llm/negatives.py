"""Hard negatives: threshold joins of anchors with all rows over partly indexed vectors."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.llm.vectors import best_of, ids_in_order, matrix, numbered, tiles
from driftline.session import stored

BLOCK = 8
ROWS_EACH, ANCHORS_EACH = 2048, 1024
# Rows that first thresholds are guessed from.
SAMPLE = 2048
_PAIRS = 1 << 19
_EXACT = float(1 << 52)
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def whole_numbers(vectors: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), as doubles; components beyond what doubles hold exactly become Python's integers."""
    largest = np.abs(vectors).max(initial=0)
    if scale * largest < _EXACT:
        return np.floor(scale * vectors)
    exact = [[int(np.floor(scale * x)) if abs(x) < _EXACT / scale else int(x) * scale for x in v] for v in vectors.tolist()]
    return np.array(exact, object).reshape(vectors.shape)


def _suffix_norms(vectors: np.ndarray) -> np.ndarray:
    """For each row, the norm of what is left from each block on; zero at the end."""
    squares = np.add.reduceat(vectors * vectors, np.arange(0, vectors.shape[1], BLOCK), axis=1)
    return np.sqrt(np.concatenate([np.cumsum(squares[:, ::-1], axis=1)[:, ::-1], np.zeros((len(vectors), 1))], axis=1))


class Index:
    """Inverted index over blocks of dimensions of a tile's rows.

    A row's last blocks are left out where the norm of what they hold, times the largest such norm of the anchors, stays below the
    lowest threshold: they alone cannot lift a pair to it. Rows lie by falling number of indexed blocks, so the list of
    a block is the first rows.
    """

    def __init__(self, rows: np.ndarray, norms: np.ndarray, anchor_norms: np.ndarray, threshold: float) -> None:
        reach = norms * (anchor_norms.max(axis=0) * (1 + 1e-9)) >= threshold
        indexed = np.where(reach[:, :-1].any(axis=1), reach.shape[1] - 1 - reach[:, -2::-1].argmax(axis=1), 0)
        self.order = np.argsort(-indexed, kind="stable")
        self.indexed, self.norms, rows = indexed[self.order], norms[self.order], rows[self.order]
        self.blocks = []
        for b, s in enumerate(range(0, rows.shape[1], BLOCK)):
            self.blocks.append((slice(s, s + BLOCK), int((self.indexed > b).sum())))
        self.rows = rows

    def candidates(self, anchors: np.ndarray, norms: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs whose scores may lie in their anchor's range, told by partial scores and the norms of what remains."""
        partial = np.zeros((len(anchors), len(self.rows)))
        alive = np.ones(partial.shape, bool)
        done = 0
        for b, (columns, count) in enumerate(self.blocks):
            if not count:
                break
            partial[:, :count] += anchors[:, columns] @ self.rows[:count, columns].T
            rest = norms[:, b + 1, None] * self.norms[:count, b + 1] * (1 + 1e-9) + 1
            now = partial[:, :count]
            alive[:, :count] &= (now + rest >= low[:, None]) & (now - rest <= high[:, None])
            done = b + 1
            if 4 * np.count_nonzero(alive) < alive.size:
                break
        at, of = np.nonzero(alive)
        partial = partial[at, of]
        for b in range(done, len(self.blocks)):
            columns = self.blocks[b][0]
            own = self.indexed[of] > b
            partial[own] += (anchors[at[own], columns] * self.rows[of[own], columns]).sum(axis=1)
            seen = np.minimum(self.indexed[of], b + 1)
            rest = norms[at, seen] * self.norms[of, seen] * (1 + 1e-9) + 1
            keep = (partial + rest >= low[at]) & (partial - rest <= high[at])
            at, of, partial = at[keep], of[keep], partial[keep]
        # Rows without a single block in the index were never added up: their whole norm is the bound.
        rest = norms[at, self.indexed[of]] * self.norms[of, self.indexed[of]] * (1 + 1e-9) + 1
        keep = (partial + rest >= low[at]) & (partial - rest <= high[at])
        return at[keep], self.order[of[keep]]


def joined(anchors: np.ndarray, rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs (anchor, row) with low <= score <= high, and their exact scores, a bounded number of pairs at a time."""
    step = max(1, _PAIRS // max(1, len(rows)))
    exact = anchors.dtype == object or rows.dtype == object
    if not exact:
        norms, anchor_norms = _suffix_norms(rows), _suffix_norms(anchors)
        exact = norms[:, 0].max(initial=0) * anchor_norms[:, 0].max(initial=0) >= _EXACT
    if exact:
        anchors, rows = ([[int(x) for x in v] for v in m.tolist()] for m in (anchors, rows))
        for i, anchor in enumerate(anchors):
            scores = np.array([max(_LEAST, min(_MOST, sum(map(int.__mul__, anchor, r)))) for r in rows], np.int64)
            of = np.flatnonzero((scores >= low[i]) & (scores <= high[i]))
            yield np.full(len(of), i), of, scores[of]
        return
    floor, ceiling = low.astype(np.float64), high.astype(np.float64)
    index = Index(rows, norms, anchor_norms, floor.min(initial=np.inf))
    for begin in range(0, len(anchors), step):
        part = slice(begin, begin + step)
        at, of = index.candidates(anchors[part], anchor_norms[part], floor[part], ceiling[part])
        at = at + begin
        for some in range(0, len(at), 1 << 16):
            a, r = at[some : some + (1 << 16)], of[some : some + (1 << 16)]
            scores = (anchors[a] * rows[r]).sum(axis=1).astype(np.int64)
            keep = (scores >= low[a]) & (scores <= high[a])
            yield a[keep], r[keep], scores[keep]


_HITS = "row long, nth int, other long, vec_id long, score long"


def _tile(asking: pa.Table, block: pa.Table, order: np.ndarray, scale: int, most: int, same: bool) -> pa.Table:
    """For each window of the tile's anchors the first `most` rows in it."""
    q = whole_numbers(matrix(asking.column("vector")), scale)[:, order]
    x = whole_numbers(matrix(block.column("vector")), scale)[:, order]
    own, others, ids = (t.column("row").to_numpy() for t in (asking, block, block))
    labels, of_rows = asking.column("label").to_numpy(), block.column("label").to_numpy()
    ids = ids_in_order(block.column("vec_id"))
    windows = asking.column("windows").combine_chunks()
    of_window = np.repeat(np.arange(len(q)), np.diff(windows.offsets.to_numpy()))
    nth, low, high = (windows.flatten().field(f).to_numpy() for f in ("nth", "low", "high"))
    least, greatest = np.full(len(q), _MOST), np.full(len(q), _LEAST)
    np.minimum.at(least, of_window, low)
    np.maximum.at(greatest, of_window, high)
    # Windows of an anchor, one at a time.
    turn = np.arange(len(of_window)) - windows.offsets.to_numpy()[of_window] + windows.offsets.to_numpy()[0]
    held = [np.zeros(0, np.int64)] * 3
    for a, r, score in joined(q, x, least, greatest):
        fits = (own[a] != others[r]) & ((labels[a] == of_rows[r]) == same)
        a, r, score = a[fits], r[fits], score[fits]
        for t in range(int(turn.max(initial=-1)) + 1):
            window_of = np.full(len(q), -1)
            window_of[of_window[turn == t]] = np.flatnonzero(turn == t)
            w = window_of[a]
            inside = (w >= 0) & (score >= low[w]) & (score <= high[w])
            mine = [np.concatenate(p) for p in zip(held, (w[inside], r[inside], score[inside]), strict=True)]
            keep = best_of(mine[0], mine[2], ids[mine[1]], most)
            held = [m[keep] for m in mine]
    w, r, score = held
    return pa.table(
        [pa.array(own[of_window[w]]), pa.array(nth[w].astype(np.int32)), pa.array(others[r]), block.column("vec_id").take(pa.array(r)), pa.array(score)],
        names=["row", "nth", "other", "vec_id", "score"],
    )


def _no_hits() -> pa.Table:
    return pa.table([pa.array([], t) for t in (pa.int64(), pa.int32(), *[pa.int64()] * 3)], names=["row", "nth", "other", "vec_id", "score"])


def _sample(rows: DataFrame) -> pa.Table:
    """`SAMPLE` rows at most, by hash."""
    return rows.orderBy(F.xxhash64("vec_id", "row"), "row").limit(SAMPLE).select("row", "label", "vector", "dim").toArrow()


def _with_thresholds(windows: DataFrame, sample: pa.Table, share: float, scale: int, most: int, same: bool) -> DataFrame:
    """Windows with the thresholds to try: `first`, then `second`; the window's own `low` is the last.

    The second is the score of the sample's `most`-th row in the window, which fills it for certain. The first, higher one is where the
    sample lets expect four times `most` rows of the whole table.
    """
    held = windows.sparkSession.sparkContext.broadcast(sample)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample = held.value
        dims = sample.column("dim").to_numpy()
        parts = {int(d): sample.filter(pa.array(dims == d)) for d in np.unique(dims)}
        vectors = {d: whole_numbers(matrix(p.column("vector")), scale) for d, p in parts.items()}
        for batch in batches:
            first, second = [], []
            for r in batch.select(["row", "label", "vector", "dim", "low", "high"]).to_pylist():
                low = r["low"]
                if (part := parts.get(r["dim"])) is None:
                    first.append(low), second.append(low)
                    continue
                fits = ((part.column("label").to_numpy() == r["label"]) == same) & (part.column("row").to_numpy() != r["row"])
                own = whole_numbers(np.array([r["vector"]], np.float64), scale)[0]
                scores = np.sort((vectors[r["dim"]][fits] @ own).astype(np.float64))[::-1]
                # Below a long's precision for doubles a threshold must not lie above the score it stands for.
                inside = scores[(scores >= low) & (scores <= r["high"])]
                inside = np.where(np.abs(inside) < _EXACT, inside, low)
                wish = min(most, max(1, ceil(4 * most * share)))
                second.append(int(inside[most - 1]) if len(inside) >= most else low)
                first.append(int(inside[wish - 1]) if len(inside) >= wish else second[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(first, pa.int64()), pa.array(second, pa.int64())], names=[*batch.schema.names, "first", "second"])

    kinds = ", ".join(f"{c} {t}" for c, t in windows.dtypes)
    return stored(windows.mapInArrow(work, f"{kinds}, first long, second long"), "windows")


def fill_windows(
    windows: DataFrame, rows: DataFrame, order: dict[int, np.ndarray], sample: pa.Table, share: float, *, scale: int, most: int, same: bool
) -> DataFrame:
    """For each window (`row` of its anchor, `nth`) the first `most` rows of the same or of other labels whose scores lie within
    `low` and `high`: `row`, `nth`, `other`, `vec_id`, `score`, `rank`.

    Round by round, anchors are joined with all rows above a threshold; windows that do not fill are tried again with a lower one,
    at last with their own lower end. What lies above a threshold is complete, so a filled window is final.
    """
    windows = _with_thresholds(windows, sample, share, scale, most, same)
    orders = rows.sparkSession.sparkContext.broadcast(order)
    cell = ["dim", "label"] if same else ["dim"]
    place = cell.index("dim")

    def work(keys: tuple, asking: pa.Table, block: pa.Table) -> pa.Table:
        if not len(asking) or not len(block):
            return _no_hits()
        return _tile(asking, block, orders.value[keys[place].as_py()], scale, most, same)

    done, rounds = [], ("first", "second", "low")
    for nth, threshold in enumerate(rounds):
        asking = windows.groupBy("row").agg(
            F.first("vector").alias("vector"), F.first("dim").alias("dim"), F.first("label").alias("label"),
            F.collect_list(F.struct("nth", F.col(threshold).alias("low"), "high")).alias("windows"),
        )
        found = tiles(rows, asking, cell, ROWS_EACH, ANCHORS_EACH).applyInArrow(lambda k, block, asking: work(k, asking, block), _HITS)
        best = Window.partitionBy("row", "nth").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "other")
        hits = stored(found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= most), "hits")
        # Windows that are full, or were looked at down to their lower end.
        full = hits.filter(F.col("rank") == most).select("row", "nth")
        if threshold == rounds[-1]:
            done.append(hits)
            break
        settled = full.unionByName(windows.filter(F.col(threshold) <= F.col("low")).select("row", "nth")).distinct()
        done.append(hits.join(settled, ["row", "nth"], "left_semi"))
        windows = stored(windows.join(settled, ["row", "nth"], "left_anti"), "windows")
        if windows.isEmpty():
            break
    everything = done[0]
    for more in done[1:]:
        everything = everything.unionByName(more)
    return everything


def hard_negatives(
    df: DataFrame, anchor: Column, label: Column, id_col: str = "vec_id", vector_col: str = "embedding", *,
    scale: int = 256, positives: int = 5, negatives: int = 3, low_percent: int = 50, high_percent: int = 95,
) -> DataFrame:
    """Hard negatives of each anchor and positive: `anchor_id`, `positive_id`, `rank`, `negative_id`, `positive_score`, `negative_score`.

    A component x counts as floor(`scale` * x), a score is the integer inner product. An anchor's positives are the `positives` other rows of its
    label with the highest scores; a positive's negatives the `negatives` rows of other labels with the highest scores among those
    from `low_percent` to `high_percent` of the positive's score. Ties go to the smaller id, a null id being the largest.

    Both are threshold joins (`fill_windows`): rows of a tile are indexed by blocks of dimensions, in falling order of their
    squares in the whole table, without the last blocks that suffix norms show cannot matter; partial scores are added up and pairs given up
    once the remaining norms cannot bring them into an anchor's windows. The result is exact.

    Rows with a null label, a null or empty vector or a null or non-finite component take no part; zero vectors do. Only vectors of one length are
    compared. Repeated rows are rows of their own, and a repeated anchor is answered twice. Scores beyond a long count as its ends.
    Other columns of the input are not looked at. An empty table gives no rows.
    """
    rows = numbered(df.filter(label.isNotNull()), id_col, vector_col, label=label.cast("long"), asked=F.coalesce(anchor, F.lit(False)))
    spark = df.sparkSession
    total = rows.count()
    squares = rows.select("dim", F.posexplode("vector").alias("at", "x")).groupBy("dim", "at").agg(F.sum(F.least(F.col("x") * F.col("x"), F.lit(1e200))).alias("squares"))
    order: dict[int, list] = {}
    for r in squares.collect():
        order.setdefault(r["dim"], []).append((-r["squares"], r["at"]))
    orders = {d: np.array([at for _, at in sorted(o)], np.int64) for d, o in order.items()}
    sample = _sample(rows)
    share = min(1.0, SAMPLE / max(1, total))
    kept = rows.filter(F.col("dim") > 0).select("row", "vec_id", "label", "vector", "dim")
    asked = rows.filter("asked AND dim > 0")
    whole = asked.select("row", "vector", "dim", "label", F.lit(1).alias("nth"), F.lit(_LEAST).alias("low"), F.lit(_MOST).alias("high"))
    settings = {"order": orders, "sample": sample, "share": share, "scale": scale}
    first = fill_windows(whole, kept, **settings, most=positives, same=True)
    first = stored(first.select("row", F.col("rank").alias("nth"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    score = F.col("positive_score")
    # The ends in whole numbers, without a product that could overflow. A negative score leaves no room between them.
    parts = {"low": low_percent, "high": high_percent}
    down = {e: F.expr(f"positive_score div 100 * {p} + (positive_score % 100 * {p}) div 100") for e, p in parts.items()}
    up = F.when((score % 100 * low_percent) % 100 > 0, down["low"] + 1).otherwise(down["low"])
    ends = first.filter(score >= 0).withColumns({"low": up, "high": down["high"]}).filter("low <= high")
    windows = ends.select("row", "nth", "low", "high").join(asked.select("row", "vector", "dim", "label"), "row")
    second = fill_windows(windows.select(*whole.columns), kept, **settings, most=negatives, same=False)
    named = second.select("row", "nth", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    anchors = asked.select("row", F.col("vec_id").alias("anchor_id"))
    return named.join(first, ["row", "nth"]).join(anchors, "row").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
