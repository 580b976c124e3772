"""Near duplicates by SimHash, compared at the anchors of a covering code."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import accumulate, combinations, product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.llm.bitmaps import bits_for, packed, position, with_maybe
from driftline.llm.common import attach, identity, unused
from driftline.llm.components import components
from driftline.session import let_go, measured, settled, stored

SEED = 42
CHUNK = 1 << 15
SEARCHES = 8
JUDGED_WORDS = 5
PARITIES = 512
# Texts of a bucket that are compared at once.
BUCKET = 256
# Links that the first round may try for each text, and how many times more each further round.
FIRST_LINKS, MORE_LINKS = 4, 8

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.float64)


def bit_sums(hashes: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
    """For each bit of the rows of bytes, the weight of the rows that have it set, by counting byte values."""
    width = hashes.shape[1]
    at = hashes.astype(np.int64) + 256 * np.arange(width)
    counts = np.bincount(at.ravel(), None if weights is None else np.repeat(weights, width), 256 * width)
    return (counts.reshape(width, 256) @ _BITS).ravel()


def fingerprint(text: str | None, shingle_words: int = 3) -> int:
    """64 bits of the text's shingles: a bit is 1 if set in over half of their XXH64 values.

    A-Z count as a-z. Fewer words than a shingle has make one shingle; none give zero.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    clean = b" ".join(words)
    width = min(shingle_words, len(words))
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    count = len(words) - width + 1
    ones = np.zeros(64)
    for at in range(0, count, CHUNK):
        to = min(count, at + CHUNK)
        hashes = b"".join(
            [xxhash.xxh64_digest(clean[s : e - 1], SEED) for s, e in zip(starts[at:to], ends[at + width - 1 : to + width - 1], strict=True)]
        )
        ones += bit_sums(np.frombuffer(hashes, np.uint8).reshape(-1, 8))
    return int.from_bytes(np.packbits(2 * ones > count).tobytes(), "big")


def fingerprints(docs: DataFrame, text_col: str = "text", shingle_words: int = 3) -> DataFrame:
    """The input's other columns, with the text replaced by `fp`, its fingerprint as a signed long."""
    others = [c for c in docs.columns if c != text_col]
    schema = docs.select(*others, F.lit(0).cast("long").alias("fp")).schema

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t.as_py(), shingle_words) for t in batch.column(text_col)]
            fp = np.array(values, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in others], pa.array(fp)], names=[*others, "fp"])

    return docs.mapInArrow(work, schema)


@dataclass(frozen=True)
class PerfectCode:
    """A cyclic code of `length` bits whose words lie within `radius` of every value, each in one way."""

    length: int
    polynomial: int
    radius: int

    @property
    def check_bits(self) -> int:
        return self.polynomial.bit_length() - 1

    def syndromes(self, values: np.ndarray) -> np.ndarray:
        """Remainders modulo the code's polynomial: what a value and its nearest code word differ by."""
        rest = values.astype(np.int64)
        for shift in range(self.length - self.check_bits - 1, -1, -1):
            high = (rest >> (shift + self.check_bits)) & 1
            rest = rest ^ (high * (self.polynomial << shift))
        return rest

    def layers_up_to(self, more: int) -> list[np.ndarray]:
        """By syndrome, the changes that lead to code words within the radius, one beyond, two beyond ...

        Layer 0 has one change per syndrome, the code being perfect. Others are padded with -1.
        """
        layers = []
        for extra in range(more + 1):
            weights = range(self.radius + 1) if extra == 0 else [self.radius + extra]
            masks = np.array([sum(1 << i for i in bits) for w in weights for bits in combinations(range(self.length), w)], np.int64)
            of = self.syndromes(masks)
            order = np.argsort(of, kind="stable")
            of, masks = of[order], masks[order]
            begin = np.searchsorted(of, np.arange(1 << self.check_bits))
            nth = np.arange(len(of)) - begin[of]
            table = np.full((1 << self.check_bits, int(nth.max()) + 1), -1, np.int64)
            table[of, nth] = masks
            layers.append(table)
        return layers

    def word_index(self, words: np.ndarray) -> np.ndarray:
        """Code words are told apart by their leading bits."""
        return words >> self.check_bits


# Generator polynomials of the Golay code of 23 bits and the Hamming code of 15.
GOLAY = PerfectCode(23, 0b110001110101, 3)
HAMMING = PerfectCode(15, 0b10011, 1)


@dataclass(frozen=True)
class Anchors:
    """Anchors of 64-bit fingerprints: one word of each code, for consecutive bits from the lowest."""

    codes: tuple[PerfectCode, ...] = (GOLAY, GOLAY)

    @property
    def index_bits(self) -> int:
        return sum(c.length - c.check_bits for c in self.codes)

    def tables(self, threshold: int) -> list[list[np.ndarray]]:
        """What `of` needs, made once per task or driver."""
        return [code.layers_up_to(threshold) for code in self.codes]

    def of(self, fps: np.ndarray, threshold: int, tables: list[list[np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and indexes of the anchors within the covering radius plus the threshold.

        The code's radius is the sum of its parts' radii, and a fingerprint within the threshold
        of another spends its differing bits on the parts. So the anchor nearest to the one is reached from the
        other by changes of radius + t_i bits in part i, the t_i adding up to the threshold at most.
        With threshold 0 this is the nearest anchor alone.
        """
        parts, shift = [], 0
        for i, code in enumerate(self.codes):
            value = (fps >> np.uint64(shift)) & np.uint64((1 << code.length) - 1)
            parts.append((code, value.astype(np.int64), code.syndromes(value.astype(np.int64)), tables[i]))
            shift += code.length
        rows, found = [], []
        for spent in product(range(threshold + 1), repeat=len(parts)):
            if sum(spent) > threshold:
                continue
            at, index = np.arange(len(fps)), np.zeros(len(fps), np.int64)
            for (code, value, syndrome, layers), extra in zip(parts, spent, strict=True):
                change = layers[extra][syndrome[at]]
                ok = change >= 0
                word = np.where(ok, value[at][:, None] ^ change, 0)
                index = ((index[:, None] << (code.length - code.check_bits)) | code.word_index(word))[ok]
                at = np.broadcast_to(at[:, None], ok.shape)[ok]
            rows.append(at)
            found.append(index)
        return np.concatenate(rows), np.concatenate(found)


def _at_anchors(fps: DataFrame, anchors: Anchors, threshold: int, taken: Broadcast | None = None, keep: Sequence[str] = ("root",)) -> DataFrame:
    """Rows `anchor`, `k`, `fp` and the columns of `keep`; with `taken` (a bitmap by anchor index), only at anchors set there.

    Fingerprints of different `k` never meet: their anchors are numbered apart.
    """

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = anchors.tables(threshold)
        bitmap = None if taken is None else np.frombuffer(taken.value, np.uint8)
        for batch in batches:
            for begin in range(0, batch.num_rows, 4096):
                values = batch.column("fp").slice(begin, 4096).to_numpy(zero_copy_only=False)
                rows, index = anchors.of(values.view(np.uint64), threshold, tables)
                kinds = batch.column("k").slice(begin, 4096).to_numpy(zero_copy_only=False).astype(np.int64)[rows]
                index = index | (kinds << anchors.index_bits)
                if bitmap is not None:
                    at = (index ^ (index >> _FOLD)) & (8 * len(bitmap) - 1)
                    near = (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
                    rows, index, kinds = rows[near], index[near], kinds[near]
                kept = [batch.column(c).slice(begin, 4096).take(pa.array(rows)) for c in keep]
                columns = [pa.array(index), pa.array(kinds.astype(np.int32)), pa.array(values[rows]), *kept]
                yield pa.RecordBatch.from_arrays(columns, names=["anchor", "k", "fp", *keep])

    kinds = "".join(f", {c} {t}" for c, t in fps.select(*keep).dtypes)
    return fps.select("k", "fp", *keep).mapInArrow(work, f"anchor long, k int, fp long{kinds}")


# Anchors are folded onto the bits of a bitmap, a part that differs in many onto one that does not.
_FOLD = 11


def _occupied(homes: DataFrame, bits: int) -> bytearray:
    """The anchors that are nearest to some fingerprint, folded onto `bits` bits: 16 MB at most."""
    bitmap = bytearray(bits >> 3)
    at = F.col("anchor").bitwiseXOR(F.shiftright("anchor", _FOLD)).bitwiseAND(F.lit(bits - 1)) + 1
    maps = homes.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    for row in maps.toLocalIterator():
        begin = (row["bucket"] - 1) * 4096
        bitmap[begin : begin + 4096] = row["bits"]
    return bitmap


def _anchors_for(count: int) -> Anchors:
    """Past about 2^26 fingerprints, homes get crowded: a third part gives 2^35 anchors."""
    return Anchors((GOLAY, GOLAY) if count < 1 << 26 else (GOLAY, GOLAY, HAMMING))


def _meeting(
    fps: DataFrame, threshold: int, anchors: Anchors | None = None, keep: Sequence[str] = ("root",), held: list[Broadcast] | None = None,
    copied: DataFrame | None = None, count: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The fingerprints at their homes and their copies (those of `copied`, if given), see `near_pairs`.

    The bitmap they need is added to `held`, to be let go after use. `count` is the number of `fps`, counted if not given.
    """
    if count is None:
        count = fps.count()
    if anchors is None:
        anchors = _anchors_for(count)
    homes = _at_anchors(fps, anchors, 0, keep=keep)
    # With 32 bits for each home, an anchor that is nobody's home is taken for one in 1 of 32 cases, which costs a copy only.
    taken = fps.sparkSession.sparkContext.broadcast(_occupied(homes, bits_for(count, 32, 1 << 27)))
    if held is not None:
        held.append(taken)
    return homes, _at_anchors(fps if copied is None else copied, anchors, threshold, taken, keep)


def near_pairs(fps: DataFrame, threshold: int = 2, anchors: Anchors | None = None) -> DataFrame:
    """All pairs `k`, `a` < `b` of the distinct (`k`, `fp`) of equal `k` whose fingerprints differ in `threshold` bits at most.

    Each fingerprint is at home at the anchor nearest to it, and copied to every anchor within the covering
    radius plus the threshold. If a and b are near, b is among the copies at a's home. Copies are made
    only for anchors that are somebody's home, told by a bitmap of 16 MB at most (past 2^22 homes it fills up, and more copies are made). Pairs that
    are too far apart are dropped within the join; skewed anchors are for adaptive execution to split.
    With a column `root`, pairs of equal roots are left out: they are known to belong together.
    """
    if "root" not in fps.columns:
        fps = fps.withColumn("root", F.col("fp"))
    homes, copies = _meeting(fps, threshold, anchors)
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= threshold
    return homes.withColumnsRenamed({"fp": "a", "root": "root_a"}).join(
        copies.select("anchor", F.col("fp").alias("b"), F.col("root").alias("root_b")), "anchor"
    ).filter((F.col("a") < F.col("b")) & near & (F.col("root_a") != F.col("root_b"))).select("k", "a", "b")


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle_words: int = 3, threshold: int = 2, keep: Sequence[str] = ()
) -> DataFrame:
    """One row per document: `doc_id`, `fingerprint` (16 hex digits), `fp`, `component_id`.

    Documents are linked if their fingerprints differ in `threshold` bits at most, and a component is what
    links reach; `component_id` is its smallest doc_id, null only if all its ids are. Equal fingerprints
    are one node, so copies make no pairs, and documents meet their component by fingerprint with `attach`.
    Null and empty texts have fingerprint zero and are linked like others. Repeated rows give repeated results.
    `keep` names further columns to carry along.
    """
    narrow = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), *[F.col(c).alias(f"_keep_{i}") for i, c in enumerate(keep)])
    each = stored(fingerprints(narrow, "_text", shingle_words), "fingerprints")
    total = each.count()
    nodes = stored(each.groupBy("fp").agg(F.min("_id").alias("least"), F.count(F.lit(1)).alias("members")), "nodes")
    roots = components(stored(near_pairs(nodes.withColumn("k", F.lit(0)), threshold).select("a", "b"), "pairs"))
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "least", "members", F.coalesce("root", "fp").alias("root"))
    rooted = stored(rooted, "nodes")
    smallest = stored(rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("nodes")), "components")
    named = stored(attach(rooted, smallest, ["root"], "nodes", total).select("fp", "members", "component_id"), "nodes")
    return attach(each, named, ["fp"], "members", total).select(
        F.col("_id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "fp",
        *[F.col(f"_keep_{i}").alias(c) for i, c in enumerate(keep)],
    )


# Odd multipliers that derive further hashes from one.
_ODD = np.array([0x9E3779B97F4A7C15 + 0x2468ACE * k for k in range(SEARCHES)], np.uint64)


def _derived(hashes: np.ndarray) -> np.ndarray:
    """Eight further hashes of the same things, as rows of bytes."""
    mixed = (hashes[:, None] ^ _ODD) * _ODD
    mixed ^= mixed >> np.uint64(32)
    mixed *= _ODD[0]
    mixed ^= mixed >> np.uint64(29)
    return mixed.view(np.uint8)


def _shingle_hashes(words: list[bytes]) -> np.ndarray:
    """Hashes of the different shingles of five words, sorted; fewer words make one shingle."""
    if not words:
        return np.zeros(0, np.uint64)
    clean = b" ".join(words)
    width = min(JUDGED_WORDS, len(words))
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends][: len(words) - width + 1]
    found = [xxhash.xxh64_digest(clean[s : e - 1], SEED) for s, e in zip(starts, ends[width - 1 :], strict=True)]
    return np.unique(np.frombuffer(b"".join(found), np.uint64))


def _folded_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def near_features(text: str | None) -> tuple[np.ndarray, np.ndarray, int]:
    """Eight fingerprints to search by, 512 parities to judge by, and the number of shingles.

    The first are SimHashes of the single words, each word weighing the root of its count: copies with a few
    words changed differ in few bits of them. A parity tells whether an odd number of the different shingles of five
    words fell on it: two texts differ in no more parities than shingles.
    """
    words = _folded_words(text)
    if not words:
        return *[np.zeros(SEARCHES, np.int64)] * 2, 0
    counts = Counter(words)
    hashes = np.frombuffer(b"".join([xxhash.xxh64_digest(w, SEED) for w in counts]), np.uint64)
    weights = np.sqrt(np.fromiter(counts.values(), np.float64, len(counts)))
    judged = _shingle_hashes(words)
    search = np.zeros(64 * SEARCHES)
    for at in range(0, len(hashes), 4096):
        search += bit_sums(_derived(hashes[at : at + 4096]), weights[at : at + 4096])
    parity = np.bincount((judged & np.uint64(PARITIES - 1)).astype(np.int64), minlength=PARITIES) & 1
    return np.packbits(search > weights.sum() / 2).view(np.int64), np.packbits(parity.astype(bool)).view(np.int64), len(judged)


_SEARCH, _PARITY = [f"s{i}" for i in range(SEARCHES)], [f"p{i}" for i in range(PARITIES // 64)]


def _featured(texts: DataFrame) -> DataFrame:
    """`h1`, `h2`, `id`, `text` to the first three, `n`, and one long for each fingerprint and each 64 parities.

    Copies that lie together are read once.
    """
    longs = ["n", *_SEARCH, *_PARITY]

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: dict[tuple[int, int], int] = {}
            rows, at = [], []
            for key in zip(batch.column("h1").to_pylist(), batch.column("h2").to_pylist(), strict=True):
                if key not in known:
                    search, parity, n = near_features(batch.column("text")[len(at)].as_py())
                    known[key] = len(rows)
                    rows.append(np.concatenate([[n], search, parity]))
                at.append(known[key])
            values = np.array(rows, np.int64).reshape(-1, len(longs))[np.array(at, np.int64)]
            arrays = [pa.array(np.ascontiguousarray(values[:, i])) for i in range(len(longs))]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("h1", "h2", "id")], *arrays], names=["h1", "h2", "id", *longs])

    schema = texts.select("h1", "h2", "id", *[F.lit(0).cast("long").alias(c) for c in longs]).schema
    return texts.mapInArrow(work, schema)


def distinct_texts(docs: DataFrame) -> DataFrame:
    """One stored row per different text of `h1`, `h2`, `id`, `text`: `mark` (its number), the smallest `id`, `copies`, and its features.

    What is exchanged is a few longs a row, and copies are combined before that; texts are not exchanged.
    """
    longs = ["n", *_SEARCH, *_PARITY]
    # Features are functions of the text, so any copy's will do.
    merged = _featured(docs).groupBy("h1", "h2").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), *[F.min(c).alias(c) for c in longs])
    return stored(merged.withColumn("mark", F.monotonically_increasing_id()), "texts")


def _shingled(texts: DataFrame) -> DataFrame:
    """`mark`, `text` to `mark` and `shingles`."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_shingle_hashes(_folded_words(t.as_py())).view(np.int64) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("mark"), pa.array(found, pa.list_(pa.int64()))], names=["mark", "shingles"])

    return texts.mapInArrow(work, "mark long, shingles array<long>")


def _with_sides(pairs: DataFrame, of: DataFrame, total: int) -> DataFrame:
    """The `total` stored pairs `a`, `b` with what `of` has for each `mark`, as `x` and `y`. Marks of very many pairs are for `attach` to spread."""

    def with_side(rows: DataFrame, key: str, name: str) -> DataFrame:
        used = pairs.groupBy(key).agg(F.count(F.lit(1)).alias(f"of_{key}"))
        held = of.select(F.col("mark").alias(key), F.col("held").alias(name)).join(used.hint("merge"), key)
        side, seen = measured(held, "sides", most=F.max(f"of_{key}"))
        return attach(rows, side.hint("merge"), [key], f"of_{key}", total, seen["most"])

    return with_side(with_side(pairs, "a", "x"), "b", "y")


def _apart(x: str, y: str) -> Column:
    return sum((F.bit_count(F.col(f"{x}.{p}").bitwiseXOR(F.col(f"{y}.{p}"))) for p in _PARITY), F.lit(0))


def verified(pairs: DataFrame, texts: DataFrame, docs: DataFrame, total: int | None = None) -> DataFrame:
    """The stored pairs `a`, `b` of marks with `alike`: whether their texts share 0.8 of their different shingles, compared in full.

    Pairs that differ in too many parities or in size for that are told so at once; only the texts of the others are read into shingles.
    `total` is the number of pairs, counted if not given.
    """
    count = pairs.count() if total is None else total
    return settled(docs.sparkSession, "verified", lambda: _verified(pairs, texts, docs, count))


def _verified(pairs: DataFrame, texts: DataFrame, docs: DataFrame, total: int) -> DataFrame:
    held = _with_sides(pairs, texts.select("mark", F.struct("n", *_PARITY).alias("held")), total)
    size, larger = F.col("x.n") + F.col("y.n"), F.greatest("x.n", "y.n")
    near = held.select("a", "b", ((9 * _apart("x", "y") <= size) & (5 * F.least("x.n", "y.n") >= 4 * larger)).alias("near"))
    near, seen = measured(near, "judged", near=F.count_if("near"))
    close = near.filter("near").select("a", "b")
    marks = close.select(F.explode(F.array("a", "b")).alias("mark")).distinct()
    wanted, held_by = measured(texts.select("mark", "h1", "h2").join(marks.hint("merge"), "mark"), "wanted", texts=F.count(F.lit(1)))
    bits = bits_for(held_by["texts"])
    filters = stored(packed(wanted.select(position(F.col("h1"), bits).alias("position")).distinct()), "filter")
    few = with_maybe(docs, "h1", filters, bits).filter("maybe").groupBy("h1", "h2").agg(F.first("text").alias("text"))
    shingles = stored(_shingled(few.join(wanted.hint("merge"), ["h1", "h2"]).select("mark", "text")).withColumnRenamed("shingles", "held"), "shingles")
    alike = 9 * F.size(F.array_intersect("x", "y")) >= 4 * (F.size("x") + F.size("y"))
    judged = _with_sides(close, shingles, seen["near"]).select("a", "b", alike.alias("alike"))
    return judged.unionByName(near.filter("NOT near").select("a", "b", F.lit(False).alias("alike")))


def _forest(edges: np.ndarray, likely: np.ndarray, most: int) -> tuple[list[int], bool]:
    """Positions of the edges (pairs of roots) to try, and whether that is all that may be needed.

    Of the likely edges those are tried that join something new. Of the others all are that join what those leave apart, `most` of them.
    """
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for i in np.flatnonzero(likely).tolist():
        one, other = root(int(edges[i, 0])), root(int(edges[i, 1]))
        if one != other:
            parent[one] = other
            kept.append(i)
    apart = [i for i in np.flatnonzero(~likely).tolist() if root(int(edges[i, 0])) != root(int(edges[i, 1]))]
    return kept + apart[:most], len(apart) <= most


def _likely(apart: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether texts that differ in so many parities are to be expected to differ in few enough shingles, of `sizes` together.

    That many shingles at random differ in PARITIES / 2 * (1 - (1 - 2 / PARITIES) ** shingles) parities.
    """
    odd = np.minimum(apart / (PARITIES / 2), 1 - 1e-9)
    return 9 * np.log1p(-odd) / np.log1p(-2 / PARITIES) <= sizes + 27


def _links_to_try(buckets: DataFrame, threshold: int, most: int) -> DataFrame:
    """Of each row's members `one` and `other`, links `a`, `b` that may join their roots, and whether they are `likely`.

    Members are compared if their fingerprints are near; they may be similar if they differ in few enough parities and in size,
    which loses no similar pair. If there are more of these than members, `_forest` chooses among them, `most` unlikely ones for each
    member; where there are more, a row of -1 says so. Members of a pair that is not chosen come out as `a` with a `b` of -1. A link chosen in two ways counts as likely where either does. Links in `rejected`, found not to be similar before, are left out.
    """

    def columns(structs: pa.StructArray) -> dict[str, np.ndarray]:
        return {f: structs.field(f).to_numpy(zero_copy_only=False) for f in ("mark", "root", "fp", "n", *_PARITY)}

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, other = batch.column("one"), batch.column("other")
            starts = [c.offsets.to_numpy() for c in (one, other)]
            held = [columns(c.values) for c in (one, other)]
            found = [np.zeros((0, 3), np.int64)]
            for r in range(batch.num_rows):
                x, y = ({f: v[s[r] : s[r + 1]] for f, v in h.items()} for h, s in zip(held, starts, strict=True))
                meet = (x["root"][:, None] != y["root"]) & (np.bitwise_count((x["fp"][:, None] ^ y["fp"]).view(np.uint64)) <= threshold)
                meet &= (5 * x["n"][:, None] >= 4 * y["n"]) & (4 * x["n"][:, None] <= 5 * y["n"])
                i, j = np.nonzero(meet)
                apart = sum(np.bitwise_count((x[p][i] ^ y[p][j]).view(np.uint64)).astype(np.int64) for p in _PARITY)
                sizes = x["n"][i] + y["n"][j]
                near = 9 * apart <= sizes
                i, j, likely = i[near], j[near], _likely(apart[near], sizes[near])
                if len(i) and (refused := batch.column("rejected")[r].as_py()):
                    pairs = {(p["a"], p["b"]) for p in refused}
                    a, b = np.minimum(x["mark"][i], y["mark"][j]), np.maximum(x["mark"][i], y["mark"][j])
                    fresh = np.array([p not in pairs for p in zip(a.tolist(), b.tolist(), strict=True)], bool)
                    i, j, likely = i[fresh], j[fresh], likely[fresh]
                if not len(i):
                    continue
                members = len(x["mark"]) + len(y["mark"])
                if len(i) <= members:
                    # So few are all tried, and none needs another in its place.
                    keep, whole, likely = np.arange(len(i)), True, np.zeros(len(i), bool)
                else:
                    keep, whole = _forest(np.column_stack([x["root"][i], y["root"][j]]), likely, most * members)
                ends = np.sort(np.column_stack([x["mark"][i[keep]], y["mark"][j[keep]]]), axis=1)
                found.append(np.column_stack([ends, likely[keep]]))
                left = np.ones(len(i), bool)
                left[keep] = False
                marks = np.unique(np.concatenate([x["mark"][i[left]], y["mark"][j[left]]]))
                found.append(np.column_stack([marks, np.full(len(marks), -1), np.zeros(len(marks), np.int64)]))
                if not whole:
                    found.append(np.array([[-1, -1, 0]]))
            links = np.concatenate(found)
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(np.ascontiguousarray(links[:, k])) for k in (0, 1)], pa.array(links[:, 2].astype(bool))], names=["a", "b", "likely"]
            )

    found = buckets.select("one", "other", "rejected").mapInArrow(work, "a long, b long, likely boolean")
    return found.groupBy("a", "b").agg(F.max("likely").alias("likely"))


def _few_for_each(tried: DataFrame, most: int) -> tuple[DataFrame, int]:
    """Of the links to try those that are among the first `most` of either end, and how many these are.

    A text of a dense group comes up in many buckets; this bounds what is tried by the number of texts.
    """
    ways = tried.filter("b >= 0").select("a", "b", "likely", F.explode(F.array("a", "b")).alias("end"))
    nth = F.row_number().over(Window.partitionBy("end").orderBy(F.xxhash64("a", "b"), "a", "b"))
    kept = ways.withColumn("nth", nth).filter(F.col("nth") <= most).select("a", "b", "likely").distinct()
    kept, seen = measured(kept, "tries", links=F.count(F.lit(1)))
    return kept, seen["links"]


def _buckets(homes: DataFrame, copies: DataFrame, rejected: DataFrame | None, within: bool) -> DataFrame:
    """For each anchor the members at home there (`one`) and those copied there (`other`), with what was `rejected` of them before, if any.

    Anchors of more than `BUCKET` members are cut into parts by the mark's hash, each with each, or with `within` each with itself alone.
    Only members are kept that meet a copy of a larger root or a home of a smaller one.
    """
    sides = homes.select("anchor", F.col("root").alias("least"), F.lit(None).cast("long").alias("most")).unionByName(
        copies.select("anchor", F.lit(None).cast("long").alias("least"), F.col("root").alias("most"))
    )
    ends = sides.groupBy("anchor").agg(F.min("least").alias("least"), F.max("most").alias("most"), F.count(F.lit(1)).alias("members"))
    parts = F.ceil(F.col("members") / (2 * BUCKET)).cast("int").alias("parts")
    open_ones = stored(ends.filter("least < most").select("anchor", "least", "most", parts), "anchors")

    def parted(df: DataFrame, name: str, meets: str) -> DataFrame:
        part = F.pmod(F.xxhash64("mark"), F.col("parts")).cast("int").alias(f"{name}_part")
        member = F.struct("mark", "root", "fp", "n", *_PARITY)
        return df.join(open_ones.hint("merge"), "anchor").filter(meets).groupBy("anchor", part).agg(F.collect_list(member).alias(name))

    keys = (F.col("l.anchor") == F.col("r.anchor")) & ((F.col("one_part") == F.col("other_part")) if within else F.lit(True))
    ones, others = parted(homes, "one", "root < most"), parted(copies, "other", "root > least")
    both = ones.alias("l").join(others.alias("r").hint("merge"), keys).select("l.anchor", "one_part", "other_part", "one", "other")
    if rejected is None:
        return both.withColumn("rejected", F.lit(None).cast("array<struct<a:long,b:long>>"))
    both = stored(both.withColumn("bucket", F.monotonically_increasing_id()), "buckets")
    marks = both.select("bucket", F.col("other.mark").alias("others"), F.explode("one.mark").alias("mark"))
    ways = rejected.select(F.col("a").alias("end"), F.col("b").alias("partner"), "a", "b").unionByName(
        rejected.select(F.col("b").alias("end"), F.col("a").alias("partner"), "a", "b")
    )
    # Only pairs with both ends in the bucket come out of the join.
    here = (F.col("mark") == F.col("end")) & F.array_contains("others", F.col("partner"))
    known = marks.join(ways, here).groupBy("bucket").agg(F.collect_set(F.struct("a", "b")).alias("rejected"))
    return both.join(known, "bucket", "left")


def _at_home(rooted: DataFrame, texts: DataFrame, total: int) -> DataFrame:
    """A stored table of the members at homes where different roots are at home together; there are `total` texts."""
    each = rooted.select("mark", "root", F.posexplode(F.array(*_SEARCH)).alias("k", "fp"))
    homes = stored(_at_anchors(each, _anchors_for(SEARCHES * total), 0, keep=["mark", "root"]), "homes")
    ends = homes.groupBy("anchor").agg(F.min("root").alias("least"), F.max("root").alias("most"))
    met = homes.join(ends.filter("least < most").select("anchor").hint("merge"), "anchor")
    return stored(met.join(texts.select("mark", "n", *_PARITY).hint("merge"), "mark"), "members")


def _may_meet(rooted: DataFrame, threshold: int, held: list[Broadcast]) -> tuple[DataFrame, int]:
    """A stored table of the members whose fingerprint is near one of another root's, `larger` or `smaller` by its root's number, and how many are larger.

    Of two members the one of the smaller root waits at home and the other is copied. A root's number is its least mark, so
    what many texts are joined to is most often the smaller: the members of a dense group stay at home, and the few that are apart from it visit.
    """
    spread = rooted.select("mark", "root", F.posexplode(F.array(*_SEARCH)).alias("k", "fp"))
    # Fingerprints with the roots that their texts have.
    nodes, seen = measured(spread.groupBy("k", "fp").agg(F.min("root").alias("least"), F.max("root").alias("most")), "nodes", all=F.count(F.lit(1)))
    homes, copies = _meeting(nodes, threshold, keep=["least", "most"], held=held, count=seen["all"])
    sides = homes.withColumnsRenamed({"fp": "a", "least": "least_a", "most": "most_a"}).withColumn("larger", F.explode(F.array(F.lit(True), F.lit(False))))
    others = copies.select("anchor", F.col("fp").alias("b"), F.col("least").alias("least_b"), F.col("most").alias("most_b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= threshold
    differs = F.when(F.col("larger"), F.col("most_b") > F.col("least_a")).otherwise(F.col("least_b") < F.col("most_a"))
    met = sides.join(others, (sides["anchor"] == others["anchor"]) & near & differs, "left_semi").select("k", F.col("a").alias("fp"), "larger")
    sorts = met.groupBy("k", "fp").agg(F.max("larger").alias("larger"), F.max(~F.col("larger")).alias("smaller"))
    members = rooted.select("mark", "root", "n", *_PARITY, F.posexplode(F.array(*_SEARCH)).alias("k", "fp"))
    members, seen = measured(members.join(stored(sorts, "open").hint("merge"), ["k", "fp"]), "members", larger=F.count_if("larger"))
    return members, seen["larger"]


def similar_texts(texts: DataFrame, docs: DataFrame, threshold: int = 2) -> DataFrame:
    """Links `a`, `b` between `mark`s that join all texts sharing 0.8 of their different shingles of five words, where a search finds them.

    Candidates agree in a search fingerprint up to `threshold` bits, found at anchors; whether they are similar is told
    by `verified`, so no link is an estimate. First, each text is tried with one text of its every fingerprint, then with others of the same
    home, within parts of large ones, which makes no copies. Then candidates of different roots are compared anchor by anchor. Of the links that are likely to hold only those that
    join something new are tried, so their number grows with the texts, not with the pairs; of the unlikely ones that may yet
    hold, so many for each text. A link that is found not to be similar is not tried again, and others take its place, more of them
    each round, among the texts that have any left, until none is left.
    """
    each = texts.select("mark", F.posexplode(F.array(*_SEARCH)).alias("k", "fp"))
    # The same text comes first in all buckets that have it and no other with a smaller hash.
    groups = each.groupBy("k", "fp").agg(F.min_by("mark", F.xxhash64("mark")).alias("first"), F.count(F.lit(1)).alias("members"))
    groups, seen = measured(groups.filter("members > 1"), "nodes", most=F.max("members"))
    total = texts.count()
    to_first = attach(each, groups, ["k", "fp"], "members", SEARCHES * total, seen["most"]).filter("first <> mark")
    tries = to_first.select(F.least("first", "mark").alias("a"), F.greatest("first", "mark").alias("b")).distinct()
    tries, seen = measured(tries, "firsts", links=F.count(F.lit(1)))
    judged = verified(tries, texts, docs, seen["links"])
    links, rejected = judged.filter("alike").select("a", "b"), judged.filter("NOT alike").select("a", "b")
    refused = not rejected.isEmpty()

    at_home, most, among = True, FIRST_LINKS, texts
    while True:
        let_go(docs.sparkSession)
        held: list[Broadcast] = []
        roots = components(links)
        rooted = among.join(roots.withColumnRenamed("node", "mark").hint("merge"), "mark", "left").withColumn("root", F.coalesce("root", "mark"))
        if at_home:
            homes = copies = _at_home(rooted, texts, total)
        else:
            members, larger = _may_meet(rooted, threshold, held)
            kept = ["mark", "root", "n", *_PARITY]
            homes, copies = _meeting(members.filter("larger"), threshold, keep=kept, held=held, copied=members.filter("smaller"), count=larger)
        buckets = _buckets(homes, copies, rejected if refused else None, at_home)
        tried, seen = measured(_links_to_try(buckets, threshold, most), "tries", links=F.count_if(F.col("b") >= 0), more=F.count_if(F.col("a") < 0))
        for bitmap in held:
            bitmap.destroy()
        tries, few = _few_for_each(tried, most)
        everything = few == seen["links"]
        if few:
            judged = verified(tries.select("a", "b"), texts, docs, few)
            links = links.unionByName(judged.filter("alike").select("a", "b"))
            false = judged.filter("NOT alike").select("a", "b")
            rejected = rejected.unionByName(false)
            refused = refused or not false.isEmpty()
            # Other links may have to take the place of likely ones that do not hold.
            everything = everything and false.join(tries.filter("likely"), ["a", "b"], "left_semi").isEmpty()
        if at_home:
            at_home = False
            continue
        # All other candidates lie within what the tried links join.
        if everything and not seen["more"]:
            return links
        # Only texts of pairs that were not tried have something left to meet.
        missed = tried.filter("b >= 0").join(tries.select("a", "b").hint("merge"), ["a", "b"], "left_anti")
        left = tried.filter("a >= 0 AND b < 0").select(F.col("a").alias("mark")).unionByName(missed.select(F.explode(F.array("a", "b")).alias("mark")))
        among = stored(among.join(left.distinct().hint("merge"), "mark", "left_semi"), "among")
        most *= MORE_LINKS


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, threshold: int = 2) -> DataFrame:
    """The input's rows without near duplicates: of each component of `similar_texts` the row with the smallest id stays.

    Null ids come last. Exact copies are one text. A null text counts as empty, and texts without words are copies
    of each other. Rows equal in id and text are one document. Other columns pass unchanged, whatever their names. Very long
    texts are read whole. An empty table gives no rows. Rows whose text has no copy and no near copy pass without an exchange.
    """
    h1, h2 = identity(text_col)
    narrow = docs.select(h1.alias("h1"), h2.alias("h2"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    texts = distinct_texts(narrow)
    roots = components(similar_texts(texts, narrow, threshold))
    grouped = texts.join(roots.withColumnRenamed("node", "mark"), "mark", "left").select("h1", "h2", "id", "mark", "copies", F.coalesce("root", "mark").alias("root"))
    grouped = stored(grouped, "grouped")
    first = grouped.groupBy("root").agg(F.min(F.struct(F.col("id").isNull(), "id", "mark")).alias("first"), F.sum("copies").alias("rows"))
    fate = grouped.join(stored(first.filter("rows > 1"), "first"), "root")
    fate = stored(fate.select("h1", "h2", "id", "copies", (F.col("mark") == F.col("first.mark")).alias("stays")), "fate")
    bits = bits_for(fate.count())
    filters = stored(packed(fate.select(position(F.col("h1"), bits).alias("position")).distinct()), "filter")

    one, other, maybe, least, copies, stays, nth = unused(docs, "_h1", "_h2", "_maybe", "_least", "_copies", "_stays", "_nth")
    looked = with_maybe(docs.withColumns({one: h1, other: h2}), one, filters, bits, maybe)
    doubtful = looked.filter(maybe).drop(maybe)
    named = fate.select(*[F.col(c).alias(n) for c, n in (("h1", one), ("h2", other), ("id", least), ("copies", copies), ("stays", stays))])
    total = docs.count()
    # Look-alikes of the filter have no fate and stay.
    alone = doubtful.join(named.select(one, other), [one, other], "left_anti")
    found = attach(doubtful, named.filter(stays), [one, other], copies, total).filter(F.col(id_col).eqNullSafe(F.col(least)))
    once = found.withColumn(nth, F.row_number().over(Window.partitionBy(one, other).orderBy(F.lit(0)))).filter(F.col(nth) == 1)
    kept = looked.filter(~F.col(maybe))
    return kept.select(*docs.columns).unionByName(alone.select(*docs.columns)).unionByName(once.select(*docs.columns))
