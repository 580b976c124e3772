"""Repeated passages: windows of words that start in more than one place."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import words_of
from driftline.session import stored

# A window is judged by a sample of its word sequences of this share of its length.
GRAM_SHARE = 3
SEGMENT = 1 << 18
ROWS, BLOCK_BITS = 2, 16
MIN_CELL_BITS, MAX_CELL_BITS = 20, 28
WORDS_PER_BUCKET = 2_000_000
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))


def _gram_hashes(words: list[bytes], gram: int) -> np.ndarray:
    """A hash of each sequence of `gram` words; equal sequences have equal hashes."""
    each = np.frombuffer(b"".join([xxhash.xxh64_digest(w) for w in words]), np.uint64)
    total = np.zeros(len(words) - gram + 1, np.uint64)
    for i in range(gram):
        total = total * np.uint64(0x9E3779B97F4A7C15) + each[i : i + len(total)]
    total ^= total >> np.uint64(32)
    total *= _MIX[0]
    return total ^ (total >> np.uint64(29))


def _least_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` consecutive values, by doubling."""
    least, have = values, 1
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[: len(least) - step], least[step:])
        have += step
    return least


def anchors_of(words: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window the place of its anchor, and the anchor's hash.

    The anchor is the short sequence in the window with the least hash, the first of equals, so
    equal windows have equal anchors at equal places, and of about 24 sequences 2 become anchors.
    """
    gram = max(1, window // GRAM_SHARE)
    width = window - gram + 1
    places, hashes = [], []
    for begin in range(0, max(0, len(words) - window + 1), SEGMENT):
        part = words[begin : begin + SEGMENT + window - 1]
        grams = _gram_hashes(part, gram)
        # Hash in the upper bits, place in the lower: the least is the first of the least hashes.
        keyed = (grams & ~np.uint64((1 << 20) - 1)) | np.arange(len(grams), dtype=np.uint64)
        at = (_least_in_windows(keyed, width) & np.uint64((1 << 20) - 1)).astype(np.int64)
        places.append(at + begin)
        hashes.append(grams[at])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(places), np.concatenate(hashes)


def _cells(hashes: np.ndarray, row: int, cell_bits: int) -> np.ndarray:
    mixed = (hashes ^ _MIX[row]) * _MIX[1 - row]
    return ((mixed ^ (mixed >> np.uint64(31))) & np.uint64((1 << cell_bits) - 1)).astype(np.int64)


def _own_anchors(words: list[bytes], window: int) -> np.ndarray:
    """The hashes of a document's distinct anchor places: these are counted."""
    at, hashes = anchors_of(words, window)
    _, first = np.unique(at, return_index=True)
    return hashes[first]


def _encode(cells: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Sorted counted cells as blocks: the cells' places in the block, twice or more ones twice."""
    cells = np.sort(cells)
    blocks = cells >> BLOCK_BITS
    if not len(cells):
        return
    begin = np.flatnonzero(np.diff(blocks, prepend=-1))
    for s, e in zip(begin, [*begin[1:], len(cells)], strict=True):
        own = (cells[s:e] & ((1 << BLOCK_BITS) - 1)).astype(np.uint16)
        # Two of a cell are as good as more.
        same = np.concatenate(([False, False], (own[2:] == own[1:-1]) & (own[1:-1] == own[:-2]))) if len(own) > 2 else np.zeros(len(own), bool)
        yield int(blocks[s]), own[~same].tobytes()


def sketch(docs: DataFrame, text_col: str, window: int, cell_bits: int) -> DataFrame:
    """The merged count-min sketch, of each cell whether its count is 2 or more: `row`, `block`, `bits`.

    Each task counts the anchors of its documents in both rows of its own sketch; these are added up
    by block. A count is at least the number of places at which an equal anchor lies, which
    is at least the number of places at which an equal window starts.
    """
    blocks = 1 << (cell_bits - BLOCK_BITS)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            hashes = np.concatenate(held) if held else np.zeros(0, np.uint64)
            held.clear()
            for row in range(ROWS):
                found = list(_encode(_cells(hashes, row, cell_bits)))
                if found:
                    key = [row * blocks + b for b, _ in found]
                    yield pa.RecordBatch.from_arrays([pa.array(key, pa.int32()), pa.array([x for _, x in found], pa.binary())], names=["block", "cells"])

        for batch in batches:
            held += [_own_anchors(words_of(t.as_py()), window) for t in batch.column(text_col)]
            if sum(map(len, held)) > 4_000_000:
                yield from flush()
        yield from flush()

    def add(key: tuple[pa.Scalar, ...], tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << BLOCK_BITS, np.uint8)
        for batch in tables:
            for cells in batch.column("cells"):
                more = np.bincount(np.frombuffer(cells.as_py(), np.uint16), minlength=1 << BLOCK_BITS)
                counts = np.minimum(counts + more, 2).astype(np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([np.packbits(counts > 1).tobytes()], pa.binary())], names=["block", "bits"])

    partial = docs.select(text_col).mapInArrow(count, "block int, cells binary")
    return partial.groupBy("block").applyInArrow(add, "block int, bits binary")


def _window_hashes(words: list[bytes], starts: np.ndarray, window: int) -> np.ndarray:
    """128 bits of the words of each window."""
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths)
    clean = b" ".join(words)
    spans = zip((ends - lengths)[starts].tolist(), (ends[starts + window - 1] - 1).tolist(), strict=True)
    return np.frombuffer(b"".join([xxhash.xxh3_128_digest(clean[s:e]) for s, e in spans]), np.int64).reshape(-1, 2)


def _all_hashes(texts: list[str | None], starts: list[np.ndarray], window: int) -> np.ndarray:
    """`_window_hashes` of several documents, cut to 96 bits: pairs (high, low) of unsigned longs."""
    parts = [_window_hashes(words_of(t), s, window) for t, s in zip(texts, starts, strict=True)]
    pairs = np.concatenate(parts).view(np.uint64) if parts else np.zeros((0, 2), np.uint64)
    return np.stack((pairs[:, 0], pairs[:, 1] >> np.uint64(32)), axis=1)


def _sorted_once(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs in order, how often each occurs, and for each input which one it is."""
    order = np.lexsort((pairs[:, 1], pairs[:, 0]))
    ranked = pairs[order]
    new = np.ones(len(ranked), bool)
    new[1:] = (ranked[1:] != ranked[:-1]).any(axis=1)
    nth = np.cumsum(new) - 1
    which = np.empty(len(pairs), np.int64)
    which[order] = nth
    return ranked[new], np.bincount(nth, minlength=int(new.sum())), which


def _bucket_slices(high: np.ndarray, buckets: int) -> Iterator[tuple[int, int, int]]:
    """Ranges of the sorted hashes by bucket: (bucket, begin, end)."""
    of = ((high >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    begin = np.flatnonzero(np.diff(of, prepend=-1)).tolist()
    for s, e in zip(begin, [*begin[1:], len(of)] if begin else [], strict=True):
        yield int(of[s]), s, e


_PACKED = np.dtype([("high", "<u8"), ("low", "<u4")])


def _suspects(docs: DataFrame, id_col: str, text_col: str, window: int, cell_bits: int, merged: bytes, buckets: int) -> DataFrame:
    """Each document with its word count, and windows that are estimated to repeat.

    `digest` is set for documents without such windows, which are done; others have their text, the windows'
    `starts`, and the `chunk` of documents they belong to. Further rows, with a `bucket`, hold
    the distinct window hashes of a chunk that fall into the bucket, in order.
    """
    shared = docs.sparkSession.sparkContext.broadcast(merged)
    names = ["id", "row", "n_words", "digest", "text", "starts", "chunk", "bucket", "hashes"]

    def look(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8).reshape(ROWS, -1)
        id_type = None
        chunk, held = None, []  # the open chunk: its number, and (text, starts) of its documents

        def repeated(hashes: np.ndarray) -> np.ndarray:
            ok = np.ones(len(hashes), bool)
            for row in range(ROWS):
                cells = _cells(hashes, row, cell_bits)
                ok &= (bits[row][cells >> 3] >> (7 - (cells & 7)).astype(np.uint8)) & 1 == 1
            return ok

        def closed() -> pa.RecordBatch:
            once, _, _ = _sorted_once(_all_hashes([t for t, _ in held], [s for _, s in held], window))
            packed = np.empty(len(once), _PACKED)
            packed["high"], packed["low"] = once[:, 0], once[:, 1]
            found = [(b, packed[s:e].tobytes()) for b, s, e in _bucket_slices(once[:, 0], buckets)]
            n = len(found)
            columns = [
                pa.nulls(n, id_type), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.string()), pa.nulls(n, pa.string()), pa.nulls(n, pa.binary()),
                pa.array([chunk] * n, pa.int64()), pa.array([b for b, _ in found], pa.int32()), pa.array([h for _, h in found], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            id_type = batch.column("id").type
            for begin in range(0, batch.num_rows, 500):
                part = batch.slice(begin, 500)
                n = part.num_rows
                texts = part.column("text").to_pylist()
                rows = part.column("row").to_pylist()
                counts, digests, starts, chunks = [], [], [], []
                for i in range(n):
                    words = words_of(texts[i])
                    _, hashes = anchors_of(words, window)
                    at = np.flatnonzero(repeated(hashes))
                    counts.append(len(words))
                    if len(at):
                        chunk = rows[i] if chunk is None else chunk
                        held.append((texts[i], at))
                        digests.append(None)
                        starts.append(at.astype(np.int32).tobytes())
                        chunks.append(chunk)
                        if sum(len(s) for _, s in held) >= SEGMENT:
                            yield closed()
                            chunk, held = None, []
                    else:
                        digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
                        starts.append(None)
                        chunks.append(None)
                        texts[i] = None
                columns = [
                    part.column("id"), part.column("row"), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(texts, pa.string()),
                    pa.array(starts, pa.binary()), pa.array(chunks, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)
        if held:
            yield closed()

    given = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), F.col(text_col).alias("text"))
    kind = dict(given.dtypes)["id"]
    return given.mapInArrow(
        look, f"id {kind}, row long, n_words long, digest string, text string, starts binary, chunk long, bucket int, hashes binary"
    )


def _repeated_bits(hashes: DataFrame) -> DataFrame:
    """For each chunk and bucket, which of its hashes other chunks have too: `chunk`, `bucket`, `bits`.

    A hash is in a chunk's rows once, so a very frequent window adds one hash per chunk to its bucket.
    """

    def group(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks, packed = [], []
        for batch in batches:
            chunks += batch.column("chunk").to_pylist()
            packed += [np.frombuffer(h.as_py(), _PACKED) for h in batch.column("hashes")]
        whole = np.concatenate(packed)
        pairs = np.stack((whole["high"], whole["low"].astype(np.uint64)), axis=1)
        _, count, which = _sorted_once(pairs)
        again = count[which] > 1
        ends = np.cumsum([len(p) for p in packed])
        bits = [np.packbits(again[e - len(p) : e]).tobytes() for p, e in zip(packed, ends.tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(chunks, pa.int64()), pa.array([key[0].as_py()] * len(chunks), pa.int32()), pa.array(bits, pa.binary())], names=["chunk", "bucket", "bits"]
        )

    return hashes.groupBy("bucket").applyInArrow(group, "chunk long, bucket int, bits binary")


def _without(words: list[bytes], at: np.ndarray, window: int) -> tuple[int, str]:
    """The number of words that windows at the given starts cover, and the others."""
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, at, 1)
    np.add.at(depth, at + window, -1)
    covered = np.cumsum(depth[:-1]) > 0
    left = b" ".join([w for w, gone in zip(words, covered.tolist(), strict=True) if not gone])
    return int(covered.sum()), left.decode("utf-8", "surrogatepass")


def _cut(texts: DataFrame, bits: DataFrame, window: int, buckets: int) -> DataFrame:
    """The documents of each chunk without the words of windows found to repeat, in the chunk or by `bits`."""

    def work(docs: pa.Table, found: pa.Table) -> pa.Table:
        bodies = docs.column("text").to_pylist()
        starts = [np.frombuffer(s, np.int32).astype(np.int64) for s in docs.column("starts").to_pylist()]
        once, count, which = _sorted_once(_all_hashes(bodies, starts, window))
        again = count > 1
        by_bucket = dict(zip(found.column("bucket").to_pylist(), found.column("bits").to_pylist(), strict=True))
        for bucket, s, e in _bucket_slices(once[:, 0], buckets):
            again[s:e] |= np.unpackbits(np.frombuffer(by_bucket[bucket], np.uint8), count=e - s).astype(bool)
        hit = again[which]
        ends = np.cumsum([len(s) for s in starts], dtype=np.int64).tolist()
        cut = [_without(words_of(t), s[hit[e - len(s) : e]], window) for t, s, e in zip(bodies, starts, ends, strict=True)]
        return pa.table({
            "id": docs.column("id"), "n_words": docs.column("n_words"),
            "n_removed": pa.array([n for n, _ in cut], pa.int64()), "kept_text": pa.array([t for _, t in cut], pa.string()),
        })

    kind = dict(texts.dtypes)["id"]
    pairs = texts.groupBy("chunk").cogroup(bits.groupBy("chunk"))
    return pairs.applyInArrow(work, f"id {kind}, n_words long, n_removed long, kept_text string")


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, window: int = 35, cells_per_word: float = 1.0, max_cell_bits: int = MAX_CELL_BITS,
) -> tuple[DataFrame, DataFrame]:
    """Documents without words that a repeated window covers: those untouched, and those checked.

    A window is `window` consecutive words of one document, and repeated if its words also start anywhere
    else. Both frames have `id`, `n_words`, `n_removed`; the first has `digest` (SHA-256 of the words joined by
    one space), the second `kept_text`, which may be as before.

    Pass one makes a count-min sketch of window anchors. Pass two looks up each window's anchor, and only windows
    estimated to repeat are grouped exactly, by a 96-bit hash; a document without any passes through,
    its text never shuffled. Estimates never fall short, so no repeat is lost. Documents with estimated
    repeats are held in chunks of about 2^18 windows: a chunk sends each distinct hash once, to the
    hash's bucket, and gets one bit back for it. The sketch has
    `cells_per_word` cells a word of the input up to 2 x 2^28 (64 MB); on larger inputs it fills up, and more windows
    are grouped, with the same result.

    A null text has no words; documents shorter than a window stay whole. Repeated rows are documents of
    their own: of two equal ones of 35 words or more nothing is left.
    """
    volume = docs.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).first()[0]
    cell_bits = min(max_cell_bits, max(MIN_CELL_BITS, int(volume * cells_per_word / 6).bit_length()))
    merged = bytearray(ROWS << (cell_bits - 3))
    size = 1 << (BLOCK_BITS - 3)
    for r in stored(sketch(docs, text_col, window, cell_bits), "sketch").toLocalIterator():
        merged[r["block"] * size : (r["block"] + 1) * size] = r["bits"]
    # As many as the input needs, so that a bucket's hashes fit a task at any size.
    buckets = max(64, int(volume // (6 * WORDS_PER_BUCKET)))
    looked = stored(_suspects(docs, id_col, text_col, window, cell_bits, bytes(merged), buckets), "suspects")
    untouched = looked.filter("digest IS NOT NULL").select("id", "n_words", F.lit(0).cast("long").alias("n_removed"), "digest")
    bits = stored(_repeated_bits(looked.filter("bucket IS NOT NULL").select("chunk", "bucket", "hashes")), "repeated")
    checked = looked.filter("starts IS NOT NULL").select("chunk", "id", "n_words", "text", "starts")
    return untouched, _cut(checked, bits, window, buckets)
