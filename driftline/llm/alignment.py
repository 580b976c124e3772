"""Two tokenizers' tokens of the same text, aligned by byte."""

from __future__ import annotations

import hashlib
import os
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.session import stored

# Texts are encoded in segments of about so many characters, cut only where no token can reach across.
SEGMENT = 1 << 20
# Pairs looked up in one pass over the documents, at 17 bytes each; more pairs take more passes.
SLICE_PAIRS = 1 << 22
# Words whose alignment a task remembers, twice over.
KNOWN_WORDS = 1 << 18
FIELD = 40
# Words encoded as one text.
AT_ONCE = 1024
_CUT = re.compile(r"(?<=\S) (?=\S)")
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


def byte_alphabet() -> dict[str, int]:
    """The character by which a byte-level vocabulary writes each byte.

    Visible Latin-1 characters stand for themselves; the others are numbered from 256.
    """
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def _lengths(entries: list[bytes]) -> np.ndarray:
    return np.array([len(e) for e in entries], np.int64)


def byte_ends(begin: np.ndarray, end: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Where each token ends, from the spans of the tokenizer and the lengths of the tokens' bytes.

    A span as long as its token is a coarse cut, taken as it is. Tokens that share a character have
    spans that are too long, and byte-fallback tokens spans that are too short: these are counted on from the
    last cut before them.
    """
    clean = end - begin == lengths
    if clean.all():
        return end
    total = np.cumsum(lengths)
    last = np.maximum.accumulate(np.where(clean, np.arange(len(end)), -1))
    return np.where(last >= 0, end[last] - total[last], 0) + total


class ByteLevel:
    """The byte-level tokenizer; its text has the space in front already."""

    def __init__(self, model: bytes) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(model.decode("utf-8"))
        self.tokenizer.encode_special_tokens = True
        alphabet = byte_alphabet()
        entries = {i: e for e, i in self.tokenizer.get_vocab().items()}
        # Entries with other characters are special tokens, which plain text never gives.
        self.bytes = [bytes([alphabet[c] for c in e]) if set(e := entries.get(i, "")) <= alphabet.keys() else e.encode() for i in range(max(entries) + 1)]
        self.lengths = _lengths(self.bytes)

    def encode(self, text: str, byte_at: np.ndarray | None) -> tuple[list[int], np.ndarray, np.ndarray]:
        found = self.tokenizer.encode(text, add_special_tokens=False)
        spans = np.fromiter(chain.from_iterable(found.offsets), np.int64, 2 * len(found.ids)).reshape(-1, 2)
        # Spans count characters.
        return found.ids, *(spans.T if byte_at is None else byte_at[spans].T)


class Pieces:
    """The piece tokenizer, which adds the space in front itself."""

    def __init__(self, model: bytes) -> None:
        from sentencepiece import SentencePieceProcessor

        self.processor = SentencePieceProcessor(model_proto=model)
        pieces = [self.processor.id_to_piece(i) for i in range(self.processor.get_piece_size())]
        self.bytes = [bytes([int(m[1], 16)]) if (m := _BYTE_PIECE.fullmatch(p)) else p.replace("▁", " ").encode() for p in pieces]
        self.lengths = _lengths(self.bytes)
        # No piece goes on after a space that follows something else, so a text can be cut at such a space.
        self.cuttable = not any("▁" in p.lstrip("▁") for p in pieces)

    def encode(self, encoded: bytes) -> tuple[list[int], np.ndarray, np.ndarray]:
        found = self.processor.encode(encoded, return_type="offset_mapping")
        spans = np.fromiter(chain.from_iterable(found["offsets"]), np.int64, 2 * len(found["ids"])).reshape(-1, 2) + 1
        # Spans count bytes of the text without the space, which belongs to the first piece.
        spans[:1, 0] = 0
        return found["ids"], *spans.T


@dataclass
class Alignment:
    """What one text gives. `keys` are `a * entries of B + b`, sorted, with how many links have each."""

    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    n_links: int = 0
    groups_sha256: str = ""
    keys: np.ndarray = None
    times: np.ndarray = None


def segments(text: str, most: int) -> Iterator[str]:
    """The text in parts of about `most` characters, cut at a single space between other characters, which is left out."""
    begin = 0
    while len(text) - begin > most and (cut := _CUT.search(text, begin + most)):
        yield text[begin : cut.start()]
        begin = cut.end()
    yield text[begin:]


def _byte_at(text: str) -> np.ndarray | None:
    """Where each character begins in UTF-8; None if every character is one byte."""
    if text.isascii():
        return None
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    widths = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
    return np.concatenate([[0], np.cumsum(widths)])


# The alignment of a part of a text that no token of either reaches out of: the numbers of A tokens, B tokens, groups and links in
# one number, `FIELD` bits each; a long for each link; the groups as text. A plain tuple, which costs least to make and to keep.
Word = tuple[int, bytes, str]


class Aligner:
    """Aligns texts word by word.

    A word ends where neither vocabulary has a token that reaches across, so words can be aligned in any order, and one that comes
    again need not be encoded again. Words not known are encoded together, as one text. Two generations of
    `KNOWN_WORDS` are remembered.
    """

    def __init__(self, byte_level: bytes, pieces: bytes) -> None:
        self.a, self.b = ByteLevel(byte_level), Pieces(pieces)
        entries = range(max(len(self.a.bytes), len(self.b.bytes)))
        # An id before another of its side, before the other side, and at the end of a group.
        self.written = [f"{i}{mark}" for mark in ",|;" for i in entries]
        self.widths = np.array([len(w) for w in self.written])
        # False for a word that does not come back.
        self.known: dict[str, Word | bool] = {}
        self.older: dict[str, Word | bool] = {}

    def _aligned(self, words: list[str]) -> list[Word] | None:
        """The words, encoded as one text; None if that does not come back byte for byte, cut at the words' ends."""
        a, b = self.a, self.b
        part = " ".join(words)
        encoded = part.encode("utf-8")
        spaced = b" " + encoded
        a_ids, *a_spans = a.encode(" " + part, _byte_at(" " + part))
        b_ids, *b_spans = b.encode(encoded)
        if b"".join([a.bytes[i] for i in a_ids]) != spaced or b"".join([b.bytes[i] for i in b_ids]) != spaced:
            return None
        a_of, b_of = np.array(a_ids, np.int64), np.array(b_ids, np.int64)
        a_ends, b_ends = byte_ends(*a_spans, a.lengths[a_of]), byte_ends(*b_spans, b.lengths[b_of])
        # Between two neighbouring ends of either lies one token of each: one link. Where both end, a group ends.
        at = np.zeros(len(spaced) + 1, np.int8)
        at[a_ends] = 1
        at[b_ends] += 2
        word_ends = np.cumsum([len(w.encode("utf-8")) + 1 for w in words])
        if not (at[word_ends] == 3).all():
            return None
        ends, both = np.flatnonzero(at), np.flatnonzero(at == 3)
        keys = (a_of[np.searchsorted(a_ends, ends)] * len(b.bytes) + b_of[np.searchsorted(b_ends, ends)]).tobytes()
        # Groups as text: the tokens in order, each with the mark that follows it.
        a_to, b_to = np.searchsorted(a_ends, both) + 1, np.searchsorted(b_ends, both) + 1
        entries = len(self.written) // 3
        codes = np.empty(len(a_of) + len(b_of), np.int64)
        a_sizes, b_sizes = np.diff(a_to, prepend=0), np.diff(b_to, prepend=0)
        codes[np.arange(len(a_of)) + np.repeat(b_to - b_sizes, a_sizes)] = a_of
        codes[np.arange(len(b_of)) + np.repeat(a_to, b_sizes)] = b_of
        codes[a_to + b_to - b_sizes - 1] += entries
        codes[a_to + b_to - 1] += 2 * entries
        text = "".join([self.written[c] for c in codes.tolist()])
        text_to = np.cumsum(self.widths[codes])[a_to + b_to - 1]
        group_to = np.searchsorted(both, word_ends) + 1
        to = [np.searchsorted(a_ends, word_ends) + 1, np.searchsorted(b_ends, word_ends) + 1, group_to, np.searchsorted(ends, word_ends) + 1]
        found, key_from, text_from = [], 0, 0
        for n_a, n_b, n_groups, n_links, key_end, text_end in zip(
            *[np.diff(t, prepend=0).tolist() for t in to], (8 * to[3]).tolist(), text_to[group_to - 1].tolist(), strict=True
        ):
            counts = n_a | n_b << FIELD | n_groups << 2 * FIELD | n_links << 3 * FIELD
            found.append((counts, keys[key_from:key_end], text[text_from : text_end - 1]))
            key_from, text_from = key_end, text_end
        return found

    def learn(self, words: Iterable[str]) -> None:
        """Align the words that are not known yet."""
        known, older = self.known, self.older
        fresh = [w for w in words if w not in known]
        if older:
            known.update((w, older[w]) for w in fresh if w in older)
            fresh = [w for w in fresh if w not in older]
        if not fresh:
            return
        for begin in range(0, len(fresh), AT_ONCE):
            some = fresh[begin : begin + AT_ONCE]
            found = self._aligned(some)
            if found is None:
                # Some word does not come back: each is looked at by itself.
                found = [alone[0] if (alone := self._aligned([w])) else False for w in some]
            known.update(zip(some, found, strict=True))

    def align(self, text: str | None, segment: int = SEGMENT) -> Alignment:
        """The alignment of space and text; of no text, or one that either tokenizer does not give back in full, none."""
        return self._assembled(self.words(text, segment)) if text else Alignment()

    def _assembled(self, blocks: Iterable[list[str]]) -> Alignment:
        found, digest, parts, total = Alignment(), hashlib.sha256(), [], 0
        for nth, words in enumerate(blocks):
            times = Counter(words)
            each = list(map(self.known.get, times))
            if None in each:
                self.learn(times)
                each = list(map(self.known.get, times))
            if False in each:
                return Alignment()
            counts, keys, groups = zip(*each, strict=True)
            total += sum(map(mul, counts, times.values()))
            links = np.fromiter(map(len, keys), np.int64, len(keys)) >> 3
            parts.append((np.frombuffer(b"".join(keys), np.int64), np.repeat(np.fromiter(times.values(), np.int64, len(keys)), links)))
            texts = dict(zip(times, groups, strict=True))
            digest.update((";" * (nth > 0) + ";".join(map(texts.__getitem__, words))).encode())
            if len(self.known) > KNOWN_WORDS:
                self.older, self.known = self.known, {}
        found.n_a, found.n_b, found.n_groups, found.n_links = (total >> i * FIELD & (1 << FIELD) - 1 for i in range(4))
        found.groups_sha256 = digest.hexdigest()
        found.keys, found.times = summed(parts)
        return found

    def words(self, text: str, segment: int) -> Iterator[list[str]]:
        """The text's words, of about `segment` characters at a time."""
        if not self.b.cuttable:
            yield [text]
            return
        for block in segments(text, segment):
            yield _CUT.split(block)

    def align_all(self, texts: list[str | None], segment: int = SEGMENT) -> Iterator[Alignment]:
        """The alignments of the texts; the words of many short ones are learned together."""
        begin = 0
        while begin < len(texts):
            end, size = begin, 0
            while end < len(texts) and (end == begin or size + len(texts[end] or "") <= segment):
                size += len(texts[end] or "")
                end += 1
            if end == begin + 1:
                yield self.align(texts[begin], segment)
            else:
                blocks = [list(self.words(t, segment)) if t else None for t in texts[begin:end]]
                self.learn({w for of_text in blocks if of_text for words in of_text for w in words})
                yield from [self._assembled(b) if b else Alignment() for b in blocks]
            begin = end


def summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different keys with their counts over all parts."""
    keys, of = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(of, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64)


def _packed(values: np.ndarray) -> bytes:
    """Longs as planes of bytes: of small numbers most planes are zero and compress away."""
    return pa.compress(values.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes(), "zstd", asbytes=True)


def _unpacked(packed: bytes, count: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(packed, 8 * count, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, count).T).view("<i8").ravel()


def _pairs_of(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The keys and counts of each row."""
    for n, keys, times in zip(*(batch.column(c).to_pylist() for c in ("n_pairs", "pairs", "times")), strict=True):
        yield (np.cumsum(_unpacked(keys, n)), _unpacked(times, n)) if n else (np.zeros(0, np.int64),) * 2


_ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_pairs long, pairs binary, times binary"
_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def aligned_texts(docs: DataFrame, byte_level: bytes, pieces: bytes, id_col: str = "doc_id", text_col: str = "text", segment: int = SEGMENT) -> DataFrame:
    """One row per document: counts, digest of the groups, and its different id pairs packed with their counts."""
    models = docs.sparkSession.sparkContext.broadcast((byte_level, pieces))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        aligner = Aligner(*models.value)
        for batch in batches:
            # Few rows at a time: the packed pairs of long texts add up.
            for begin in range(0, batch.num_rows, 256):
                some = batch.slice(begin, 256)
                found = list(aligner.align_all(some.column("text").to_pylist(), segment))
                arrays = [pa.array([getattr(f, c) for f in found], pa.int64()) for c in _COUNTS]
                arrays.append(pa.array([f.groups_sha256 for f in found]))
                arrays.append(pa.array([0 if f.keys is None else len(f.keys) for f in found], pa.int64()))
                arrays.append(pa.array([None if f.keys is None else _packed(np.diff(f.keys, prepend=0)) for f in found], pa.binary()))
                arrays.append(pa.array([None if f.keys is None else _packed(f.times) for f in found], pa.binary()))
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), *arrays], names=["doc_id", *_COUNTS, "groups_sha256", "n_pairs", "pairs", "times"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(work, _ALIGNED)


def pair_counts(aligned: DataFrame, most: int = 1 << 20) -> DataFrame:
    """`pair` and `links`, the links of the whole corpus that have it. Tasks add up what they read before the exchange."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out() -> pa.RecordBatch:
            keys, times = held[0]
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(times)], names=["pair", "links"])

        for batch in batches:
            for keys, times in _pairs_of(batch):
                held.append((keys, times))
                size += len(keys)
                if size > 2 * most:
                    held = [summed(held)]
                    size = len(held[0][0])
                    if size > most:
                        yield out()
                        held, size = [], 0
        if held:
            held = [summed(held)]
            yield out()

    return aligned.select("n_pairs", "pairs", "times").mapInArrow(work, "pair long, links long").groupBy("pair").agg(F.sum("links").alias("links"))


def _looked_up(aligned: DataFrame, counts: DataFrame, slices: int, at: int) -> DataFrame:
    """Adds to `n_best` and `count_sum` what the pairs of one slice give. A slice has `SLICE_PAIRS` pairs or so."""
    rows = counts.filter(F.pmod("pair", F.lit(slices)) == at).toArrow()
    pairs, links, best = (rows.column(c).to_numpy() for c in ("pair", "links", "best"))
    order = np.argsort(pairs)
    table = aligned.sparkSession.sparkContext.broadcast((pairs[order], links[order], best[order]))
    schema = aligned.schema
    names = schema.fieldNames()

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, links, best = table.value
        for batch in batches:
            sums = []
            for keys, times in _pairs_of(batch):
                if slices > 1:
                    own = keys % slices == at
                    keys, times = keys[own], times[own]
                found = np.searchsorted(pairs, keys)
                sums.append((int(times[best[found]].sum()), int((times * links[found]).sum())) if len(keys) else (0, 0))
            more = {c: pa.array([s[i] for s in sums], pa.int64()) for i, c in enumerate(("n_best", "count_sum"))}
            columns = [pa.compute.add(batch.column(c), more[c]) if c in more else batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return aligned.mapInArrow(work, schema)


def token_alignment(
    docs: DataFrame, byte_level: bytes, pieces: bytes, id_col: str = "doc_id", text_col: str = "text", *, segment: int = SEGMENT, slice_pairs: int = SLICE_PAIRS
) -> DataFrame:
    """Per document: `doc_id`, `n_a`, `n_b`, `n_groups`, `n_links`, `n_best`, `count_sum`, `groups_sha256`.

    `byte_level` (A) and `pieces` (B) are the contents of the two vocabulary files. A encodes a space and the text,
    B the text, to which it adds the space. A's character spans and B's byte spans are the coarse cuts;
    tokens that split a character, and byte-fallback tokens, are placed by their decoded bytes. Where tokens of both end, a group
    ends. A link is a token of A and one of B that share a byte; a pair's count is the number of its links in all documents.
    `n_best` counts the links whose count is the highest of their B entry, `count_sum` adds the counts up.

    Texts are encoded word by word, cut where neither vocabulary has a token that reaches across, which gives the same tokens: very
    long texts need little memory, and a task remembers the alignment of `KNOWN_WORDS` words. The different pairs of a document stay with it, packed; counts come back
    to them by broadcast, `slice_pairs` pairs at a time in as many passes as that takes, so no document is shuffled.

    Null and empty texts, and texts that a tokenizer does not give back byte for byte, have zeros and no digest.
    Null ids and repeated rows are rows like any other, each copy counting. Other columns of the input are not looked at.
    """
    aligned = stored(aligned_texts(docs, byte_level, pieces, id_col, text_col, segment), "aligned")
    counts = pair_counts(aligned)
    entries = len(Pieces(pieces).bytes)
    counts = stored(counts.withColumn("b", F.pmod("pair", F.lit(entries))), "pairs")
    # A row per entry of B, and of A at most as many rows for each: bounded by the vocabularies.
    highest = counts.groupBy("b").agg(F.max("links").alias("highest"))
    counts = stored(counts.join(highest, "b").select("pair", "links", (F.col("links") == F.col("highest")).alias("best")), "counts")
    slices = max(1, -(-counts.count() // slice_pairs))
    summed_up = aligned.withColumns({"n_best": F.lit(0).cast("long"), "count_sum": F.lit(0).cast("long")})
    for at in range(slices):
        summed_up = _looked_up(summed_up, counts, slices, at)
        if at < slices - 1:
            summed_up = stored(summed_up, "aligned")
    return summed_up.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
