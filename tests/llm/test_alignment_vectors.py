"""Token alignment, nearest neighbours and hard negatives against plain versions."""

from __future__ import annotations

import base64
import hashlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftline.llm import alignment, negatives, neighbours
from driftline.llm.queries import TOKENIZERS
from driftline.llm.vectors import best_of

BYTE_LEVEL, PIECES = (Path(TOKENIZERS, name).read_bytes() for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

TEXTS = [
    None, "", " ", "  two  spaces ", "plain words, plain words; don't", "<|endoftext|> and <s> </s> <unk> <0x41>", "gap▁mark", "tab\tline\nend\r\n\n",
    "héllo 世界 ก😀 ok 龘𒀀 ñandú ṩ", "𒀀𒀀𒀀龘龘", "\u0000 \u0001​　x y", "plain words, plain words; don't", "éä ﬁ Ⅳ", " lead", "trail ",
    "ความ ยินดี мир שלום " * 30, "word " * 3000, "x" * 5000, "12345 67,890.12 " * 40,
]


@pytest.fixture(scope="module")
def plain_tokens():
    """Tokens by the rank file of the same vocabulary, and by plain encoding into ids."""
    import tiktoken
    from sentencepiece import SentencePieceProcessor

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, Path(TOKENIZERS, "byte_bpe_50k.tiktoken").read_bytes().splitlines())}
    a = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    b = SentencePieceProcessor(model_proto=PIECES)

    def piece_bytes(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    def tokens(text):
        whole = (" " + (text or "")).encode()
        a_tokens = [(i, a.decode_single_token_bytes(i)) for i in a.encode_ordinary(" " + (text or ""))]
        b_tokens = [(i, piece_bytes(i)) for i in b.encode(text or "")]
        fine = text and b"".join(t for _, t in a_tokens) == whole == b"".join(t for _, t in b_tokens)
        return (a_tokens, b_tokens) if fine else ([], [])

    return tokens


def ranges(tokens):
    at = 0
    for i, t in tokens:
        yield i, at, at + len(t)
        at += len(t)


def plain_alignment(texts, tokens):
    rows, counts = [], Counter()
    for text in texts:
        a, b = (list(ranges(t)) for t in tokens(text))
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        links, j = [], 0
        for i, begin, end in a:
            while j < len(b) and b[j][2] <= begin:
                j += 1
            links += [(i, k) for k, s, e in b[j : j + end - begin + 1] if s < end and e > begin]
        groups, at = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for i, s, e in side if s >= at and e <= cut) for side in (a, b)))
            at = cut
        counts.update(links)
        rows.append((len(a), len(b), groups, links))
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return [
        (n_a, n_b, len(groups), len(links), sum(counts[k] == best[k[1]] for k in links), sum(counts[k] for k in links),
         hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else "")
        for n_a, n_b, groups, links in rows
    ]


@pytest.mark.parametrize("settings", [{}, {"segment": 20, "slice_pairs": 40}])
def test_token_alignment(spark, plain_tokens, settings):
    docs = spark.createDataFrame([(None if i == 4 else i, t, i) for i, t in enumerate(TEXTS)], "doc_id long, text string, pair long").withColumn("n_best", F.lit("x"))
    columns = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = alignment.token_alignment(docs.unionByName(docs.filter("doc_id = 8")), BYTE_LEVEL, PIECES, **settings)
    given = [*TEXTS, TEXTS[8]]
    want = plain_alignment(given, plain_tokens)
    ids = [None if i == 4 else i for i in range(len(TEXTS))] + [8]
    assert Counter((r["doc_id"], *[r[c] for c in columns]) for r in got.collect()) == Counter((i, *w) for i, w in zip(ids, want, strict=True))
    assert sum(w[0] == 0 for w in want) == 3


def test_token_alignment_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.token_alignment(docs, BYTE_LEVEL, PIECES).count() == 0
    only = alignment.token_alignment(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string"), BYTE_LEVEL, PIECES)
    assert sorted(tuple(r) for r in only.collect()) == [(1, *[0] * 6, ""), (2, *[0] * 6, "")]


def test_spans_as_coarse_cuts():
    # A three-byte character in two tokens, and one in three byte tokens, between tokens of their own spans.
    ends = [2, 4, 5, 7]
    assert alignment.byte_ends(np.array([0, 2, 2, 5]), np.array([2, 5, 5, 7]), np.array([2, 2, 1, 2])).tolist() == ends
    assert alignment.byte_ends(np.array([0, 1, 1, 1, 4]), np.array([1, 1, 1, 4, 5]), np.array([1] * 5)).tolist() == [1, 2, 3, 4, 5]


def vectors(n, dim=16, seed=3, copies=0):
    """Unit vectors; a third of them close to one another, and some exact copies."""
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim))
    x[: n // 3] = x[0] + 0.05 * rng.standard_normal((n // 3, dim))
    x[n - copies :] = x[1]
    return (x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32)


BAD = [(9000, None, 1), (9001, [0.0] * 16, 1), (9002, [float("nan")] * 16, 1), (9003, [1.0, None, *[0.0] * 14], 1), (9050, [float("inf"), *[1.0] * 15], 1), (9100, [], 1)]
SCHEMA = "vec_id long, embedding array<float>, label int"


def vector_table(spark, x, bad=BAD):
    rng = np.random.default_rng(5)
    rows = [(i, v.tolist(), int(rng.integers(0, 4))) for i, v in enumerate(x)]
    return spark.createDataFrame(rows + list(bad), SCHEMA).withColumns({"row": F.lit(1), "list": F.lit("x"), "score": F.lit(0), "dim": F.lit(2), "nth": F.lit(1)})


def test_nearest_neighbours(spark):
    x = vectors(3000, copies=40)
    got = neighbours.nearest(vector_table(spark, x), F.col("vec_id") % 50 == 0).collect()
    double = x.astype(np.float64)
    near = (double @ double.T) / np.linalg.norm(double, axis=1)[:, None] / np.linalg.norm(double, axis=1)
    by_query = defaultdict(list)
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        assert r["score"] == pytest.approx(near[r["query_id"], r["vec_id"]], abs=1e-12) and r["query_id"] != r["vec_id"]
        by_query[r["query_id"]].append((r["rank"], -r["score"], r["vec_id"]))
    assert set(by_query) == set(range(0, 3000, 50))
    hits = 0
    for q, found in by_query.items():
        assert [f[0] for f in found] == [1, 2, 3, 4, 5] and [f[1:] for f in found] == sorted(f[1:] for f in found)
        others = np.delete(np.arange(3000), q)
        fifth = np.sort(near[q, others])[-5]
        hits += sum(-f[1] >= fifth - 1e-12 for f in found)
    assert hits >= 0.9 * 5 * len(by_query)


def test_copies_come_by_id(spark):
    x = vectors(200, copies=60)
    got = neighbours.nearest(vector_table(spark, x, bad=()), F.col("vec_id") == 150).collect()
    assert [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"])] == [1, 140, 141, 142, 143]


def test_few_and_no_vectors(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0], 1), (1, [0.0, 2.0], 1), (None, [3.0, 0.0], 1), (0, [1.0, 0.0], 1), (3, [1.0, 0.0, 0.0], 1)], SCHEMA)
    got = Counter(tuple(r) for r in neighbours.nearest(few, F.col("vec_id") % 50 == 0).collect())
    # A repeated query is answered twice, and finds its other copy; vectors of another length are not compared.
    assert got == Counter({(0, 1, 0, 1.0): 2, (0, 2, None, 1.0): 2, (0, 3, 1, 0.0): 2})
    assert neighbours.nearest(few.limit(0), F.col("vec_id") == 0).count() == 0
    assert neighbours.nearest(few, F.col("vec_id") == 77).count() == 0
    huge = spark.createDataFrame([(0, [1e300, 1e300], 1), (1, [1e-300, 0.0], 1)], "vec_id long, embedding array<double>, label int")
    assert [r["score"] for r in neighbours.nearest(huge, F.col("vec_id") == 0).collect()] == [pytest.approx(0.5**0.5)]


def plain_negatives(rows, scale=256):
    rows = [(i, [int(np.floor(scale * x)) for x in v], label) for i, v, label in rows]

    def score(a, b):
        # Scores past a long count as its ends.
        return max(-(1 << 63), min((1 << 63) - 1, sum(p * q for p, q in zip(a, b, strict=True))))

    def order(s, i):
        return (-s, i is None, i or 0)

    for n, (i, v, label) in enumerate(rows):
        if i is None or i % 50:
            continue
        others = [(score(v, w), j, k) for m, (j, w, k) in enumerate(rows) if m != n]
        for s, j, _ in sorted((o for o in others if o[2] == label), key=lambda o: order(o[0], o[1]))[:5]:
            fits = sorted((o for o in others if o[2] != label and 50 * s <= 100 * o[0] <= 95 * s), key=lambda o: order(o[0], o[1]))
            yield from ((i, j, rank, o[1], s, o[0]) for rank, o in enumerate(fits[:3], 1))


def test_hard_negatives(spark):
    x = vectors(1200, copies=30)
    table = vector_table(spark, x, bad=[b for b in BAD if b[0] != 9001])
    table = table.unionByName(spark.createDataFrame([(50, x[7].tolist(), None), (9200, [0.0] * 16, 2), (None, x[9].tolist(), 1), (7, x[7].tolist(), 2)], SCHEMA), allowMissingColumns=True)
    given = [(r["vec_id"], r["embedding"], r["label"]) for r in table.collect()]
    given = [g for g in given if g[2] is not None and g[1] and all(c is not None and np.isfinite(c) for c in g[1])]
    got = negatives.hard_negatives(table, F.col("vec_id") % 50 == 0, F.col("label")).collect()
    want = Counter(plain_negatives(given))
    assert len(want) > 50 and Counter(tuple(r) for r in got) == want


def test_hard_negatives_of_little(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert negatives.hard_negatives(empty, F.col("vec_id") % 50 == 0, F.col("label")).count() == 0
    rows = [(0, [0.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [1.0, 0.0], 2), (50, [-1.0, -1.0], 2), (3, [1.0, 1.0], 1), (4, [2.0**40, 1.0], 2), (100, [2.0**41, 3.0], 1), (5, [2.0**39, 0.0], 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = Counter(tuple(r) for r in negatives.hard_negatives(table, F.col("vec_id") % 50 == 0, F.col("label")).collect())
    assert got == Counter(plain_negatives(rows))


def test_best_of_each_group():
    groups, scores, ids = np.array([1, 0, 1, 1, 0]), np.array([5, 7, 9, 9, 7]), np.array([1, 2, 4, 3, 1])
    assert best_of(groups, scores, ids, 2).tolist() == [4, 1, 3, 2]
    assert best_of(groups[:0], scores[:0], ids[:0], 2).tolist() == []
