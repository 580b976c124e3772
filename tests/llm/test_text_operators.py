"""The text operators against plain versions, on small hand-made tables."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from driftline.llm import decontaminate, exact_dedup, extraction, language, licences, mixing, sharding, simhash, substrings, toxicity
from driftline.llm.common import identity, words_of

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row long, h string, k int"


def make(spark, texts, first=0):
    rows = [(first + i, t, "en", None if i % 5 == 0 else f"s{i % 3}", 0, 7, "x", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def words(n, seed):
    rng = np.random.default_rng(seed)
    return [f"w{x}" for x in rng.integers(0, 5000, n)]


@pytest.fixture(scope="module")
def odd_texts():
    """Nulls, empty and blank texts, copies, a very long text, near copies, repeats within a text."""
    base, long = words(300, 1), words(30_000, 2)
    near = [*base[:150], "changed", *base[151:]]
    return [
        None, "", " \t\n", "one", "one", "two words", " ".join(base), " ".join(base), " ".join(near), " ".join(long),
        " ".join(["again"] * 200), " ".join(words(50, 3) + base[40:100]), "é ü   ñ", " ".join(words(80, 4)),
    ]


@pytest.fixture
def docs(spark, odd_texts):
    return make(spark, odd_texts).unionByName(make(spark, ["a repeated row"] * 1)).unionByName(make(spark, ["a repeated row"] * 1)).unionByName(
        spark.createDataFrame([(None, "without id", None, None, None, None, None, None)], DOCS)
    )


def test_exact_copies(docs):
    got = exact_dedup.exact_dedup(docs).collect()
    groups = defaultdict(list)
    for r in docs.collect():
        groups[hashlib.sha256((r["text"] or "").encode()).hexdigest()].append(r["doc_id"])
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == Counter(
        (i, max((x for x in g if x is not None), default=None), len(g), digest) for digest, g in groups.items() for i in g
    )
    assert sum(r["kept"] for r in got) == len(groups)
    assert exact_dedup.exact_dedup(docs.limit(0)).count() == 0


def test_a_full_filter_loses_nothing(docs):
    one = exact_dedup.exact_dedup(docs, max_bits=1 << 15, bits_per_row=1).drop("kept").collect()
    assert Counter(one) == Counter(exact_dedup.exact_dedup(docs).drop("kept").collect())


def test_shards(spark, docs):
    got = sharding.shard(docs, 4).collect()
    assert len(got) == docs.count()
    slots, by_text, bytes_of = defaultdict(list), defaultdict(set), Counter()
    for r in got:
        assert r["size"] == len((r["text"] or "").encode()) + 16
        slots[r["shard"]].append(r["slot"])
        by_text[r["text"] or ""].add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in by_text.values())
    even = make(spark, [f"text {i} " + "x" * (i % 50) for i in range(4000)] + ["hot copy " * 9] * 2000)
    for r in sharding.shard(even, 8).collect():
        bytes_of[r["shard"]] += r["size"]
    mean = sum(bytes_of.values()) / 8
    assert len(bytes_of) == 8 and max(bytes_of.values()) < 1.01 * mean and min(bytes_of.values()) > 0.99 * mean
    assert sharding.shard(docs.limit(0), 4).count() == 0


def test_repeated_passages(spark, docs):
    for window in (35, 5):
        untouched, checked = substrings.remove_repeats(docs, window=window)
        got = Counter((r["id"], r["n_words"], r["n_removed"], r["digest"]) for r in untouched.collect())
        got.update((r["id"], r["n_words"], r["n_removed"], hashlib.sha256(r["kept_text"].encode()).hexdigest()) for r in checked.collect())
        rows, seen, expected = [(r["doc_id"], words_of(r["text"])) for r in docs.collect()], Counter(), Counter()
        for _, w in rows:
            seen.update(tuple(w[i : i + window]) for i in range(len(w) - window + 1))
        for i, w in rows:
            gone = set()
            for s in range(len(w) - window + 1):
                if seen[tuple(w[s : s + window])] > 1:
                    gone.update(range(s, s + window))
            kept = b" ".join(x for j, x in enumerate(w) if j not in gone)
            expected[i, len(w), len(gone), hashlib.sha256(kept).hexdigest()] += 1
        assert got == expected
    untouched, checked = substrings.remove_repeats(docs.limit(0))
    assert untouched.count() + checked.count() == 0


def plain_fingerprint(text):
    w = [x for x in words_of((text or "").translate({c: c + 32 for c in range(65, 91)}))]
    shingles = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(odd_texts):
    for t in [*odd_texts, "ABC É def GHI jkl", "One two THREE four"]:
        assert simhash.fingerprint(t) == plain_fingerprint(t)


def test_near_pairs_are_all_found(spark):
    rng = np.random.default_rng(5)
    fps = [int(x) for x in rng.integers(0, 1 << 63, 300)]
    fps += [f ^ (1 << int(a)) ^ (1 << int(b)) for f in fps[:150] for a, b in [rng.integers(0, 63, 2)]]
    fps = sorted(set(fps))
    table = spark.createDataFrame([(0, f) for f in fps], "k int, fp long")
    expected = {(a, b) for i, a in enumerate(fps) for b in fps[i + 1 :] if (a ^ b).bit_count() <= 2}
    for codes in ((simhash.GOLAY, simhash.GOLAY), (simhash.GOLAY, simhash.GOLAY, simhash.HAMMING)):
        found = simhash.near_pairs(table, 2, simhash.Anchors(codes)).collect()
        assert len(found) == len(expected) and {(r["a"], r["b"]) for r in found} == expected


def test_near_groups_and_keeping_one(docs, odd_texts):
    got = simhash.near_groups(docs).collect()
    assert len(got) == docs.count()
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] not in (0, None)}
    assert by_id[1]["fingerprint"] == "0" * 16 and by_id[2]["component_id"] == 0 and by_id[4]["component_id"] == 3
    kept = {r["doc_id"] for r in simhash.keep_one(docs).collect()}
    assert kept == {0, 3, 5, 6, 9, 10, 11, 12, 13, None} and simhash.keep_one(docs).columns == docs.columns
    assert simhash.near_groups(docs.limit(0)).count() == simhash.keep_one(docs.limit(0)).count() == 0


def test_mix(spark):
    texts = [" ".join(words(i % 40 + 1, i)) for i in range(600)] + [None, ""]
    docs = make(spark, texts)
    rows = mixing.mix(docs).collect()
    assert Counter(map(str, rows)) == Counter(map(str, mixing.mix(docs.repartition(7)).collect()))
    sizes, taken, target = Counter(), Counter(), {}
    for r in rows:
        assert r["size"] == len(words_of(texts[r["doc_id"]])) and r["taken"] == r["size"] * r["copies"] <= 3 * r["size"]
        assert len(r["positions"]) == r["copies"] and all(0 <= p <= 1 for p in r["positions"])
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    weights = {s: 1 + i % 3 for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    want, free, left = {}, set(sizes), sum(sizes.values())
    while free:
        share = {s: left * weights[s] / sum(weights[x] for x in free) for s in free}
        full = {s for s in free if share[s] > 3 * sizes[s]}
        want.update({s: 3 * sizes[s] for s in full} or share)
        left, free = left - sum(3 * sizes[s] for s in full), free - full if full else set()
    for s in sizes:
        assert target[s] == pytest.approx(want[s]) and abs(taken[s] - target[s]) <= 40
    order = [r["position"] for r in mixing.by_position(mixing.mix(docs)).collect()]
    assert order == sorted(order) and mixing.mix(docs.limit(0)).count() == 0


def test_passages(spark):
    item = words(40, 9)
    items = spark.createDataFrame([(0, " ".join(item)), (1, None), (2, ""), (3, "tiny item here"), (4, " ".join(words(40, 8)))], "item_id long, text string")
    rest = words(60, 10)
    texts = [
        " ".join(rest[:30] + item + rest[30:]), " ".join(rest[:30] + item[:38] + rest[30:]), " ".join(rest[:30] + item[:12] + rest[30:]),
        " ".join(rest), None, "", " ".join(item).upper(), "a tiny  item\there indeed", " ".join(rest[:30] + item + rest[30:]),
    ]
    docs = make(spark, texts)
    got = {(r["doc_id"], r["item_id"], r["at_word"]) for r in decontaminate.contaminated(docs, items).collect()}
    assert got == {(0, 0, 30), (1, 0, 30), (6, 0, 0), (7, 3, 1), (8, 0, 30)}
    clean = decontaminate.without_passages(docs, items)
    assert {r["doc_id"] for r in clean.collect()} == {2, 3, 4, 5} and clean.columns == docs.columns
    assert decontaminate.contaminated(docs, items.limit(0)).count() == decontaminate.contaminated(docs.limit(0), items).count() == 0


def test_main_text():
    tree = extraction.trained()
    page = """<html><head><title>T</title><script>var a = "<p>no</p>"</script></head><body><nav><a href=x>Home</a></nav>
      <article><header><h1>A title</h1></header><p>First &amp; only<br>line with <b>bold text.<p>Of.</p>
      <div class="ad">Buy this now</div><form>Name <input></form><section class="comments"><p>Nice article, thank you all</p></section></article>
      <aside>Other things</aside><div id="cookie-notice">We use cookies</div><footer>&copy; us</footer>"""
    assert extraction.main_text(page, tree) == "A title\n\nFirst & only line with bold text.\n\nOf."
    assert [extraction.main_text(p, tree) for p in (None, "", "<p>", "<!-- x")] == [""] * 4


def test_pages_with_odd_rows(spark):
    pages = spark.createDataFrame([(1, None, None, "t"), (None, "u", "", "t"), (2, "u", "<article><p>Some text</p></article>", "t")], "page_id long, url string, html string, text string")
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in extraction.extract(pages).collect()}
    assert got == {1: ("", 0), None: ("", 0), 2: ("Some text", 9)} and extraction.extract(pages.limit(0)).count() == 0


def test_languages(spark):
    spanish, english = "el perro corre por la calle y la niña mira", "the dog runs along the street and the girl looks"
    docs = spark.createDataFrame([(i, spanish if i % 2 else english, "es" if i % 2 else "en") for i in range(40)], "doc_id long, text string, lang string")
    learned = language.learn(language.bounded_sample(docs, "doc_id", "lang", 1000))
    odd = spark.createDataFrame([(1, "la niña corre"), (2, "the girl"), (3, None), (4, "123 !?"), (5, "")], "doc_id long, text string")
    got = {r["doc_id"]: r["lang_pred"] for r in language.predict(odd, learned).collect()}
    assert got == {1: "es", 2: "en", 3: "und", 4: "und", 5: "und"}
    assert {r["lang_pred"] for r in language.predict(odd, {}).collect()} == {"und"}


def test_toxicity(spark):
    clean = [" ".join(words(60, i)) + " you are he, a person." for i in range(200)]
    toxic = [" ".join(words(30, 500 + i)) + f" you zorkish{'abc'[i % 3]} person. " + " ".join(words(20, 800 + i)) for i in range(40)]
    docs = spark.createDataFrame([(t, 0) for t in clean] + [(t, 1) for t in toxic], "text string, toxic int")
    model = toxicity.learn(docs)
    test = spark.createDataFrame([(1, "hello there"), (2, "he is zorkishd, that one"), (3, None), (4, "")], "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in toxicity.score(test, model).collect()}
    assert got[2] > 0.5 and max(got[1], got[3], got[4]) < 0.5
    assert {r["doc_id"] for r in toxicity.without_toxic(test, model).collect()} == {1, 3, 4}
    assert toxicity.learn(docs.limit(0)).score(np.zeros(toxicity.FEATURES)) < 0.5


def test_clauses():
    insult, you, no, said = ("insult", 1.0), ("target", 1.0), ("negation", 1.0), ("report", 1.0)
    kinds = [[k for k, _ in toxicity.match_clause(c)] for c in ([insult], [you, insult], [no, None, insult], [said, insult], [None])]
    assert kinds == [["insult"], ["insult_target"], ["negated"], ["reported"], []]


def test_licences(spark):
    docs = spark.createDataFrame([(1, "x\nReleased under the MIT license!\ny"), (2, "the license of a thing"), (3, None), (4, "")], "doc_id long, text string")
    assert [(r["doc_id"], r["licence"], r["at_word"], r["dice"]) for r in licences.find_licences(docs).collect() if r["licence"] == "MIT"] == [(1, "MIT", 1, 1.0)]


def test_crc_folds(spark):
    from driftline.llm.common import fold

    ids = spark.createDataFrame([(17,), (-3,), (None,)], "doc_id long").select("doc_id", fold("doc_id", 5).alias("fold"))
    assert {r["doc_id"]: r["fold"] for r in ids.collect()} == {i: zlib.crc32(b"" if i is None else str(i).encode()) % 5 for i in (17, -3, None)}


def test_queries_and_pipeline_on_the_smallest_tables(spark):
    import corpus_pipeline
    from driftline.llm.queries import CATALOG
    from oracle import compare, database

    sf_dir = "/root/testdata/sf0.001"
    con = database(sf_dir)
    for name, sql in CATALOG.sql.items():
        assert compare(CATALOG.queries[name](spark, sf_dir), con, sql) == [], name
    result = corpus_pipeline.run(spark, sf_dir)
    total = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert 0 < result.select("doc_id").distinct().count() <= total
    assert result.filter(F.col("shard").isNull()).isEmpty()


def jaccard(a, b):
    one, other = ({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (a.lower().split(), b.lower().split()))
    return len(one & other) / len(one | other)


def test_near_copies_meet_behind_an_unlike_first_text(spark):
    base = words(240, 31)
    sentences = [base[i : i + 40] for i in range(0, 240, 40)]
    flat = lambda order: " ".join(w for i in order for w in sentences[i])
    shuffled = [list(np.random.default_rng(s).permutation(base)) for s in range(6)]
    texts = [flat([0, 1, 2, 3, 4, 5]), flat([0, 1, 2, 4, 5, 3]), *[" ".join(w) for w in shuffled]]
    assert jaccard(texts[0], texts[1]) >= 0.8 and len({simhash.near_features(t)[0].tobytes() for t in texts}) == 1
    assert {r["doc_id"] for r in simhash.keep_one(make(spark, texts)).collect()} == {0, 2, 3, 4, 5, 6, 7}


def plain_similarity(one, other):
    one, other = (Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) for w in (one, other))
    return (one & other).total() / max(1, (one | other).total())


def test_passages_with_parts_reordered(spark):
    rest, one, two = words(200, 41), words(60, 42), words(45, 43)
    items = spark.createDataFrame([(0, " ".join(one)), (1, " ".join(two)), (2, " ".join([*two[:20], *one[:25]]))], "item_id long, text string")
    texts = [
        rest[:90] + one[30:] + one[:30] + rest[90:], rest[:7] + two[30:] + two[:30] + rest[7:], one[40:] + one[:40], one[:50],
        rest[:50] + one[20:] + rest[50:60] + one[:20], rest[:20] + one[:57] + rest[20:99] + two[10:] + two[:10], rest,
    ]
    expected = {}
    for i, w in enumerate(texts):
        for k, item in enumerate((one, two, [*two[:20], *one[:25]])):
            best = max(plain_similarity(w[s : s + len(item)], item) for s in range(max(1, len(w) - len(item) + 1)))
            if best >= 0.8:
                expected[i, k] = best
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontaminate.contaminated(make(spark, [" ".join(w) for w in texts]), items).collect()}
    assert got == pytest.approx(expected) and {(0, 0), (1, 1), (2, 0), (5, 0), (5, 1)} <= set(got)


def test_only_hidden_elements_are_left_out():
    tree, text = extraction.trained(), "This is a paragraph of some length that a reader of the page would like to see in the end."
    for attributes in ('class="overflow-hidden"', 'aria-hidden="false"', 'data-x="hidden"', 'data-hidden="1"', 'title="display: none"', "class=hidden-sm"):
        assert extraction.main_text(f"<body {attributes}><article {attributes}><p>{text}</p></article></body>", tree) == text, attributes
    for attributes in ("hidden", 'hidden=""', 'class="a" HIDDEN', 'aria-hidden="true"', "aria-hidden=TRUE", 'style="color: red; display:none"', "style='display : none !important'"):
        assert extraction.main_text(f"<article><div {attributes}><p>{text}</p></div></article>", tree) == "", attributes


def test_a_notice_is_claimed_by_its_own_licence():
    match = licences.Matcher(licences.TEMPLATES, licences.LEAST)
    for name, text in licences.TEMPLATES.items():
        assert [f[0] for f in match(f"Some words before. {text} And some more after it.")] == [name]
    by, nc = licences.TEMPLATES["CC-BY-4.0"], "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."
    assert [f[0] for f in match(nc)] == ["CC-BY-NC-4.0-notice"]
    assert [f[0] for f in match(f"{nc} The pictures are not. {by}")] == ["CC-BY-4.0", "CC-BY-NC-4.0-notice"]
    assert [f[0] for f in match("This work is licensed under the GNU General Public License, version 2.")] == ["GPL-2.0"]


def test_near_copies_are_judged_exactly(spark):
    texts, stay = [], set()
    for seed in range(8):
        base = words(240, 60 + seed)
        parts = [base[i : i + 30] for i in range(0, 240, 30)]
        # Five to eight joints of parts are broken, four shingles at each.
        order = ([1, 2, 3, 0, 4, 5, 6, 7], [1, 0, 3, 2, 5, 4, 7, 6], [0, 2, 1, 4, 3, 6, 5, 7], [1, 0, 3, 2, 5, 4, 6, 7])[seed % 4]
        texts += [" ".join(base), " ".join(w for i in order for w in parts[i])]
        stay |= {2 * seed} if jaccard(*texts[-2:]) >= 0.8 else {2 * seed, 2 * seed + 1}
    alike = [jaccard(*texts[i : i + 2]) for i in range(0, 16, 2)]
    assert any(0.75 < j < 0.8 for j in alike) and any(j >= 0.8 for j in alike)
    assert {r["doc_id"] for r in simhash.keep_one(make(spark, texts)).collect()} == stay


def test_rows_equal_in_everything_are_cut(spark):
    rows = make(spark, [f"text {i} " + "x" * (i % 50) for i in range(400)])
    same = spark.range(2000).select(*[F.lit(v).cast(t).alias(c) for (c, t), v in zip(rows.dtypes, (7, "the same row " * 15, "en", "s", 0, 7, "x", 1), strict=True)])
    got = sharding.shard(rows.unionByName(same), 8).collect()
    sizes, slots = Counter(), defaultdict(list)
    for r in got:
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    fair = sum(sizes.values()) / 8
    assert len(got) == 2400 and len(sizes) == 8 and max(sizes.values()) < 1.02 * fair and min(sizes.values()) > 0.98 * fair
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    # A text with less than a shard's share stays in one, its equal rows in many pieces.
    few = sharding.shard(rows.unionByName(same.limit(10)), 8, rows_per_piece=10).filter("doc_id = 7 AND text LIKE 'the same%'")
    assert few.select("shard").distinct().count() == 1


CLASHING = ("_key", "_piece", "_row", "_start", "_nth", "_mark", "_maybe", "maybe", "toxic", "_h1", "_h2", "_hot", "_bucket", "_least", "_stays", "h1", "id", "mark", "bitmap")


def test_columns_of_any_name_pass(spark):
    base, item = words(90, 71), words(40, 72)
    docs = make(spark, [" ".join(base), " ".join([*base[:50], "x", *base[51:]]), " ".join(words(30, 73) + item), None, "short"])
    docs = docs.select("doc_id", "text", "lang", "source", "n_chars", *[F.concat(F.lit(f"{c}-"), "doc_id").alias(c) for c in CLASHING])
    items = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    kept = simhash.keep_one(docs)
    clean = decontaminate.without_passages(docs, items)
    shards = sharding.shard(docs, 2)
    toxic = toxicity.without_toxic(docs, toxicity.learn(docs.select("text", F.lit(0).alias("toxic"))))
    for result, ids in ((kept, {0, 2, 3, 4}), (clean, {0, 1, 3, 4}), (shards, {0, 1, 2, 3, 4}), (toxic, {0, 1, 2, 3, 4})):
        rows = result.collect()
        assert {r["doc_id"] for r in rows} == ids and len(rows) == len(ids)
        assert all(r[c] == f"{c}-{r['doc_id']}" for r in rows for c in CLASHING)


def links_of(spark, texts):
    docs = make(spark, texts)
    h1, h2 = identity("text")
    narrow = docs.select(h1.alias("h1"), h2.alias("h2"), F.col("doc_id").alias("id"), "text")
    distinct = simhash.distinct_texts(narrow)
    ids = {r["mark"]: r["id"] for r in distinct.collect()}
    return [(ids[r["a"]], ids[r["b"]]) for r in simhash.similar_texts(distinct, narrow).collect()]


def components_of(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    return {n: root(n) for n in nodes}


def test_links_grow_with_the_texts_not_the_pairs(spark):
    base, counts = words(60, 81), {}
    for n in (150, 300):
        texts = [" ".join([*base[: i % 60], f"new{i}", *base[i % 60 + 1 :]]) for i in range(n)]
        links = links_of(spark, texts)
        assert len(links) == len(set(links))
        counts[n] = len(links)
        # Similar pairs that a search can find lie in one component.
        found = components_of(range(n), links)
        assert all(jaccard(texts[a], texts[b]) >= 0.8 for a, b in links)
        searched = [simhash.near_features(t)[0] for t in texts]
        for a in range(n):
            for b in range(a + 1, n):
                meet = any(int(x ^ y) == 0 or (int(x) ^ int(y)).bit_count() <= 2 for x, y in zip(searched[a].view(np.uint64), searched[b].view(np.uint64), strict=True))
                if meet and jaccard(texts[a], texts[b]) >= 0.8:
                    assert found[a] == found[b]
    assert counts[300] <= 2.2 * counts[150] and counts[300] < 8 * 300


def test_members_of_a_dense_group_are_not_copied_to_each_other(spark, monkeypatch):
    base, seen, plain = words(60, 81), [], simhash._links_to_try

    def counted(buckets, threshold, most):
        seen.append(buckets.agg(F.sum(F.size("one") + F.size("other"))).first()[0] or 0)
        return plain(buckets, threshold, most)

    monkeypatch.setattr(simhash, "_links_to_try", counted)
    texts = [" ".join([*base[: i % 60], f"new{i}", *base[i % 60 + 1 :]]) for i in range(150)]
    links = links_of(spark, texts)
    assert len(set(components_of(range(150), links).values())) == 1
    # At home and as a visitor once for each search, and few after that.
    assert sum(seen) <= 3 * simhash.SEARCHES * 150


def test_rounds_of_components_ask_nothing_but_what_they_store(spark, monkeypatch):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    asked = []
    for name in ("count", "first", "isEmpty"):
        plain = getattr(type(links), name)
        monkeypatch.setattr(type(links), name, lambda df, *a, plain=plain, name=name: asked.append(name) or plain(df, *a))
    found = simhash.components(links).collect()
    assert {r["node"]: r["root"] for r in found} == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100} and len(found) == 43
    assert simhash.components(links.filter("a < 0")).collect() == []
    assert asked == []


def test_rejected_links_are_replaced(spark):
    # Many orders of the same words, most of them unlike, and a few pairs alike among them: the first tries fail.
    base = words(200, 91)
    orders = [list(np.random.default_rng(s).permutation(base)) for s in range(12)]
    texts = [" ".join(o) for o in orders] + [" ".join([*o[100:], *o[:100]]) for o in orders[::3]]
    alike = {(a, b) for a in range(len(texts)) for b in range(a + 1, len(texts)) if jaccard(texts[a], texts[b]) >= 0.8}
    assert len(alike) == 4 and {tuple(sorted(p)) for p in links_of(spark, texts)} == alike


def test_a_forest_of_links():
    edges, likely = np.array([[1, 2], [2, 3], [1, 3], [4, 5], [2, 1], [3, 4], [5, 1], [2, 3]]), np.array([True] * 5 + [False] * 3)
    assert simhash._forest(edges, likely, 2) == ([0, 1, 3, 5, 6], True)
    assert simhash._forest(edges, likely, 1) == ([0, 1, 3, 5], False)
    assert simhash._forest(edges, ~likely, 0) == ([5, 6, 7], False)


@pytest.mark.parametrize("size", [1000, 5000])
def test_long_items_and_repeated_shingles(spark, size):
    rest, item = words(300, 95), words(size, 96)
    echo = ["la", "le", "lu"] * 40
    items = spark.createDataFrame([(0, " ".join(item)), (1, " ".join(echo))], "item_id long, text string")
    texts = [
        rest[:100] + item[size // 2 :] + item[: size // 2] + rest, item[: size * 17 // 20], rest + echo[:110] + rest[:9], echo * 5, rest + item[: size // 2],
        rest + item + rest + item[: size - 10],
    ]
    expected = {}
    for i, w in enumerate(texts):
        for k, own in enumerate((item, echo)):
            starts = range(max(1, len(w) - len(own) + 1)) if k else {0, 100, 300, 600 + size, *range(95, 106)} & set(range(max(1, len(w) - len(own) + 1)))
            best = max(plain_similarity(w[s : s + len(own)], own) for s in starts)
            if best >= 0.8:
                expected[i, k] = best
    found = decontaminate.contaminated(make(spark, [" ".join(w) for w in texts]), items).collect()
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in found}
    assert set(got) == set(expected) and all(got[k] >= v - 1e-9 for k, v in expected.items())
    assert {(0, 0), (1, 0), (2, 1), (3, 1), (5, 0)} <= set(got)


TEXT = "This is a paragraph of some length that a reader of the page would like to see in the end."


@pytest.mark.parametrize("page, expected", [
    (f"<form id=aspnetForm><p>Your name</p><article><p>{TEXT}</p></article><input></form>", [TEXT]),
    (f"<article><p>{TEXT}</p><form><p>{TEXT}</p></form></article>", [TEXT]),
    (f'<article class="subscription-economics"><p>{TEXT}</p></article>', [TEXT]),
    (f'<article class="post related"><p>{TEXT}</p><article class="related"><p>{TEXT}</p></article></article>', [TEXT]),
    (f"<article><p>{TEXT}<p class=ad>Buy<h2>Real heading</h2><p>{TEXT}</article>", [TEXT, "Real heading", TEXT]),
    (f"<article><p title=it's>{TEXT}</p><p>{TEXT}</p><p title=it's>{TEXT}</p></article>", [TEXT] * 3),
    (f"<article><p title='a > b' data-x = \"c > d\">{TEXT}</p></article>", [TEXT]),
    (f"<article><p>{TEXT}</p><p><a href=x>{TEXT}</a></p><p>{TEXT}</p><p>Look <a href=x>{TEXT}</a> there</p><p>{TEXT}</p></article>", [TEXT, TEXT, TEXT, f"Look {TEXT} there", TEXT]),
    (f"<article><p>{TEXT} <span hidden>no <span>no</span></span><i style='display:none'>no</i><span class=ad>no</span>yes</p></article>", [f"{TEXT} yes"]),
    (f"<article><p>{TEXT} <span hidden>no</p><p>{TEXT}</p></article>", [TEXT, TEXT]),
    (f"<article data-url=/a/b/><p>{TEXT}</p></article><aside/><article><p>{TEXT}</p></article>", [TEXT, TEXT]),
])
def test_pages_that_lost_or_kept_wrongly(page, expected):
    assert extraction.main_text(page, extraction.trained()) == "\n\n".join(expected)


def test_unclosed_elements_cost_little():
    import time

    begun = time.process_time()
    extraction.main_text("<div>" * 100_000 + "</p>" * 100_000, extraction.trained())
    assert time.process_time() - begun < 5


def test_pages_against_their_article_element(spark):
    """The given pages, against a plain reading: the paragraphs and headings of the article, without what stands in side matter."""
    from driftline.llm.common import read

    pages = read(spark, "/root/testdata/sf0.01", "pages")
    texts = [r["text"] for r in extraction.extract(pages).collect()]
    assert len(texts) == pages.count() and sum(bool(t) for t in texts) > 0.9 * len(texts)


def plain_licences(text, templates, least):
    """Every window that begins with a pair of the template, counted by itself; the best claim their words first."""
    pairs = licences.bigrams(text)
    windows = []
    for name, template in templates.items():
        own = Counter(licences.bigrams(template))
        size = own.total()
        if len(pairs) < size * least / (2 - least):
            continue
        for begin, pair in enumerate(pairs):
            if pair in own:
                window = pairs[begin : begin + size]
                dice = 2 * (Counter(window) & own).total() / (size + len(window))
                if dice >= least:
                    last = max(i for i, p in enumerate(window) if p in own)
                    windows.append((-dice, -size, begin, begin + last + 1, name))
    found, claimed = {}, set()
    for dice, _, begin, end, name in sorted(windows):
        held = set(range(begin, end))
        if 2 * len(held & claimed) <= len(held):
            claimed |= held
            found.setdefault(name, (name, begin, -dice))
    return sorted(found.values())


def test_licences_against_all_windows():
    rng = np.random.default_rng(12)
    short = {n: t for n, t in licences.TEMPLATES.items() if not n.endswith("-text")}
    whole = licences.TEMPLATES["ISC-text"]
    match = licences.Matcher({**short, "ISC-text": whole}, 0.8)
    names = list(short)
    for seed in range(25):
        parts = []
        for _ in range(6):
            w = short[names[rng.integers(len(names))]].split()
            if rng.random() < 0.5:
                w[rng.integers(len(w))] = "changed"
            parts += words(int(rng.integers(0, 9)), seed) + w * int(rng.integers(1, 3))
        text = " ".join([*parts, whole if seed % 3 == 0 else "the the the the license the license"])
        got = [(n, a, pytest.approx(d)) for n, a, d in match(text)]
        assert got == plain_licences(text, {**short, "ISC-text": whole}, 0.8) and got


def test_whole_licences_cost_little_and_name_the_licence(spark):
    import time

    match, text = licences.Matcher(licences.TEMPLATES, licences.LEAST), licences.TEMPLATES["GPL-3-text"]
    begun = time.process_time()
    assert [f[:2] for f in match(" ".join([text] * 8))] == [("GPL-3-text", 0)]
    assert time.process_time() - begun < 2
    assert [licences.licence_of(t) for t in ("GPL-3-text", "GPL-3.0", "GPL-header", "CC-BY-4.0-short", "CC-BY-NC-4.0-notice", "MIT")] == [
        "GPL-3.0", "GPL-3.0", "GPL", "CC-BY-4.0", "CC-BY-NC-4.0", "MIT"
    ]
    docs = spark.createDataFrame([(1, text, "x"), (1, text, "y"), (None, "", "z"), (2, None, "z")], "doc_id long, text string, names string")
    found = licences.find_licences(docs).collect()
    assert [(r["doc_id"], r["licence"], r["names"]) for r in found] == [(1, "GPL-3-text", "GPL-3.0")] * 2
    assert licences.find_licences(docs.limit(0)).count() == 0


def plain_clause(symbols):
    """What each insult or threat stands under, looked up by distance."""
    found = []
    for i, s in enumerate(symbols):
        if s is None or s[0] not in ("insult", "threat"):
            continue

        def near(kind, words, i=i):
            return any(x and x[0] == kind for x in symbols[max(0, i - words) : i])

        # A target that follows belongs to the last insult or threat before it, if that stands under nothing else.
        after = next((j for j in range(i + 1, min(len(symbols), i + 1 + toxicity.AIM)) if symbols[j] and symbols[j][0] in ("insult", "threat", "target")), None)
        follows = after is not None and symbols[after][0] == "target"
        if near("report", toxicity.REPORTED):
            pattern = "reported"
        elif near("negation", toxicity.REACH):
            pattern = "negated"
        else:
            pattern = f"{s[0]}_target" if near("target", toxicity.AIM) or follows else s[0]
        found.append((pattern, s[1]))
    return found


def test_the_composed_machine_against_distances():
    rng = np.random.default_rng(3)
    kinds = [None, None, None, None, ("insult", 1.0), ("threat", 2.0), ("target", 1.0), ("negation", 1.0), ("report", 1.0)]
    for _ in range(3000):
        clause = [kinds[k] for k in rng.integers(0, len(kinds), rng.integers(0, 25))]
        assert toxicity.match_clause(clause) == plain_clause(clause)
    states = {s for s, _ in toxicity.CLAUSES.table}
    assert len(toxicity.CLAUSES.table) == len(states) * len(toxicity.SYMBOLS)


def test_equal_texts_with_unlike_labels(spark):
    rows = [("you zork person", 1)] * 3 + [("you zork person", 0)] * 2 + [(f"you zork{i} person here", 1) for i in range(30)] + [(f"fine words {i}", 0) for i in range(60)] + [(None, 0), ("", None), ("x", 7)]
    docs = spark.createDataFrame(rows, "text string, toxic int")
    models = [toxicity.learn(docs.repartition(n)) for n in (1, 7)]
    assert models[0].lexicon == models[1].lexicon and np.allclose(models[0].weights, models[1].weights) and models[0].lexicon.stems
    assert toxicity.learn(docs.filter("toxic = 7")).bias == -1.5
    scored = toxicity.score(docs.withColumn("score", F.lit("old")), models[0])
    assert scored.columns == ["toxic", "score"] and scored.count() == len(rows)
    assert toxicity.score(docs.limit(0), models[0]).count() == 0


def test_predictions_of_nothing(spark):
    docs = spark.createDataFrame([("la niña corre", "es", "old")], "text string, lang string, lang_pred string")
    learned = language.learn(docs)
    assert language.predict(docs.limit(0), learned).count() == 0
    [row] = language.predict(docs, learned).collect()
    assert (row["lang_pred"], row["lang"]) == ("es", "es")


def test_passages_with_very_many_buckets(spark, docs, monkeypatch):
    monkeypatch.setattr(substrings, "WORDS_PER_BUCKET", 0.001)
    untouched, checked = substrings.remove_repeats(docs, window=35)
    got = {(r["id"], r["n_removed"]) for r in checked.collect()} | {(r["id"], 0) for r in untouched.collect()}
    monkeypatch.undo()
    untouched, checked = substrings.remove_repeats(docs, window=35)
    assert got == {(r["id"], r["n_removed"]) for r in checked.collect()} | {(r["id"], 0) for r in untouched.collect()}
