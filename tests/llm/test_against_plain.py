"""Whole queries and the pipeline against plain versions and held-out labels."""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_text_operators import components_of, jaccard, plain_fingerprint, plain_similarity, words

import corpus_pipeline
from driftline.llm import simhash
from driftline.llm.queries import CATALOG

SF = "/root/testdata/sf0.01"


def plain_article(page):
    """The blocks of the article element, by its tags alone."""
    found = re.search(r"<article[^>]*>(.*?)</article>", page or "", re.S)
    if not found:
        return ""
    body = re.sub(r"<(script|style|aside|nav|form|footer)\b.*?</\1>", "\n\n", found[1], flags=re.S)
    body = re.sub(r"<br\s*/?>", " ", body)
    blocks = re.split(r"</?(?:p|h\d|ul|ol|li|div|section|blockquote|pre|table|tr|td|header|figure)\b[^>]*>", body)
    texts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks]
    return "\n\n".join(t for t in texts if t)


def test_main_text_against_the_article_element(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in CATALOG.queries["op2_main_text"](spark, SF).collect()}
    plain = {r["page_id"]: plain_article(r["html"]) for r in pages.collect()}
    assert set(got) == set(plain) and all(n == len(t) for t, n in got.values())
    same = sum(got[i][0] == t for i, t in plain.items())
    assert same >= 0.99 * len(plain), [(got[i][0][:200], t[:200]) for i, t in plain.items() if got[i][0] != t][:2]


def test_languages_of_documents_held_out(spark):
    langs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = CATALOG.queries["op6_language"](spark, SF).join(langs, "doc_id").filter("held_out AND lang IS NOT NULL AND lang_pred <> 'und'").collect()
    assert len(rows) > 100 and np.mean([r["lang"] == r["lang_pred"] for r in rows]) >= 0.98


def test_toxicity_of_documents_held_out(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    rows = CATALOG.queries["op9_toxicity"](spark, SF).join(labels, "doc_id").filter("held_out").collect()
    # Few labels to learn from here; the README has the figure of a larger table.
    assert len(rows) > 20 and np.mean([r["toxic"] == r["predicted"] for r in rows]) >= 0.9
    assert all(r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_components_of_fingerprints(spark):
    rng = np.random.default_rng(8)
    texts = [None, "", "one two", "one  TWO"] + [" ".join(words(400, 100 + i)) for i in range(30)]
    for i in range(60):
        w = texts[int(rng.integers(4, len(texts)))].split()
        w[int(rng.integers(len(w)))] = f"x{i}"
        texts.append(" ".join(w))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(None, texts[5])], "doc_id long, text string")
    got = simhash.near_groups(docs).collect()
    prints = {i: plain_fingerprint(t) for i, t in enumerate(texts)}
    links = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    of = components_of(prints, links)
    assert {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in got if r["doc_id"] is not None} == {(i, f"{prints[i]:016x}", of[i]) for i in prints}
    assert [r["component_id"] for r in got if r["doc_id"] is None] == [of[5]] and len(set(of.values())) < len(of) - 10


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Documents with toxic ones, exact and near copies, passages of the benchmark, nulls; labels and benchmark beside them."""
    rng = np.random.default_rng(31)
    clean = [" ".join(words(80, 200 + i)) for i in range(90)]
    toxic = [" ".join(words(40, 400 + i)) + f" you zorkish{'abc'[i % 3]} person, you fool. " + " ".join(words(30, 500 + i)) for i in range(40)]
    items = [" ".join(words(40, 700 + i)) for i in range(3)]
    leaks = [" ".join([*words(30, 800 + i), *items[i % 3].split(), *words(20, 900 + i)]) for i in range(9)]
    leaks += [" ".join([*words(30, 850), *items[0].split()[20:], *items[0].split()[:20], *words(9, 851)])]
    texts = clean + toxic + leaks + clean[:20] + [None, "", " "]
    for i in range(30):
        w = clean[i].split()
        w[int(rng.integers(len(w)))] = f"changed{i}"
        texts.append(" ".join(w))
    rows = [(i, t, "en", None if i % 7 == 0 else f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    folder = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4).write.parquet(f"{folder}/documents.parquet")
    labelled = [(i, 1, int(90 <= i < 130)) for i in range(140) if i % 4]
    spark.createDataFrame(labelled, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), {r[0]: r for r in rows}, items


def test_the_five_stages_against_plain_versions(spark, corpus, tmp_path):
    folder, rows, items = corpus
    docs, outputs = spark.read.parquet(f"{folder}/documents.parquet"), []
    columns = docs.columns
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        result = stage(spark, docs, folder)
        result.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        outputs.append(docs.collect())
        assert i == 4 or docs.columns == columns
    toxicity, unlike, clean, mixed, shards = outputs
    toxic = set(range(90, 130))
    assert {r["doc_id"] for r in toxicity} == set(rows) - toxic

    left = {r["doc_id"]: r["text"] or "" for r in toxicity}
    links = [(a, b) for a in left for b in left if a < b and (left[a].split() == left[b].split() or left[a].split() and left[b].split() and jaccard(left[a], left[b]) >= 0.8)]
    assert {r["doc_id"] for r in unlike} == set(components_of(left, links).values())

    def leaks(text):
        w = text.lower().split()
        return any(plain_similarity(w[s : s + 40], item.split()) >= 0.8 for item in items for s in range(max(1, len(w) - 39)))

    assert {r["doc_id"] for r in clean} == {r["doc_id"] for r in unlike if not leaks(r["text"] or "")}
    assert len(unlike) - len(clean) == 10

    sizes, taken, of = defaultdict(int), defaultdict(int), {r["doc_id"]: r for r in clean}
    for r in clean:
        sizes[r["source"]] += len((r["text"] or "").split())
    copies = Counter(r["doc_id"] for r in mixed)
    assert set(copies) <= set(of) and max(copies.values()) <= 3
    for i, n in copies.items():
        taken[of[i]["source"]] += n * len(of[i]["text"].split())
    weights = {s: 1 + i % 3 for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    want, free, rest = {}, set(sizes), sum(sizes.values())
    while free:
        share = {s: rest * weights[s] / sum(weights[x] for x in free) for s in free}
        full = {s for s in free if share[s] > 3 * sizes[s]}
        want.update({s: 3 * sizes[s] for s in full} or share)
        rest, free = rest - sum(3 * sizes[s] for s in full), free - full if full else set()
    assert all(abs(taken[s] - want[s]) <= 45 for s in sizes)

    assert Counter(r["doc_id"] for r in shards) == copies
    slots = defaultdict(list)
    for r in shards:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(40))


def test_stages_of_odd_tables(spark, corpus, tmp_path):
    folder, rows, _ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), folder).count() == 0, name
    same = docs.filter("doc_id = 1").unionByName(docs.filter("doc_id = 1")).withColumn("toxic", F.lit(1)).withColumn("doc_id", F.lit(None).cast("long"))
    left = same
    for name, stage in corpus_pipeline.STAGES[:3]:
        left = stage(spark, left, folder)
    # Rows equal in id and text are one document; a column called like a label passes.
    assert [(r["doc_id"], r["toxic"]) for r in left.collect()] == [(None, 1)]
