"""The registered queries of the text operators, each over its whole table, and their SQL."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.llm import (
    alignment, decontaminate, exact_dedup, extraction, language, licences, mixing, negatives, neighbours, sharding, simhash, substrings,
    toxicity,
)
from driftline.llm.common import fold, read, text_or_empty
from driftline.plans.registry import Catalog

CATALOG = Catalog()

LANGUAGE_ROWS = 3_000
TOXICITY_ROWS = 20_000
# Where the driver finds the vocabulary files; tasks get their contents.
TOKENIZERS = "/opt/tokenizers"


@CATALOG.add("op1_histogram_shards")
def histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    placed = sharding.shard(docs, 40)
    return placed.select(
        "doc_id", "size", F.crc32(text_or_empty()).cast("long").alias("text_crc32"), "law", "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@CATALOG.add("op2_main_text")
def main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(read(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


@CATALOG.add(
    "op3_exact_dedup",
    """WITH digests AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
       SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
              doc_id = max(doc_id) OVER same AS kept, text_sha256
       FROM digests WINDOW same AS (PARTITION BY text_sha256)""",
)
def exact_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read(spark, sf_dir, "documents"))


@CATALOG.add(
    "op4_repeated_passages",
    r"""WITH given AS (
          SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
        ), windows AS (
          SELECT doc_id, i, array_to_string(ws[i:i + 34], ' ') AS t
          FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 34)) AS i FROM given WHERE len(ws) >= 35)
        ), repeated AS (
          SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY t) AS n FROM windows) WHERE n > 1
        ), covered AS (
          SELECT DISTINCT doc_id, j FROM (SELECT doc_id, unnest(generate_series(i, i + 34)) AS j FROM repeated)
        ), placed AS (
          SELECT doc_id, unnest(ws) AS word, unnest(generate_series(1, len(ws))) AS j FROM given
        ), kept AS (
          SELECT p.doc_id, string_agg(word, ' ' ORDER BY p.j) AS t, count(*) AS n
          FROM placed p LEFT JOIN covered c ON p.doc_id = c.doc_id AND p.j = c.j WHERE c.j IS NULL GROUP BY p.doc_id
        )
        SELECT g.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
               sha256(coalesce(t, '')) AS kept_sha256
        FROM given g LEFT JOIN kept k ON g.doc_id = k.doc_id""",
)
def repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    untouched, checked = substrings.remove_repeats(read(spark, sf_dir, "documents"), window=35)
    digested = checked.select("id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("digest"))
    return untouched.unionByName(digested).withColumnsRenamed({"id": "doc_id", "digest": "kept_sha256"})


@CATALOG.add("op5_simhash_groups")
def simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(read(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


@CATALOG.add("op6_language")
def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").withColumn("held_out", fold("doc_id", 4) == 2)
    known = docs.filter("NOT held_out AND lang IS NOT NULL")
    learned = language.learn(language.bounded_sample(known, "doc_id", "lang", LANGUAGE_ROWS))
    return language.predict(docs.select("doc_id", "held_out", "text"), learned)


@CATALOG.add("op7_curriculum_mix")
def curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "positions").orderBy(F.get("positions", F.lit(0)), "doc_id")


@CATALOG.add("op8_licence_notices")
def licence_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.find_licences(read(spark, sf_dir, "documents"))


@CATALOG.add("op9_toxicity")
def toxic_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", fold("doc_id", 5) == 0)
    labels = read(spark, sf_dir, "labels").select("doc_id", "toxic")
    learned = toxicity.learn(docs.filter("NOT held_out").join(labels, "doc_id").select("text", "toxic"), most_rows=TOXICITY_ROWS)
    return toxicity.score(docs, learned).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@CATALOG.add("op10_benchmark_passages")
def benchmark_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@CATALOG.add("op11_token_alignment")
def token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    byte_level, pieces = (Path(TOKENIZERS, name).read_bytes() for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.token_alignment(read(spark, sf_dir, "documents"), byte_level, pieces)


@CATALOG.add("op12_nearest_vectors")
def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@CATALOG.add(
    "op13_hard_negatives",
    """WITH given AS (
          SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                 list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
          FROM embeddings
          WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
          SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
          FROM given a JOIN given b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
        ), positives AS (
          SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
        )
        SELECT p.anchor_id, positive_id, CAST(row_number() OVER best AS INT) AS rank, other_id AS negative_id, positive_score, score AS negative_score
        FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
        WINDOW best AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id)
        QUALIFY row_number() OVER best <= 3""",
)
def hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label)
