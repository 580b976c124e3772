"""From raw documents to shards of training text, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.llm import decontaminate, mixing, sharding, simhash, toxicity
from driftline.llm.common import read
from driftline.session import stored

# No stage's learned or hashed decisions can be stated in SQL; the tests hold them against plain versions.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more by what the labels teach go.

    Null and empty texts are scored as texts without words; rows with a null id have no label. Repeated rows go or stay
    together. An empty table gives no rows; without labels nothing goes.
    """
    labels = read(spark, sf_dir, "labels").select("doc_id", "toxic")
    known = docs.select("doc_id", "text").join(labels, "doc_id").select("text", "toxic")
    return toxicity.without_toxic(docs, toxicity.learn(known))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 on shingles of five words, the one with the smallest id stays.

    Null texts count as empty, and texts without words are copies of each other; null ids come last. Of rows
    equal in id and text one stays. An empty table gives no rows.
    """
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go.

    Null and empty texts hold none and stay, as do all if the benchmark is empty. Repeated rows go or stay together.
    """
    return decontaminate.without_passages(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks for, in the order of training.

    A null source is a source of its own; documents without words take no share and do not come out. Repeated rows are
    documents of their own. An empty table gives no rows.
    """
    mixed = mixing.by_position(mixing.mix(docs, keep=docs.columns))
    return mixed.select(*[F.col(f"_keep_{i}").alias(c) for i, c in enumerate(docs.columns)])


def make_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the shard and slot they go to.

    Null texts have no bytes but a row's own; null ids and repeated rows are rows like any other. An empty table gives no rows.
    """
    return sharding.shard(docs, 40)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", make_shards),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each stage's rows written and read again by the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
