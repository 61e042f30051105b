"""From raw documents to balanced shards of a clean, mixed corpus: five stages over all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm import decontaminate, language_id, mixing, near_dedup, sharding
from vitrine.llm.common import discard, fold, materialize, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that no language claims."""
    return language_id.accepted(docs, language_id.train(docs, fold(F.col("doc_id"), 4) != 2))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group whose five-word shingles are 0.8 alike or more."""
    return near_dedup.deduplicated(docs, words=5, percent=80)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold an item of the benchmark, re-parameterised ones included."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes the sources to their target weights; a document is there as often as it is taken."""
    return mixing.mixed(docs)


def make_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, each with a shard and a slot; equal texts stay together."""
    return sharding.shard(docs, 8, keep=docs.columns)


STAGES = [
    ("language ID", identify_language),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", decontaminate_benchmark),
    ("mixing sources to target weights", mix_sources),
    ("sharding", make_shards),
]

#: Learned models, components and differencing are beyond SQL; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        done, docs = docs, materialize(stage(spark, docs, sf_dir), f"stage{i + 1}")
        discard(done)
    return docs
