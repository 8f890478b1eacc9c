"""From raw documents to sharded training data: five stages, each one operator of knownby.llm.

A stage takes the documents that its predecessor kept, in the columns of ``documents``, and returns
those that it keeps; the last one adds the shard and the slot of every row. Further columns of the input
are passed over. What each stage does with nulls, empty texts and repeated rows is said in its operator.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from knownby.llm import apportion_mix, cgk_decontaminate, fast_minhash, ftrl_quality, hash_tree_shards
from knownby.llm.tables import prepare, stored, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
SHARDS = 24


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return ftrl_quality.keep_good(docs.select(*COLUMNS), table(spark, sf_dir, "labels", "doc_id", "quality"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: five-word shingles, similarity 0.8."""
    prepare(spark)
    return fast_minhash.keep_one(docs.select(*COLUMNS))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return cgk_decontaminate.keep_clean(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark", "item_id", "text"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as the mix of their source takes them: never, once or twice."""
    prepare(spark)
    return apportion_mix.mixed_documents(docs.select(*COLUMNS))


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row gets its shard and its slot there."""
    prepare(spark)
    return hash_tree_shards.shard_documents(docs.select(*COLUMNS), hash_tree_shards.ShardTree.founded(SHARDS))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixture),
    ("sharding", sharding),
]

#: Not expressible in SQL: the first stage is a trained model. The tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents", *COLUMNS)
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
