"""The registered queries of the corpus operators: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from knownby.llm import (
    apportion_mix,
    cgk_decontaminate,
    fast_minhash,
    ftrl_quality,
    hash_tree_shards,
    html_style_tree,
    jacobi_davidson,
    line_frequency,
    secret_forest,
    semicrf_pii,
    spelling_variants,
    token_counts,
    voronoi_knn,
)
from knownby.llm.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


@_query
def op9_ftrl_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return ftrl_quality.classify(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))


@_query
def op3_fast_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fast_minhash.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"), length=4)


@_query
def op2_cgk_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return cgk_decontaminate.contaminated_windows(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


@_query
def op6_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return hash_tree_shards.assign(docs, hash_tree_shards.ShardTree.founded(24))


@_query
def op7_apportion_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "text")
    return apportion_mix.mix(docs).select("doc_id", "size", "source_size", "target", "taken", "source")


@_query
def op1_html_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_style_tree.main_text(table(spark, sf_dir, "pages", "page_id", "url", "html"))


@_query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return token_counts.token_counts(table(spark, sf_dir, "documents", "doc_id", "text"), path)


@_query
def op5_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_frequency.rate(table(spark, sf_dir, "documents", "doc_id", "source", "text"))


@_query
def op8_semicrf_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return semicrf_pii.find_personal_data(table(spark, sf_dir, "documents", "doc_id", "text"))


@_query
def op10_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_forest.find_secrets(table(spark, sf_dir, "documents", "doc_id", "text"))


@_query
def op11_jacobi_davidson(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jacobi_davidson.whiten(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


@_query
def op12_voronoi_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voronoi_knn.top_by_inner_product(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


@_query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.variants(table(spark, sf_dir, "documents", "doc_id", "text"))
