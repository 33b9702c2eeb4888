"""Registered queries of the corpus operators over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import collocations, cover_tree, decontamination, divergence, extendible, kneser_ney, ngram_join, pieces, sanitise, token_blocks, token_counts, toxicity, url_templates

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_greedy_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_noisy_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op3_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_templates.judge(table(spark, sf_dir, "pages"))


def op4_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return kneser_ney.score(docs, kneser_ney.train(docs))


def op5_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (extendible.assign_shards(table(spark, sf_dir, "documents").select("doc_id", "text"))
            .select("doc_id", "n_bytes", "shard", "depth", "shard_bytes", "shard_docs", "fits"))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op7_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_blocks.token_digests(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.piece_digests(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op9_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_vectors(table(spark, sf_dir, "embeddings"))


def op10_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sanitise.personal_data_digest(table(spark, sf_dir, "documents"))


def op11_stripes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_prefix_iceberg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


def op13_two_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_greedy_tiling, op2_noisy_channel, op3_url_templates, op4_kneser_ney, op5_extendible_shards, op6_ngram_jaccard, op7_token_blocks, op8_sentencepiece,
                                                   op9_cover_tree, op10_disclosure, op11_stripes, op12_prefix_iceberg, op13_two_tier)}
ORACLES: dict[str, str] = {"op3_url_templates": url_templates.PAGES_SQL, "op5_extendible_shards": extendible.SHARDS_SQL,
                           "op9_cover_tree": cover_tree.VECTORS_SQL, "op11_stripes": collocations.PHRASES_SQL, "op12_prefix_iceberg": divergence.DIVERGENCE_SQL}
