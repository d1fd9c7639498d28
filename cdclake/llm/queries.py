"""One query per operator over its whole table, with its SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cdclake.llm import bpe, cluster, embed, html_text, jaccard, media, pack, quality, substring, token_counts, toxicity, trie, warc


def vocabulary_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark, sf_dir):
    return pack.pack(_table(spark, sf_dir, "documents"), vocabulary_file("word_bpe_49k.json"))


def op2_token_counts(spark, sf_dir):
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), vocabulary_file("byte_bpe_50k.json"))


def op3_html_extraction(spark, sf_dir):
    return html_text.extract(_table(spark, sf_dir, "pages"))


def op4_toxicity(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return toxicity.scored(docs, docs, _table(spark, sf_dir, "labels"))


def op5_byte_pairs(spark, sf_dir):
    return bpe.round_trip(_table(spark, sf_dir, "documents"), vocabulary_file("byte_bpe_50k.json"))


def op6_quality_rules(spark, sf_dir):
    return quality.judge(_table(spark, sf_dir, "documents"))


def op7_media_columns(spark, sf_dir):
    return media.digest(_table(spark, sf_dir, "documents"))


def op8_warc(spark, sf_dir):
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op9_substring_dedup(spark, sf_dir):
    return substring.digest(_table(spark, sf_dir, "documents"))


def op10_ngram_jaccard(spark, sf_dir):
    return jaccard.join(_table(spark, sf_dir, "documents"))


def op11_embedding_near_dedup(spark, sf_dir):
    return embed.link(_table(spark, sf_dir, "embeddings"))


def op12_prefix_trie(spark, sf_dir):
    return trie.trie(_table(spark, sf_dir, "conversations"))


def op13_centroid_clustering(spark, sf_dir):
    return cluster.cluster(_table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_best_fit_packing, op2_token_counts, op3_html_extraction, op4_toxicity, op5_byte_pairs,
    op6_quality_rules, op7_media_columns, op8_warc, op9_substring_dedup, op10_ngram_jaccard, op11_embedding_near_dedup,
    op12_prefix_trie, op13_centroid_clustering)}
ORACLES: dict[str, str] = {
    "op6_quality_rules": quality.ORACLE, "op11_embedding_near_dedup": embed.ORACLE, "op12_prefix_trie": trie.ORACLE, "op13_centroid_clustering": cluster.oracle()}
