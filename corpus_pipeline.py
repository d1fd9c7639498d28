"""From raw documents to packed sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cdclake.llm import common, jaccard, pack, quality, substring, toxicity
from cdclake.llm.queries import vocabulary_file

#: Near copies in the pipeline: five words, similarity 0.8 or more.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't predict toxic; it learns from the labelled ones among them."""
    return toxicity.clean(docs, toxicity.learnt(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the fixed rules and the limits of their language and source."""
    return quality.passing(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of similar ones."""
    return jaccard.one_per_group(docs, gram=NEAR_WORDS, percent=NEAR_PERCENT)


def shared_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; words of passages that an earlier document has are taken out."""
    return substring.rewritten(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document, with its place in a sequence."""
    return pack.pack(docs, vocabulary_file("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_copies),
    ("substring dedup", shared_passages),
    ("best-fit packing", packing),
]

#: Tokenizers and classifiers have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = common.written(stage(spark, docs, sf_dir), common.scratch(spark))
    return docs


QUERIES = {"pipeline": run}
ORACLES = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
