"""A corpus pipeline of five stages, each an operator of ``kerbside.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from kerbside.llm import ngram_join, packing, quality, secrets, substrings
from kerbside.llm.queries import table, vocabulary
from kerbside.sources.scratch import cleared, scratch_path


def _measured(docs: DataFrame) -> DataFrame:
    """n_chars follows the text."""
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules."""
    return quality.accepted(docs)


def ngram_join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest doc_id."""
    return ngram_join.representatives(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words of passages that an earlier document has."""
    return _measured(substrings.shortened(docs))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their text replaced; n_chars follows the text."""
    return _measured(secrets.redacted(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 4096 tokens."""
    return packing.pack(docs, vocabulary("word_bpe_49k.json"), end_id=2, marks=True)


STAGES = [("quality rules", quality_rules), ("n-gram join", ngram_join_stage),
          ("substring dedup", substring_dedup), ("secret scan", secret_scan), ("packing", pack)]

#: Tokenizers have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other; what a stage wrote on its way goes when it ends."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-"))
        with cleared(spark):
            found = stage(spark, docs, sf_dir)
            found.write.parquet(path)
        docs = spark.read.schema(found.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
