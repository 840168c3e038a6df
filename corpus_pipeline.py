"""A corpus pipeline of five stages: language ID, line dedup, near-duplicate join, decontamination, BPE.

Every stage works on all that the one before kept; each result is written as Parquet to the shared folder and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, jaccard_join, language, line_dedup
from tidemark.llm._tables import stored

#: A document stays if its language is known with this score: about the level of chance among four languages goes.
MIN_SCORE = 0.35


def _counted(docs: DataFrame) -> DataFrame:
    """n_chars, where there is such a column, of the text as it is now."""
    return docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or whose language isn't known, go."""
    return language.keep(docs, language.learn(docs), MIN_SCORE)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal and nearly equal lines the first one stays; a document that loses all its lines goes."""
    return _counted(line_dedup.clean(docs, percent=80))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked at five-word similarity 0.8 the one with the least id stays."""
    return jaccard_join.keep_one(docs, n=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages go; so do documents of which they are more than half."""
    return _counted(decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), n=10, max_share=0.5))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text that is left, with digests of them and of the decoded text."""
    return bpe.digest(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=True)


STAGES = [("language_id", language_id), ("line_dedup", lines), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("bpe", encoding)]

#: Models, MinHash and encodings aren't expressible in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}", after=(docs,))  # a stage's input is needed no more
    return docs
