"""From raw documents to token files: five stages, each written and read again.

Every stage gets all that the one before it kept. The first four return the columns of
``documents``, the last one row per encoded document. Rows with NULL in any column
go through all stages: a NULL text has no language and is rejected in the first; a
NULL source is a source; rows without id are never copies of each other.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planefold.llm import jaccard, language, mixing, token_files, wu_manber
from planefold.session import settle

TOKENIZER = "byte_bpe_50k.json"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out what has no letter or is like no language of the table."""
    return language.keep_known(docs, language.train_model(docs))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of similar ones, the one with the smallest id."""
    return jaccard.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out documents with a passage of the benchmark."""
    return wu_manber.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take each document as often as its source's target asks for."""
    return mixing.mixed(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write token files and list what they hold: ``doc_id, start, n_tokens, ids_crc32``."""
    path = token_files.fresh_folder(spark)
    token_files.write_tokens(docs, public_tokenizers.path(TOKENIZER), path)
    return token_files.read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


STAGES = [
    ("language ID", language_id),
    ("n-gram Jaccard join", jaccard_join),
    ("benchmark decontamination", decontamination),
    ("source mixing", source_mixing),
    ("token files", token_output),
]

#: Language models, knapsack fits and tokenizers are beyond SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir))
    return docs
