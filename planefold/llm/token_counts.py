"""Token counts of documents through a cache keyed by content and tokenizer.

The cache is a Parquet table of (tokenizer version digest, content digest, count).
Contents are reduced to one row per SHA-256 digest, those without a stored count are
encoded and appended, and every document takes its count from the cache by digest.
NULL normalises to the empty text; nothing else may be normalised away, since ids
depend on every byte.

Copies, however many, are reduced to one text per task before the shuffle and are
encoded once; the join back moves digests, not texts.

Results for the odd cases: NULL and empty text have 0 bytes and 0 tokens; rows that
repeat an id or a text each get a row; an empty table gives an empty result; further
columns are ignored. A cache that was appended to twice (two jobs at once) still
gives one count per document.
"""

from __future__ import annotations

from collections.abc import Iterator
from uuid import uuid4

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planefold.llm.encode import encoder, version_digest
from planefold.llm.ship import ready
from planefold.llm.words import pieces
from planefold.session import settle, shared_folder

CACHE = "version string, digest binary, n_tokens long"
LIMIT = 512


def fresh_cache(spark: SparkSession) -> str:
    """Path for a new, empty cache in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/token-counts-{uuid4().hex}"


def _stored(spark: SparkSession, cache: str) -> DataFrame:
    try:
        return spark.read.schema(CACHE).parquet(cache)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CACHE)


def _counts(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).batch
        for batch in pieces(batches):
            counts = [len(ids) // 4 for ids in encode(batch.column("text"))]
            yield pa.RecordBatch.from_pydict({"digest": batch.column("digest"), "n_tokens": pa.array(counts, pa.int64())})

    return run


def token_counts(docs: DataFrame, tokenizer: str, cache: str) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` for every row of ``doc_id, text``; ``cache`` grows by what was missing."""
    spark = docs.sparkSession
    ready(spark)
    version = version_digest(tokenizer)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("text", 256)))
    stored = _stored(spark, cache).filter(F.col("version") == version)
    distinct = rows.groupBy("digest").agg(F.first("text").alias("text"))
    missing = distinct.join(stored, "digest", "left_anti").mapInArrow(_counts(tokenizer), "digest binary, n_tokens long")
    missing.select(F.lit(version).alias("version"), "digest", "n_tokens").write.mode("append").parquet(cache)
    # a written table: adaptive execution splits a frequent digest only if no aggregate stands between join and shuffle
    known = settle(_stored(spark, cache).filter(F.col("version") == version).groupBy("digest").agg(F.first("n_tokens").alias("n_tokens")))
    sizes = rows.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes"))
    return sizes.join(known, "digest", "left").select("doc_id", "n_bytes", "n_tokens")
