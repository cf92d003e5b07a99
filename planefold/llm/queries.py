"""One query per operator, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from planefold.llm import html_text, pii
from planefold.llm.align import alignment
from planefold.llm.bottomk import edited_pairs, fingerprint, resemblance
from planefold.llm.jaccard import similar_groups
from planefold.llm.language import identify, train_model
from planefold.llm.merkle import folded, leaf_digest, manifest, proof_digest
from planefold.llm.mixing import mix_sources
from planefold.llm.substring import remove_repeated
from planefold.llm.token_counts import LIMIT, fresh_cache, token_counts
from planefold.llm.token_files import fresh_folder, read_tokens, write_tokens
from planefold.llm.toxicity import THRESHOLD, score_toxicity, train
from planefold.llm.wu_manber import benchmark_hits, contamination

TOKENIZER = "byte_bpe_50k.json"
OTHER_TOKENIZER = "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeated(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_groups(_table(spark, sf_dir, "documents"))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = benchmark_hits(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return contamination(found).select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), fresh_cache(spark))
    return counts.withColumn("over_limit", F.col("n_tokens") > LIMIT)


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_folder(spark)
    write_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), path)
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = edited_pairs(_table(spark, sf_dir, "documents"))
    return pairs.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("sketch")).alias("fingerprint"),
        fingerprint(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )


def _fold(n: int):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % n, F.lit(0).cast("long"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = identify(docs, train_model(docs.filter(_fold(3) != 1)))
    return found.select("doc_id", (_fold(3) == 1).alias("held_out"), "lang_pred", "score", "rejected")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    network = train(docs, _table(spark, sf_dir, "labels").filter(_fold(4) != 2))
    scored = score_toxicity(docs, network)
    return scored.select("doc_id", (_fold(4) == 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    text = html_text.extract(pages, html_text.train(pages))
    return text.withColumn("n_chars", F.length("text").cast("long"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    text = F.col("text")
    tampered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    own, other = ([F.col(c) for c in ("doc_id", "source", "lang", "n_chars")] + [t] for t in (text, tampered))
    leaves = docs.select("doc_id", "source", leaf_digest(*own).alias("leaf"), F.when(_fold(5) == 0, leaf_digest(*other)).alias("claimed"))
    # a document without id is in no fold
    leaves = leaves.withColumn("claimed", F.when(F.col("doc_id").isNotNull(), F.col("claimed")))
    found = manifest(leaves)
    found = found.withColumn("folded_root", folded(F.coalesce("claimed", "leaf"), F.col("path")))
    return found.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path(TOKENIZER), public_tokenizers.path(OTHER_TOKENIZER)
    return alignment(_table(spark, sf_dir, "documents"), *paths, digest=True).withColumnRenamed("groups", "groups_sha256")


def _written(spans: Column) -> Column:
    """``kind:start:end`` of spans by kind and start, comma-joined."""
    names = F.array(*[F.lit(name) for name in pii.KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["stop"])), ",")


def _of_kind(spans: Column, kind: int) -> Column:
    """Number of spans of a kind."""
    # Spark passes the index to a function's second parameter, also to one with a default
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = pii.find_pii(docs, pii.train(docs))
    counts = [_of_kind(F.col("base"), k).alias(f"n_{name}") for k, name in enumerate(pii.KINDS)]
    base, spans = _written(F.col("base")), _written(F.concat("base", "added"))
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), spans.alias("spans"), F.size("added").cast("long").alias("n_added"))


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_language_id": op2_language_id,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_source_mixing": op4_source_mixing,
    "op5_token_files": op5_token_files,
    "op6_token_counts": op6_token_counts,
    "op7_document_fingerprints": op7_document_fingerprints,
    "op8_html_extraction": op8_html_extraction,
    "op9_toxicity": op9_toxicity,
    "op10_ngram_jaccard_join": op10_ngram_jaccard_join,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_cross_tokenizer_alignment": op12_cross_tokenizer_alignment,
    "op13_pii": op13_pii,
}
