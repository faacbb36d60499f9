"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm import (
    centroids, content_sort, decontaminate, line_dedup, merkle, minhash, mixing, pii, quality_rules, secret_scan, token_counts, token_output, toxicity,
)
from martloom.llm.common import table


def tokenizer_path() -> str:
    """The public vocabulary file that the token queries use; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_contextual_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest_columns(pii.extract(table(spark, sf_dir, "documents")))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontaminate.find_overlaps(docs, benchmark, keep=("doc_id",))
    return decontaminate.digest_columns(found)


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    mixed = mixing.replicate(docs, mixing.temperature_rates(docs))
    return mixed.select("row.doc_id", "row.source", "n_copies", "copy_no", "shuffle_key")


def op4_distribution_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"), keep=("doc_id",))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select(F.col("row.doc_id").alias("doc_id"), *counts, "base_failed", "kept")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.digest_columns(toxicity.score(docs, labels, keep=("doc_id",)))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = minhash.near_duplicates(table(spark, sf_dir, "documents"))
    return classes.select(F.col("id").alias("doc_id"), "class_id")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest_columns(secret_scan.find_secrets(table(spark, sf_dir, "documents"), keep=("doc_id",)))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path(), keep=("doc_id",))
    return counted.select(F.col("row.doc_id").alias("doc_id"), "n_bytes", "n_tokens", "over_limit")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.encode_and_read(table(spark, sf_dir, "documents"), tokenizer_path())


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.digest_columns(line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs)))


def op11_shallot_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return centroids.digest_columns(centroids.cluster(vectors, dimensions=64, k=8, rounds=10, seed=3))


def op12_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort.digest_columns(content_sort.exact_duplicates(table(spark, sf_dir, "documents")))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # Where 7 divides the id's checksum, a proof is tried on a row with one character more than it had.
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    longer = F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    return merkle.digest_columns(merkle.manifest(docs, changed={"n_chars": longer}))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_contextual_pii": op1_contextual_pii,
    "op2_decontaminate": op2_decontaminate,
    "op3_mix_sources": op3_mix_sources,
    "op4_distribution_rules": op4_distribution_rules,
    "op5_secret_scan": op5_secret_scan,
    "op6_token_counts": op6_token_counts,
    "op7_toxicity": op7_toxicity,
    "op8_minhash": op8_minhash,
    "op9_token_files": op9_token_files,
    "op10_line_dedup": op10_line_dedup,
    "op11_shallot_clusters": op11_shallot_clusters,
    "op12_content_sort": op12_content_sort,
    "op13_merkle_manifest": op13_merkle_manifest,
}
