"""The queries over the test tables, one per operator, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tenorline.llm import (
    fingerprints, itq_neighbours, language_id, merkle_manifest, minhash_dedup, mixing, packing, phrase_mining, sanitise, secret_scan, site_quality,
    substring_dedup, url_filter,
)
from tenorline.llm.labelled_urls import LABELLED


def vocabulary() -> str:
    """The file of the public vocabulary that the queries count tokens with."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op3_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sanitise.digest(sanitise.find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op4_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(packing.token_counts(docs, vocabulary()))


def op5_itq_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itq_neighbours.near_vectors(table(spark, sf_dir, "embeddings"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labelled = secret_scan.labelled_samples(docs)
    model = secret_scan.train(labelled)
    return secret_scan.digest(secret_scan.scan(docs, model, threshold=secret_scan.thresholds(labelled, model)))


def op7_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return site_quality.judge(docs, site_quality.train(docs, table(spark, sf_dir, "labels")))


def held_out() -> Column:
    """Whether the contract keeps a document (by doc_id) out of training."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs.filter(~held_out()), "doc_id", "text", "lang")
    return (language_id.identify_language(docs.select("doc_id", "text"), model)
            .select("doc_id", held_out().alias("held_out"), "lang_pred", "score"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = spark.createDataFrame(LABELLED, "url string, verdict string")
    return url_filter.judge(table(spark, sf_dir, "pages"), url_filter.train(labelled))


def op10_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.poisson_mix(docs, mixing.repetition_rates(docs))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_mining.collocations(table(spark, sf_dir, "documents"))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest, and every proof folded from a leaf that a fifth of the texts no longer match."""
    docs = table(spark, sf_dir, "documents")
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    lowered = F.translate("text", ascii_uppercase, ascii_lowercase)
    text = F.when(tampered, lowered).otherwise(F.col("text"))
    claimed = merkle_manifest.leaf_digest([F.col(c) for c in columns[:-1]] + [text])
    return merkle_manifest.verified(merkle_manifest.manifest(docs, columns, "source", "doc_id", claimed))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_dedup": op1_minhash_dedup,
    "op2_fingerprints": op2_fingerprints,
    "op3_disclosure": op3_disclosure,
    "op4_length_buckets": op4_length_buckets,
    "op5_itq_neighbours": op5_itq_neighbours,
    "op6_secret_scan": op6_secret_scan,
    "op7_site_quality": op7_site_quality,
    "op8_language_id": op8_language_id,
    "op9_url_filter": op9_url_filter,
    "op10_poisson_mix": op10_poisson_mix,
    "op11_collocations": op11_collocations,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLES: dict[str, str] = {
    "op1_minhash_dedup": minhash_dedup.ORACLE,
    "op5_itq_neighbours": itq_neighbours.ORACLE,
    "op10_poisson_mix": mixing.ORACLE,
    "op11_collocations": phrase_mining.ORACLE,
    "op12_substring_dedup": substring_dedup.ORACLE,
    "op13_merkle_manifest": merkle_manifest.ORACLE,
}
