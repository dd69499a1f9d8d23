"""From raw documents to batches: language, near duplicates, secrets, mixing, packing.

Each stage takes all rows its predecessor kept and returns the columns of documents; the
last returns the packing plan, one row per copy of a document.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from tenorline.llm import language_id, minhash_dedup, mixing, packing, secret_scan
from tenorline.llm.queries import held_out, vocabulary
from tenorline.llm.shared import written

#: Texts whose best language scores less resemble no learned language.
LEAST_SCORE = 0.05
#: Columns of documents that stages read; all others pass through them under other names.
OWN = ("doc_id", "text", "lang", "source", "n_chars")


def carrying(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """``stage`` for documents with further columns, whose names then clash with none that the stage makes."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        given = docs.toDF(*[c if c in OWN else f"_carried{k}" for k, c in enumerate(docs.columns)])
        return stage(spark, given, sf_dir).toDF(*docs.columns)

    return run


@carrying
def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts that are null, have no letter or resemble no learned language; fills in
    ``lang`` where it is null. Learns from the rows that op8 learns from."""
    model = language_id.train(docs.filter(~held_out()), "doc_id", "text", "lang")
    judged = language_id.identify_language(docs, model)
    known = judged.filter((F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= LEAST_SCORE))
    return known.withColumn("lang", F.coalesce("lang", "lang_pred")).select(docs.columns)


@carrying
def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each component of near duplicates, linked from a similarity of 0.8 on."""
    return minhash_dedup.keep_one(docs, minhash_dedup.near_duplicates(docs, percent=80))


@carrying
def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exchanges every secret for a mark and counts the characters anew; all documents stay."""
    labelled = secret_scan.labelled_samples(docs)
    model = secret_scan.train(labelled)
    clean = secret_scan.redact(secret_scan.scan(docs, model, threshold=secret_scan.thresholds(labelled, model)))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


@carrying
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or drops documents so that sources meet their weights, in shuffled order."""
    return mixing.poisson_mix(docs, mixing.repetition_rates(docs)).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Length buckets and batches for every row."""
    return packing.pack(packing.token_counts(docs, vocabulary()))


STAGES = [
    ("language_id", identify),
    ("minhash_dedup", deduplicate),
    ("secret_scan", redact_secrets),
    ("poisson_mix", mix),
    ("length_buckets", pack),
]

#: Language scores, signatures, Markov models and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
