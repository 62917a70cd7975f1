"""A training corpus from the documents table: five stages, each on what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalloom.llm import decontaminate, exact_dedup, language_id, mixing, ngram_join
from signalloom.session import stored


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; the model learns from rows with a language, of two folds of three."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    model = language_id.train(docs.where(F.coalesce(fold != 1, F.lit(True))))
    return language_id.confident(docs, model, least=0.5)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest identifier."""
    return exact_dedup.deduplicated(docs, keep="largest")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 5-word shingles at 0.75 or more, the one with the least identifier."""
    return ngram_join.one_of_each(docs, n=5, percent=75)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix of sources takes: a row for each stretch of a document, its text cut to it."""
    return mixing.mixed_documents(docs).withColumn("n_chars", F.length("text").cast("long"))


STAGES = [
    ("language_id", identify),
    ("exact_dedup", drop_copies),
    ("ngram_join", drop_near_copies),
    ("decontamination", decontaminated),
    ("mixing", mixed),
]

#: Language models can't be trained in SQL; the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
