"""A training-data pipeline: each stage reads what its predecessor kept.

Language identification rejects texts without a language; line dedup takes out
lines that a large share of a source's documents repeat; near-dedup keeps one
document of each group; decontamination drops documents that hold a passage of
the benchmark; mixing picks documents by source and quality. All stages but the
last return the columns of documents; the last returns a row per document that
the mix takes, and how often.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.llm import decontam, langid, linededup, mixing, simhash
from sievewright.llm._shared import written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language; texts without a letter and texts that fit no language better than others go."""
    return langid.accept(docs, langid.fit_on_folds(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that over a tenth of their source's documents hold."""
    cleaned = linededup.drop_boilerplate(docs)
    return cleaned.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts with a similarity of 0.8 or more on five-word shingles."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a ten-word window of a benchmark item."""
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes: doc_id, source, size, source_size, target, epochs and taken (words, repeats counted)."""
    return mixing.mix(docs).where(F.col("taken") > 0)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing_sources", mixing_sources),
]

#: Language identification and SimHash can't be said in SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
