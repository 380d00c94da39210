"""A corpus pipeline: toxicity, line dedup, SimHash near-dedup, mixture, pieces. Each stage is written and read again before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from talkloom.llm import lines, mixing, sentencepiece, simhash, toxicity
from talkloom.llm.tables import written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5, as they are."""
    return toxicity.clean_documents(docs, toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the recurring lines of earlier ones; n_chars follows the text."""
    return lines.dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash links (four-word shingles, fingerprints at most 4 bits apart), that of the smallest doc_id."""
    return simhash.representatives(docs, simhash.WORDS, simhash.BITS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, as often as the mixture takes them."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_ids, decoded."""
    return sentencepiece.round_trip(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_lines),
    ("near-dedup", drop_near_copies),
    ("mixture", mix_sources),
    ("pieces", encode),
]

#: No stage but the mixture can be said in SQL; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
