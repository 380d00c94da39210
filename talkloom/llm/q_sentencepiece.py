"""Query op1_sentencepiece."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from talkloom.llm import sentencepiece


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and the text they decode to. Tests compare with a search over whole texts."""
    return sentencepiece.round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op1_sentencepiece": (op1_sentencepiece, None)}
