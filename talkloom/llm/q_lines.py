"""Query op5_lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkloom.llm import lines


def op5_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document after line dedup: how many lines and characters are left, and their text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    kept = lines.dedup(docs)
    return kept.select("doc_id", F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1)).cast("long").alias("n_lines"), F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars_left"), "text")


QUERIES = {"op5_lines": (op5_lines, None)}
