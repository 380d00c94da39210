"""Query op3_passages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from talkloom.llm import passages


def op3_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document keeps when passages of earlier documents are removed. Tests compare with a plain search."""
    kept = passages.removed(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


QUERIES = {"op3_passages": (op3_passages, None)}
