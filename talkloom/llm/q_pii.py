"""Query op6_pii. The base spans are also given as SQL for tests; the terms rest on digests that DuckDB lacks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkloom.llm import pii


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data, and of the terms that give it away, in every document."""
    found = pii.find(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    spans = pii.all_spans(F.col("base"), F.col("terms"))
    return found.select(
        "doc_id",
        *map(count, pii.PATTERNS),
        F.sha2(pii.spans_text(F.col("base")), 256).alias("base_sha256"),
        pii.spans_text(spans).alias("spans"),
        F.size("terms").cast("long").alias("n_term"),
        F.sha2(pii.sanitised(F.col("text"), F.col("base"), F.col("terms")), 256).alias("sanitised_sha256"),
    )


QUERIES = {"op6_pii": (op6_pii, None)}
