"""Queries op2_graph and op7_segments, and the SQL of the exact one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from talkloom.llm import graph, segments
from pyspark.sql import functions as F


def op2_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """20 nearest found of every vector whose id is divisible by 20. Tests measure recall against brute force."""
    return graph.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)


def op7_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """5 highest integer inner products of every vector whose id is divisible by 50."""
    return segments.search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)


OP7_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM pairs
) WHERE rank <= 5
"""

QUERIES = {"op2_graph": (op2_graph, None), "op7_segments": (op7_segments, OP7_SQL)}
