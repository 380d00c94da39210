"""Query op11_negatives and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkloom.llm import negatives


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negatives of every anchor (vec_id divisible by 100) and each of its positives; labels of every seventh vec_id are moved on by one."""
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mined(negatives.prepared(table, label), F.col("vec_id") % 100 == 0)


OP11_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT q.vec_id AS anchor_id, c.vec_id, q.label = c.label AS same,
    list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM (
  SELECT p.anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank
  FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT same
  WHERE 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
) WHERE rank <= 5
"""

QUERIES = {"op11_negatives": (op11_negatives, OP11_SQL)}
