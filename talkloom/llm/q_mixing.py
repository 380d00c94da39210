"""Query op10_mixing and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkloom.llm import mixing


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mixture takes of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    taken = mixing.mix(docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size")))
    return taken.select("doc_id", "size", "source_size", "target", "taken")


#: Every quotient of every source and shard is listed and ranked here.
OP10_SQL = f"""
WITH sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents
), sources AS (
  SELECT source, sum(size)::DOUBLE AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS i FROM sizes GROUP BY source
), weighed AS (
  SELECT *, [5.0, 2.0, 1.0][((i - 1) % 3 + 1)::INT]::DOUBLE AS w, source_size * 2.0 AS cap, source_size * 2.0 / w AS ratio FROM sources
), ranked AS (
  SELECT *, coalesce(sum(cap) OVER before, 0.0) AS stopped, sum(w) OVER () - coalesce(sum(w) OVER before, 0.0) AS rest, sum(source_size) OVER () * 1.5 AS budget
  FROM weighed WINDOW before AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), levels AS (
  SELECT *, max(CASE WHEN (budget - stopped) / rest <= ratio THEN (budget - stopped) / rest END) OVER () AS level FROM ranked
), targets AS (
  SELECT source, source_size, least(cap, coalesce(level * w, cap)) AS target, ceil(source_size / {mixing.SHARD_WORDS})::BIGINT AS shards FROM levels
), seats AS (
  SELECT *, floor(sum(target) OVER () / {mixing.BLOCK_WORDS} + 0.5)::BIGINT AS blocks FROM targets
), source_quotients AS (
  SELECT source, blocks, k, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, source NULLS LAST, k) AS rank
  FROM (SELECT *, unnest(range(0, (target / {mixing.BLOCK_WORDS})::BIGINT + 20)) AS k FROM seats WHERE target > 0)
), source_quota AS (
  SELECT source, count(*) AS quota FROM source_quotients WHERE rank <= blocks GROUP BY source
), placed AS (
  SELECT d.*, t.source_size, t.target, coalesce(q.quota, 0) AS seats, ('0x' || substr(md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS spot,
    CASE WHEN shards > 1 THEN spot % shards ELSE 0 END AS shard
  FROM sizes d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN source_quota q ON d.source IS NOT DISTINCT FROM q.source
), cells AS (
  SELECT source, shard, sum(size)::DOUBLE AS votes, first(seats) AS seats FROM placed GROUP BY source, shard
), cell_quotients AS (
  SELECT source, shard, seats, row_number() OVER (PARTITION BY source ORDER BY votes / (2 * k + 1) DESC, shard, k) AS rank
  FROM (SELECT *, unnest(range(0, seats + 1)) AS k FROM cells WHERE votes > 0)
), cell_quota AS (
  SELECT source, shard, count(*) AS quota FROM cell_quotients WHERE rank <= seats GROUP BY source, shard
), streams AS (
  SELECT p.*, coalesce(q.quota, 0) AS quota, greatest(ceil(c.votes / {mixing.BLOCK_WORDS}), 1)::BIGINT AS n,
    sum(size) OVER (PARTITION BY p.source, p.shard ORDER BY spot, doc_id, size ROWS UNBOUNDED PRECEDING)::BIGINT AS stop
  FROM placed p JOIN cells c ON p.source IS NOT DISTINCT FROM c.source AND p.shard = c.shard
  LEFT JOIN cell_quota q ON p.source IS NOT DISTINCT FROM q.source AND p.shard = q.shard
), turned AS (
  SELECT *, quota // n AS full_passes, quota % n AS more,
    ('0x' || substr(md5('{mixing.SEED}:' || coalesce(source, '') || ':' || shard::VARCHAR), 1, 15))::BIGINT % n AS turn FROM streams
), edges AS (
  SELECT *, unnest([stop - size, stop]) AS edge, unnest([-1, 1]) AS sign FROM turned
), parts AS (
  SELECT *, (floor((b + turn) * more / n) - floor(turn * more / n)) * {mixing.BLOCK_WORDS}
    + (floor((b + 1 + turn) * more / n) - floor((b + turn) * more / n)) * (edge - b * {mixing.BLOCK_WORDS}) AS covered
  FROM (SELECT *, edge // {mixing.BLOCK_WORDS} AS b FROM edges)
)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
  (CASE WHEN size > 0 THEN full_passes * size + sum(sign * covered) ELSE 0 END)::BIGINT AS taken
FROM parts GROUP BY doc_id, size, source_size, target, full_passes
"""

QUERIES = {"op10_mixing": (op10_mixing, OP10_SQL)}
