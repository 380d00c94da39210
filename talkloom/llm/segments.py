"""Exact top-k inner products by multi-resolution segment statistics.

A vector is cut into 2, then 4, 8, ... segments, of which means and deviations are kept. Of two vectors the inner product is at most
the sum over segments of size * (mean * mean + deviation * deviation), as centred parts obey Cauchy-Schwarz; with
|q - x|^2 = |q|^2 + |x|^2 - 2 q x that is the lower bound of the distance from segment statistics. Bounds are taken coarse to fine, at each level
only for candidates that may still reach the k-th best exact score found so far, and survivors are scored exactly in 64-bit integers.

Vectors are dealt into shards and queries into blocks; every pair of shard and block is one task's work, and returns k rows a query,
which are merged. The shards are bounded in rows, so is the memory of a task.

Components are floor(scale * x), x as double. Vectors that are null or hold null or non-finite components take no part; a zero vector
does. Vectors of unequal length count as filled up with zeros. Scores must fit a long. Rows of one vec_id are candidates each; a query's
own vec_id is never a candidate. Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkloom.llm import vectors
from talkloom.llm.tables import shipped

SCALE = 256
K = 5
#: Rows of a shard of candidates, and of a block of queries.
SHARD_ROWS, BLOCK_ROWS = 4096, 1024
LEVELS = (2, 4, 8, 16)


def statistics(x: np.ndarray, parts: int) -> np.ndarray:
    """sqrt(size) * mean and sqrt(size) * deviation of each of about equal segments; inner products of these rows are the bounds."""
    cuts = np.linspace(0, x.shape[1], parts + 1).astype(int)
    out = []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        part, root = x[:, a:b], np.sqrt(b - a)
        out += [part.mean(axis=1) * root, part.std(axis=1) * root] if b > a else []
    return np.stack(out, axis=1) if out else np.zeros((len(x), 0))


def top(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query position, row position and score of the k best rows of each query. queries and rows are integers; rows come by id."""
    width = max(queries.shape[1], rows.shape[1])
    queries, rows = vectors.widened(queries, width), vectors.widened(rows, width)
    fq, fx = queries.astype(np.float64), rows.astype(np.float64)
    slack = 1e-9 * (np.linalg.norm(fq, axis=1).max(initial=0) * np.linalg.norm(fx, axis=1).max(initial=0)) + 1e-6
    levels = [p for p in LEVELS if p < width] or [1]
    of_q, of_x = ([statistics(a, p) for p in levels] for a in (fq, fx))
    coarse = of_q[0] @ of_x[0].T + slack
    coarse[query_ids[:, None] == ids[None, :]] = -np.inf
    out = []
    for i in range(len(queries)):
        bound, alive = coarse[i], np.arange(len(rows))
        alive = alive[bound > -np.inf]
        first = alive[np.argpartition(-bound[alive], min(4 * k, len(alive)) - 1)[: 4 * k]] if len(alive) > 4 * k else alive
        known = np.sort(rows[first] @ queries[i])
        floor = known[-k] if len(known) >= k else -np.inf
        alive = alive[bound[alive] >= floor]
        for level in range(1, len(levels)):
            if len(alive) <= 8 * k:
                break
            finer = of_x[level][alive] @ of_q[level][i] + slack
            alive = alive[finer >= floor]
        score = rows[alive] @ queries[i]
        order = np.lexsort((alive, -score))[:k]
        out.append((np.full(len(order), i), alive[order], score[order]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, int), np.zeros(0, int), np.zeros(0, np.int64))


def search(table: DataFrame, is_query: Column, k: int = K, scale: int = SCALE, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score for the rows of which is_query holds, against all others."""
    rows = vectors.usable(table, zero=True)
    counts = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(is_query).alias("q")).first()
    n_shards, n_blocks = max(1, -(-counts["n"] // shard_rows)), max(1, -(-counts["q"] // block_rows))
    deal = F.xxhash64("vec_id")
    shard = rows.withColumn("shard", F.pmod(deal, F.lit(n_shards))).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))))
    block = rows.filter(is_query).withColumn("block", F.pmod(deal, F.lit(n_blocks))).withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_shards - 1).cast("long"))))

    def whole(column: pa.ChunkedArray) -> np.ndarray:
        return np.floor(scale * vectors.matrix(column)).astype(np.int64)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = (np.zeros(0, np.int64),) * 3
        if len(left) and len(right):
            left = left.sort_by("vec_id")
            ids, query_ids = left.column("vec_id").to_numpy(), right.column("vec_id").to_numpy()
            q, x, score = top(whole(right.column("embedding")), query_ids, whole(left.column("embedding")), ids, k)
            found = query_ids[q], ids[x], score
        return pa.table(dict(zip(("query_id", "vec_id", "score"), (pa.array(f, pa.int64()) for f in found), strict=True)))

    keys = ["shard", "block"]
    pairs = shipped(shard).groupBy(*keys).cogroup(block.groupBy(*keys)).applyInArrow(run, "query_id long, vec_id long, score long")
    return vectors.best(pairs, k)
