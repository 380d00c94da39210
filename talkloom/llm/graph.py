"""Approximate nearest neighbours: a navigable small-world graph with levels for each shard, merged results.

Nearness is the largest inner product. A graph is built by distance, for which vectors get one more component, the root of what their squared
length lacks to the longest of the shard: with it, the largest inner product is the smallest distance. The component is kept as what it lacks
to that longest length, so that one long vector does not drown the others, and a shard is scaled to components up to one. Searches
compare inner products. Equal vectors are one node: their ids are kept, and only as many of the smallest as an answer can hold enter it.

A shard's graph is built in batches that double: the nodes of a batch search the graph of the nodes before, side by side, and are joined to
close and, among these, spread neighbours both ways; nodes of full lists keep the closest. Levels follow from a hash, each holding a share of
the one below. The graph is flat arrays, a row of neighbours for each node and level; it is written with its vectors, one row for
each shard, to the shared folder. A search walks down the levels and keeps the `breadth` best nodes on the lowest, for a block of queries
side by side. It also enters by the best of some doors, the longest vectors and ones from all over the shard, as walks may not lead
from one dense group to another. How broad a search must be depends on the vectors: every block first has some of its queries compared with
the whole shard, and doubles `breadth` until these get RECALL of their k nearest; doors grow alike, up to all nodes.
Every pair of shard and block returns k rows a query, scored in double precision on the original vectors, and all are merged.

Vectors that are null, zero or hold null or non-finite components take no part. Vectors of unequal length count as filled up with
zeros. A query's own vec_id is never an answer, and rows that come twice ask and answer once. Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkloom.llm import buffers, vectors
from talkloom.llm.tables import shipped, written

K = 20
#: Neighbours of a node on the lowest level (half of it above), nodes kept while a graph is built and while it is searched.
DEGREE, BUILD_BREADTH, BREADTH = 24, 64, 96
#: One of so many nodes of a level is on the next.
LEVEL_SHARE = 16
SHARD_ROWS, BLOCK_ROWS = 8192, 2048
_BATCH = 1024
#: Queries of a block that are compared with the whole shard, and the share of their nearest that a search must find.
SAMPLE, RECALL = 32, 0.97


def _walk(x: np.ndarray, norms: np.ndarray, links: np.ndarray, queries: np.ndarray, start: np.ndarray, breadth: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-first search for all queries side by side: nodes and norms less twice the inner product, least first, -1 where there are fewer.

    With squared lengths as norms that is the squared distance less |query|^2. A start of -1 is none. Broad searches take several nodes a step.
    """
    n = len(queries)
    breadth = max(breadth, start.shape[1])
    take = max(1, breadth // 96)
    nodes = np.full((n, breadth), -1, np.int64)
    apart = np.full((n, breadth), np.inf, np.float32)
    done = np.ones((n, breadth), bool)
    # the last column is for -1, which is no node
    seen = np.zeros((n, len(x) + 1), bool)
    seen[:, -1] = True
    every = np.arange(n)[:, None]
    s = start.shape[1]
    nodes[:, :s] = start
    apart[:, :s] = np.where(start < 0, np.inf, norms[start] - 2 * np.matmul(x[start], queries[:, :, None])[:, :, 0])
    done[:, :s] = start < 0
    seen[every, start] = True
    live = np.arange(n)
    while len(live):
        near = np.where(done[live], np.inf, apart[live])
        pick = near.argmin(axis=1)[:, None] if take == 1 else np.argpartition(near, take - 1, axis=1)[:, :take]
        some = np.isfinite(np.take_along_axis(near, pick, axis=1))
        going = some.any(axis=1)
        live, pick, some = live[going], pick[going], some[going]
        if not len(live):
            break
        row = np.arange(len(live))[:, None]
        done[live[:, None], pick] = True
        fresh = np.where(some[:, :, None], links[nodes[live[:, None], pick]], -1).reshape(len(live), -1)
        known = seen[live[:, None], fresh]
        # a neighbour that comes twice counts once
        fresh = np.where(known, -1, fresh)
        fresh.sort(axis=1)
        known = fresh < 0
        known[:, 1:] |= fresh[:, 1:] == fresh[:, :-1]
        seen[live[:, None], fresh] = True
        dist = norms[fresh] - 2 * np.matmul(x[fresh], queries[live][:, :, None])[:, :, 0]
        dist[known] = np.inf
        both = np.concatenate([apart[live], dist], axis=1)
        keep = np.argpartition(both, breadth - 1, axis=1)[:, :breadth]
        nodes[live] = np.concatenate([nodes[live], fresh], axis=1)[row, keep]
        apart[live] = both[row, keep]
        done[live] = np.concatenate([done[live], known], axis=1)[row, keep]
    order = np.argsort(apart, axis=1)
    nodes, apart = nodes[every, order], apart[every, order]
    nodes[~np.isfinite(apart)] = -1
    return nodes, apart


def _spread(x: np.ndarray, nodes: np.ndarray, apart: np.ndarray, norms: np.ndarray, own: np.ndarray, degree: int) -> np.ndarray:
    """Of each row's nodes, nearest first: those that are nearer to the row's own node than to any chosen before, then the nearest others."""
    n, c = nodes.shape
    gone = nodes < 0
    inner = np.matmul(x[nodes], x[nodes].transpose(0, 2, 1))
    between = norms[nodes][:, :, None] + norms[nodes][:, None, :] - 2 * inner
    mine = apart + norms[own][:, None]
    chosen = np.zeros((n, c), bool)
    for j in range(c):
        blocked = (chosen & (between[:, j, :] < mine[:, j, None])).any(axis=1)
        chosen[:, j] = ~blocked & ~gone[:, j] & (chosen.sum(axis=1) < degree)
    order = np.argsort(np.where(gone, 2, np.where(chosen, 0, 1)), axis=1, kind="stable")[:, :degree]
    out = nodes[np.arange(n)[:, None], order]
    return np.pad(out, ((0, 0), (0, degree - out.shape[1])), constant_values=-1)


def _joined(x: np.ndarray, norms: np.ndarray, links: np.ndarray, fresh: np.ndarray, chosen: np.ndarray) -> None:
    """Give the fresh nodes their neighbours, and the neighbours the fresh nodes; full lists keep the nearest, spread."""
    degree = links.shape[1]
    links[fresh] = chosen
    to, by = chosen.ravel(), np.repeat(fresh, degree)
    to, by = to[to >= 0], by[to >= 0]
    order = np.argsort(to, kind="stable")
    to, by = to[order], by[order]
    first = np.flatnonzero(np.append(True, to[1:] != to[:-1])) if len(to) else np.zeros(0, int)
    for low in range(0, len(first), 512):
        heads = first[low : low + 512]
        stop = np.append(first, len(to))[low + 1 : low + 1 + len(heads)]
        own, most = to[heads], int((stop - heads).max())
        added = np.full((len(heads), most), -1, np.int64)
        row = np.repeat(np.arange(len(heads)), stop - heads)
        span = np.arange(heads[0], stop[-1])
        added[row, span - heads[row]] = by[span]
        every = np.concatenate([links[own], added], axis=1)
        apart = norms[every] - 2 * np.matmul(x[every], x[own][:, :, None])[:, :, 0]
        apart[every < 0] = np.inf
        order = np.argsort(apart, axis=1)[:, : 2 * degree]
        r = np.arange(len(own))[:, None]
        links[own] = _spread(x, every[r, order], apart[r, order], norms, own, degree)


def build(x: np.ndarray, degree: int = DEGREE, breadth: int = BUILD_BREADTH) -> list[np.ndarray]:
    """Neighbour arrays of the levels, lowest first. Node 0 is on every level; a node of a level is one of all nodes, -1 is none."""
    n = len(x)
    rank = buffers.mixed(np.arange(1, n + 1, dtype=np.uint64)).astype(np.float64) / 2.0**64
    rank[0] = 0.0
    height = max(1, int(np.ceil(np.log(max(n, 2)) / np.log(LEVEL_SHARE))))
    norms = (x * x).sum(axis=1)
    levels: list[np.ndarray] = []
    for level in reversed(range(height)):
        members = np.flatnonzero(rank < float(LEVEL_SHARE) ** -level)
        # those of the level above come first: they are where searches enter
        members = members[np.argsort(rank[members], kind="stable")]
        own_degree = degree if level == 0 else max(4, degree // 2)
        links = np.full((n, own_degree), -1, np.int64)
        done, size = 1, 8
        while done < len(members):
            fresh = members[done : done + size]
            start = _descend(x, norms, levels, x[fresh], np.zeros(len(fresh), np.int64)) if levels else np.zeros((len(fresh), 1), np.int64)
            nodes, apart = _walk(x, norms, links, x[fresh], start, breadth)
            # nodes of one batch see each other too
            among = norms[fresh][None, :] - 2 * (x[fresh] @ x[fresh].T)
            np.fill_diagonal(among, np.inf)
            nodes = np.concatenate([nodes, np.broadcast_to(fresh, among.shape)], axis=1)
            apart = np.concatenate([apart, among], axis=1)
            order = np.argpartition(apart, min(breadth, apart.shape[1] - 1), axis=1)[:, :breadth]
            r = np.arange(len(fresh))[:, None]
            order = order[r, np.argsort(apart[r, order], axis=1)]
            nodes, apart = nodes[r, order], apart[r, order]
            nodes[~np.isfinite(apart)] = -1
            for low in range(0, len(fresh), 256):
                part = slice(low, low + 256)
                chosen = _spread(x, nodes[part], apart[part], norms, fresh[part], own_degree)
                _joined(x, norms, links, fresh[part], chosen)
            done += len(fresh)
            size = min(_BATCH, done)
        levels.insert(0, links)
    return levels


def _descend(x: np.ndarray, norms: np.ndarray, levels: list[np.ndarray], queries: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Nearest few nodes found on the lowest of the given levels, to enter the next one by."""
    at = start[:, None]
    for links in reversed(levels):
        nodes, _ = _walk(x, norms, links, queries, at, 8)
        at = np.where(nodes[:, :4] >= 0, nodes[:, :4], nodes[:, :1])
        at = np.where(at >= 0, at, 0)
        # one node once: a repeated start would fill the list twice
        order = np.argsort(at, axis=1)
        at = np.take_along_axis(at, order, axis=1)
        at = at[:, :1] if (at[:, 1:] == at[:, :-1]).any() else at
    return at


def find(x: np.ndarray, levels: list[np.ndarray], queries: np.ndarray, breadth: int = BREADTH) -> np.ndarray:
    """Nodes of largest inner product with each query, -1 where there are fewer, in no certain order of equals. The last component counts in no search."""
    out = []
    norms = np.zeros(len(x), np.float32)
    doors = np.unique(np.concatenate([np.argsort(-(x[:, :-1] ** 2).sum(axis=1), kind="stable")[:breadth], np.linspace(0, len(x) - 1, min(breadth, len(x)), dtype=np.int64)]))
    for low in range(0, len(queries), 256):
        part = queries[low : low + 256]
        start = _descend(x, norms, levels[1:], part, np.zeros(len(part), np.int64)) if len(levels) > 1 else np.zeros((len(part), 1), np.int64)
        best = min(len(doors), max(8, breadth // 4))
        near = doors[np.argpartition(-(part @ x[doors].T), best - 1, axis=1)[:, :best]]
        start = np.sort(np.concatenate([start, near], axis=1), axis=1)
        start[:, 1:][start[:, 1:] == start[:, :-1]] = -1
        out.append(_walk(x, norms, levels[0], part, start, breadth)[0][:, :breadth])
    return np.concatenate(out) if out else np.zeros((0, breadth), np.int64)


def breadth_for(x: np.ndarray, levels: list[np.ndarray], queries: np.ndarray, k: int, breadth: int = BREADTH, recall: float = RECALL, sample: int = SAMPLE) -> int:
    """`breadth` doubled until some of the queries, compared with all of x, get the share `recall` of their k nearest."""
    some = queries[np.unique(np.linspace(0, len(queries) - 1, min(sample, len(queries)), dtype=np.int64))]
    products = some @ x.T
    k = min(k, len(x))
    least = np.partition(products, len(x) - k, axis=1)[:, len(x) - k, None]
    while breadth < len(x):
        nodes = find(x, levels, some, breadth)
        found = (nodes >= 0) & (np.take_along_axis(products, np.maximum(nodes, 0), axis=1) >= least)
        if np.minimum(found.sum(axis=1), k).mean() >= recall * k:
            break
        breadth *= 2
    return breadth


def scaled(x: np.ndarray) -> np.ndarray:
    """x with components up to one, which changes no order of inner products and fits single precision."""
    return x / (np.abs(x).max(initial=0) or 1.0)


def lengthened(x: np.ndarray) -> np.ndarray:
    """x scaled, and one more component that makes all rows as long as the longest, as what it lacks to that length."""
    x = scaled(x)
    squares = (x * x).sum(axis=1)
    longest = squares.max(initial=0)
    lacking = squares / (np.sqrt(longest) + np.sqrt(np.maximum(longest - squares, 0)))
    return np.column_stack([x, lacking]).astype(np.float32)


_GRAPH = "shard long, ids array<array<long>>, vectors array<array<double>>, degrees array<int>, links array<int>"


def index(table: DataFrame, k: int = K, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row for each shard: distinct vectors, the k + 1 smallest ids of each, and the levels' neighbours one after the other."""
    rows = vectors.usable(table, zero=False)
    # equal vectors meet by value before they are dealt out; only ids that an answer can hold go on
    rows = rows.select("vec_id", "embedding", F.xxhash64(F.transform("embedding", lambda v: v + F.lit(0.0))).alias("name")).distinct()
    ids = F.array_sort(F.collect_set("vec_id"))
    salted = rows.groupBy("name", "embedding", F.pmod(F.xxhash64("vec_id"), F.lit(64)).alias("salt")).agg(F.slice(ids, 1, k + 1).alias("ids"))
    nodes = salted.groupBy("name", "embedding").agg(F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1, k + 1).alias("ids"))
    nodes = written(nodes)
    n = max(1, -(-nodes.count() // shard_rows))

    def graph(group: pa.Table) -> pa.Table:
        group = group.sort_by("name")
        levels = build(lengthened(vectors.matrix(group.column("embedding"))))
        flat = np.concatenate([links.ravel() for links in levels]).astype(np.int32)
        return pa.table({
            "shard": pa.array([group.column("shard")[0].as_py()], pa.int64()),
            "ids": pa.array([group.column("ids").to_pylist()], pa.list_(pa.list_(pa.int64()))),
            "vectors": pa.ListArray.from_arrays(pa.array([0, len(group)], pa.int32()), group.column("embedding").combine_chunks()),
            "degrees": pa.array([[links.shape[1] for links in levels]], pa.list_(pa.int32())),
            "links": pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), pa.array(flat)),
        })

    dealt = nodes.withColumn("shard", F.pmod("name", F.lit(n)))
    return written(shipped(dealt).groupBy("shard").applyInArrow(graph, _GRAPH))


def search(graphs: DataFrame, queries: DataFrame, k: int = K, breadth: int = BREADTH, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score. queries: vec_id and embedding."""
    queries = vectors.usable(queries, zero=False).distinct()
    n_blocks = max(1, -(-queries.count() // block_rows))
    n_shards = graphs.agg(F.coalesce(F.max("shard"), F.lit(0)).alias("n")).first()["n"] + 1
    left = graphs.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))))
    right = queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks))).withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_shards - 1).cast("long"))))

    def run(graph: pa.Table, block: pa.Table) -> pa.Table:
        out: list[np.ndarray] = [np.zeros((0, 2))]
        scores = [np.zeros(0)]
        if len(graph) and len(block):
            stored = graph.column("vectors").combine_chunks()
            x, ids = vectors.matrix(stored.flatten()), graph.column("ids").combine_chunks().flatten()
            firsts, members = ids.offsets.to_numpy(), ids.flatten().to_numpy()
            firsts = firsts - firsts[0]
            q = vectors.matrix(block.column("embedding"))
            width = max(x.shape[1], q.shape[1])
            x, q, names = vectors.widened(x, width), vectors.widened(q, width), block.column("vec_id").to_numpy()
            flat, levels, at = graph.column("links").combine_chunks().flatten().to_numpy().astype(np.int64), [], 0
            for degree in graph.column("degrees")[0].as_py():
                levels.append(flat[at : at + degree * len(x)].reshape(len(x), degree))
                at += degree * len(x)
            nodes, asked = lengthened(x), np.column_stack([scaled(q), np.zeros(len(q))]).astype(np.float32)
            found = find(nodes, levels, asked, breadth_for(nodes, levels, asked, k + 1, max(breadth, k + 1)))
            for i in range(len(q)):
                near = found[i][found[i] >= 0]
                score = x[near] @ q[i]
                sizes = firsts[near + 1] - firsts[near]
                own = np.concatenate([members[firsts[j] : firsts[j + 1]] for j in near]) if len(near) else np.zeros(0, np.int64)
                score = np.repeat(score, sizes)
                other = own != names[i]
                own, score = own[other], score[other]
                best = np.lexsort((own, -score))[:k]
                out.append(np.column_stack([np.full(len(best), names[i]), own[best]]))
                scores.append(score[best])
        pairs = np.concatenate(out).astype(np.int64)
        return pa.table({"query_id": pa.array(pairs[:, 0]), "vec_id": pa.array(pairs[:, 1]), "score": pa.array(np.concatenate(scores), pa.float64())})

    keys = ["shard", "block"]
    found = shipped(left).groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, "query_id long, vec_id long, score double")
    return vectors.best(found, k)


def nearest(table: DataFrame, is_query: Column, **options) -> DataFrame:
    """Search the rows of which is_query holds against all."""
    return search(index(table), table.filter(is_query), **options)
