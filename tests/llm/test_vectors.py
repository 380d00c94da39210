import numpy as np
import pytest
from pyspark.sql import functions as F

from talkloom.llm import graph, q_vectors, segments

ROWS = "vec_id long, embedding array<float>, score string, block int"


def plain_top(rows, queries, k, measure=lambda x: np.asarray(x, np.float64), zero=True):
    good = [(i, measure(v)) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    good = [(i, v) for i, v in good if zero or v.any()]
    out = {}
    for i, v in good:
        if i in queries:
            scored = sorted((-float(np.dot(v, w)) if not np.issubdtype(v.dtype, np.integer) else -int(np.dot(v, w)), j) for j, w in good if j != i)
            out[i] = [(j, -s) for s, j in scored[:k]]
    return out


def answers(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: r["rank"]):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def hard_rows(seed, n=400):
    rng = np.random.default_rng(seed)
    rows = [(i, (rng.normal(size=64) * rng.choice([0.1, 1, 3])).astype(np.float32).tolist()) for i in range(n)]
    rows += [(n + i, rows[5][1]) for i in range(60)]  # equal vectors
    rows += [(n + 100, None), (n + 101, [None] * 64), (n + 102, [float("nan")] * 64), (n + 103, [float("inf")] * 64), (n + 104, [0.0] * 64), (None, [1.0] * 64)]
    return rows


@pytest.mark.parametrize(("shard_rows", "block_rows"), [(4096, 1024), (50, 7)])
def test_exact_search(spark, shard_rows, block_rows):
    rows = hard_rows(1)
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], ROWS)
    got = answers(segments.search(frame, F.col("vec_id") % 20 == 0, shard_rows=shard_rows, block_rows=block_rows))
    assert got == plain_top([r for r in rows if r[0] is not None], set(range(0, 1000, 20)), 5, lambda x: np.floor(256 * np.asarray(x, np.float64)).astype(np.int64))


def recall(got, want):
    return sum(len({j for j, _ in got.get(i, [])} & {j for j, _ in w}) for i, w in want.items()) / sum(map(len, want.values()))


@pytest.mark.parametrize("shard_rows", [8192, 100])
def test_graph_search_on_hard_rows(spark, shard_rows):
    rows = hard_rows(2)
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], ROWS)
    got = answers(graph.search(graph.index(frame, shard_rows=shard_rows), frame.filter("vec_id % 20 = 0")))
    want = plain_top([r for r in rows if r[0] is not None], set(range(0, 1000, 20)), 20, zero=False)
    assert set(got) == set(want) and all(len(got[i]) == len(want[i]) for i in want)
    assert recall(got, want) > 0.9
    own = {i: np.asarray(v, np.float64) for i, v in rows if v is not None and None not in v}
    for i, found in got.items():
        for j, score in found:
            assert score == pytest.approx(float(own[i] @ own[j]), rel=1e-12)


@pytest.mark.parametrize("kind", ["plain", "one long vector", "lengths", "clusters", "large"])
def test_graph_search_on_other_rows(spark, kind):
    """No neighbours but those of chance, lengths of any spread, dense groups, components beyond single precision."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(2500, 64))
    if kind == "one long vector":
        x[7] *= 1e6
    if kind == "lengths":
        x *= np.exp(rng.normal(size=(2500, 1)))
    if kind == "clusters":
        x = rng.normal(size=(40, 64))[rng.integers(0, 40, 2500)] + 1e-4 * x
    if kind == "large":
        x *= 1e120
    rows = list(enumerate(x.tolist()))
    frame = spark.createDataFrame(rows + rows[::30], "vec_id long, embedding array<double>")
    got = answers(graph.nearest(frame, F.col("vec_id") % 20 == 0))
    assert all(len({j for j, _ in found}) == len(found) for found in got.values())
    want = plain_top(rows, set(range(0, 2500, 20)), 20, zero=False)
    assert all(len(got[i]) == len(want[i]) for i in want)
    assert recall(got, want) > 0.95


def test_recall_of_the_query(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    queries = {i for i, _ in rows if i % 200 == 0}
    got = answers(q_vectors.op2_graph(spark, sf_dir))
    want = plain_top(rows, queries, 20, zero=False)
    assert recall({i: got[i] for i in want}, want) > 0.95


def test_edges(spark):
    none = spark.createDataFrame([], ROWS)
    assert segments.search(none, F.col("vec_id") % 50 == 0).count() == 0
    assert graph.nearest(none, F.col("vec_id") % 20 == 0).count() == 0
    few = spark.createDataFrame([(0, [1.0, 2.0], "x", 1), (1, [3.0], "x", 1), (20, [0.5, 0.5], "x", 1)], ROWS)
    assert {k: [j for j, _ in v] for k, v in answers(graph.nearest(few, F.col("vec_id") % 20 == 0)).items()} == {0: [1, 20], 20: [0, 1]}
    assert len(answers(segments.search(few, F.col("vec_id") % 20 == 0))[0]) == 2
