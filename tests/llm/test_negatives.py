import numpy as np
import pytest
from pyspark.sql import functions as F

import oracle
from talkloom.llm import negatives, q_negatives

ROWS = "vec_id long, embedding array<float>, label int, tree string, score int"


def plain(rows, is_anchor, k=5, scale=256):
    best = {}
    for i, v, label in rows:
        if i is not None and v is not None and label is not None and all(c is not None and np.isfinite(c) for c in v):
            row = (label, tuple(int(np.floor(float(c) * scale)) for c in v))
            best[i] = min(best.get(i, row), row)
    out = set()
    for a, (label, x) in best.items():
        if not is_anchor(a):
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y, strict=False)), i, other) for i, (other, y) in best.items() if i != a)
        for p, positive, _ in [s for s in scored if s[2] == label][:k]:
            fits = [(n, i) for n, i, other in scored if other != label and 80 * -p <= 100 * -n <= 100 * -p]
            out |= {(a, positive, rank, i, -p, -n) for rank, (n, i) in enumerate(fits[:k], 1)}
    return out


def mine(spark, rows, every, **kw):
    frame = spark.createDataFrame([(i, v, label, "x", 1) for i, v, label in rows], ROWS)
    got = [tuple(r) for r in negatives.mined(negatives.prepared(frame, F.col("label")), F.col("vec_id") % every == 0, **kw).collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("size", ["sf0.001", "sf0.1"])
def test_query_equals_sql(spark, size):
    folder = f"/root/testdata/{size}"
    got = oracle.spark_rows(q_negatives.op11_negatives(spark, folder))
    assert got == oracle.duck_rows(oracle.connect(folder), q_negatives.OP11_SQL) and len(got[1]) > 10


def hard_rows(n=260, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, 12))
    rows = [(i, (centres[i % 6] + rng.normal(size=12) * rng.choice([0.01, 0.3])).astype(np.float32).tolist(), int(rng.choice([-1, 0, 0, 0, 2]))) for i in range(n)]
    rows += [(n + i, rows[3][1], i % 2) for i in range(80)]  # equal vectors of two labels
    rows += [(1000 + i, v, 0) for i, v in enumerate([None, [None] * 12, [float("nan")] * 12, [float("inf")] * 12, [], [0.0] * 12, [1.0] * 3, [2.0] * 40])]
    return rows + [(1100, [1.0] * 12, None), (None, [1.0] * 12, 0), rows[7], (20, rows[9][1], 5)]


@pytest.mark.parametrize("tree_rows", [None, 50])
def test_hard_rows(spark, tree_rows):
    rows = hard_rows()
    got = mine(spark, rows, 10, tree_rows=tree_rows)
    assert got == plain(rows, lambda i: i % 10 == 0) and len(got) > 200


def test_tree_prunes_and_finds_ties():
    rng = np.random.default_rng(5)
    x = np.repeat(rng.integers(-300, 300, (120, 6)), 10, axis=0)
    ids, labels = rng.permutation(len(x)), rng.integers(0, 3, len(x))
    tree = negatives.Tree(ids, labels, x)
    assert sorted(tree.ids.tolist()) == list(range(1200)) and len(tree.levels) >= 3
    for low, high, _, _ in tree.levels:
        assert (low <= high).all()
    q = x[17]
    windows = np.array([[-(2**62), 2**62], [0, 40_000], [5, 4]])
    for same in (True, False):
        found = {w: list(zip(i.tolist(), s.tolist(), strict=True)) for w, i, s in tree.search(q, int(ids[17]), int(labels[17]), same, windows, 5)}
        scores = x @ q
        for w, (begin, end) in enumerate(windows.tolist()):
            fits = sorted((-s, i) for s, i, la in zip(scores.tolist(), ids.tolist(), labels.tolist(), strict=True) if (la == labels[17]) == same and i != ids[17] and begin <= s <= end)
            assert found.get(w, []) == [(i, -s) for s, i in fits[:5]]


def test_edges(spark):
    assert mine(spark, [], 10) == set()
    alone = [(0, [1.0, 2.0], 1), (1, [1.0, 1.5], 1), (2, [0.5, 0.5], 1)]
    assert mine(spark, alone, 10) == set()
    below = [*alone, (3, [-1.0, -1.0], 2), (4, [1.0, 1.4], 2)]
    assert mine(spark, below, 1) == plain(below, lambda i: True) != set()
    assert mine(spark, [(0, [-1.0], 1), (1, [1.0], 1), (2, [0.9], 2)], 10) == set()  # a positive with a negative score
