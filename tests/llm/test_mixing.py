import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from talkloom.llm import mixing

SIZES = "doc_id long, source string, size long"


def water_filled(sizes, weights=(5, 2, 1), share=Fraction(3, 2), repeats=2):
    """Shares the excess of full sources again and again."""
    names = sorted((x for x in sizes if x is not None), key=str) + ([None] if None in sizes else [])
    weight = {x: weights[i % len(weights)] for i, x in enumerate(names)}
    left, full = share * sum(sizes.values()), {}
    while True:
        rest = {x: left * weight[x] / sum(w for y, w in weight.items() if y not in full) for x in names if x not in full}
        over = [x for x, t in rest.items() if t > repeats * sizes[x]]
        if not over:
            return full | rest
        for x in over:
            full[x] = Fraction(repeats * sizes[x])
            left -= full[x]


def highest_quotients(votes, seats):
    won = {x: 0 for x in votes}
    for _ in range(seats):
        won[max(votes, key=lambda x: (Fraction(votes[x]) / (2 * won[x] + 1), -list(votes).index(x)))] += 1
    return won


@pytest.mark.parametrize("seed", range(3))
def test_targets_and_quotas_follow_the_definitions(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{i:02}": rng.choice([0, 3, 50, 400, 9000]) + rng.randrange(40) for i in range(9)} | {None: 120}
    rows = spark.createDataFrame([(i, k, v) for i, (k, v) in enumerate(sizes.items())], SIZES)
    got = mixing.source_targets(rows).collect()
    want = water_filled(sizes)
    assert {r["source"] for r in got} == set(want)
    for r in got:
        assert r["target"] == pytest.approx(float(want[r["source"]]), abs=1e-6)
    votes = {k: v for k, v in sizes.items() if v}
    cells = spark.createDataFrame([(k, float(v), 137) for k, v in votes.items()], "source string, votes double, seats long")
    quota = {r["source"]: r["quota"] for r in mixing.apportion(cells, [], ["source"], "seats").collect()}
    assert quota == highest_quotients(dict(sorted(votes.items(), key=lambda kv: (kv[0] is None, kv[0] or ""))), 137)


def test_taken_comes_near_the_targets_and_reruns_agree(spark):
    rng = random.Random(1)
    rows = [(i, f"s{i % 7}" if i % 3 else "hot", rng.choice([0, 1, 5, 80, 3000])) for i in range(3000)] + [(7, None, 50), (7, None, 50)]
    sizes = spark.createDataFrame(rows, SIZES)
    got = mixing.mix(sizes, shard_words=100_000).collect()
    assert len(got) == len(rows)
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.mix(sizes.repartition(5), shard_words=100_000).collect()), key=str)
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    for source in {r["source"] for r in got}:
        mine = [r for r in got if r["source"] == source]
        assert sum(r["taken"] for r in mine) == pytest.approx(mine[0]["target"], rel=0.01, abs=64)


def test_edges(spark):
    assert mixing.mix(spark.createDataFrame([], SIZES)).count() == 0
    only_empty = mixing.mix(spark.createDataFrame([(1, "a", 0), (2, None, 0)], SIZES)).collect()
    assert [r["taken"] for r in only_empty] == [0, 0]
    docs = spark.createDataFrame([(1, None, "a", "x", 7), (2, "b c " * 500, None, "x", 8), (None, "d", "q", "y", 9)], "doc_id long, text string, source string, taken string, size int")
    assert mixing.mixed_documents(docs).columns == docs.columns
    assert mixing.mixed_documents(docs).filter("doc_id = 1").count() == 1
    assert docs.select(mixing.word_count(F.col("text")).alias("n")).collect()[1]["n"] == 1000
