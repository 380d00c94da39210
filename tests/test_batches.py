import pytest
from pyspark.sql import functions as F

from talkloom.operators import batches as B


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(203).select("id", ((F.col("id") * 37) % 50).alias("n")).repartition(4)


def test_every_row_is_in_one_batch_of_its_bucket(rows):
    got = B.length_batches(rows, "id", "n", B.hash_bucket("id", 42, 7), 4).collect()
    assert sorted(r.id for r in got) == list(range(203))
    for bucket in {r.bucket for r in got}:
        inside = sorted((r for r in got if r.bucket == bucket), key=lambda r: r["rank"])
        assert [(-r.n, r.id) for r in inside] == sorted((-r.n, r.id) for r in inside)
        assert [r.batch for r in inside] == [i // 4 for i in range(len(inside))]
    again = B.length_batches(rows.repartition(2), "id", "n", B.hash_bucket("id", 42, 7), 4)
    assert {(r.id, r.bucket, r.batch) for r in got} == {(r.id, r.bucket, r.batch) for r in again.collect()}


@pytest.mark.parametrize("group", [65_536, 3])
def test_steps_number_all_batches(rows, group, monkeypatch):
    batches = B.length_batches(rows, "id", "n", B.range_bucket("id", 10), 4)
    offsets = {r.bucket: r._offset for r in B.bucket_offsets(batches, 4, group).collect()}
    assert offsets == {b: 3 * b for b in range(21)}
    plan = sorted(B.step_plan(batches, "n", 4, 2, 5, 10).collect(), key=lambda r: r.batch_no)
    assert [r.batch_no for r in plan] == list(range(61))
    assert [(r.bucket, r.batch) for r in plan] == sorted((r.bucket, r.batch) for r in plan)
    assert all(r.step == r.batch_no // 2 + 1 for r in plan)
    assert {r.step for r in plan if r.logs} == {5, 10, 15, 20, 25, 30}
    assert {r.step for r in plan if r.evaluates} == {10, 20, 30}


def test_large_ids_stay_exact(spark):
    big = 2**60 + 64 * 3 + 63
    row = spark.range(big, big + 1).select(B.range_bucket("id", 64)).first()
    assert row[0] == big // 64


@pytest.mark.parametrize("n", [1, 2, 7, 100, 203, 4096])
def test_a_permutation_for_any_size_and_seed(spark, n):
    got = [r[0] for r in spark.range(n).select(B.permuted(F.col("id"), n, 42)).collect()]
    assert sorted(got) == list(range(n))
    other = [r[0] for r in spark.range(n).select(B.permuted(F.col("id"), n, 43)).collect()]
    assert n < 100 or (got != other and sum(a == i for i, a in enumerate(got)) < n / 10)


def test_grouped_batches_equal_a_plain_loop(rows):
    got = B.grouped_batches(rows, "id", "n", 203, seed=5, batch_size=4, mega=5).collect()
    order = {r.shuffled: r for r in got}
    assert sorted(order) == list(range(203)) and sorted(r.id for r in got) == list(range(203))
    batch = 0
    for begin in range(0, 203, 20):
        part = sorted((order[i] for i in range(begin, min(203, begin + 20))), key=lambda r: (-r.n, r.shuffled))
        for at in range(0, len(part), 4):
            assert {r.batch for r in part[at : at + 4]} == {batch}
            batch += 1
