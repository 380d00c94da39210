"""Running values with keys cut into slices, against loops over the rows in order."""

import random

import pytest
from pyspark.sql import functions as F

from talkloom.operators import scans
from talkloom.operators.busy import busy_at_arrival
from talkloom.operators.throttle import throttle_schedule

GAP = 10


def requests(n=600, seed=5):
    """One client has a third of the rows, many of them in the same instant; some have no client."""
    rng = random.Random(seed)
    rows, now = [], 0
    for i in range(n):
        now += rng.choice([0, 0, 1, 3, 40 if i % 50 == 0 else 2])
        user = 1 if rng.random() < 0.35 else rng.choice([None, *range(2, 30)])
        rows.append((i, user, now, now + rng.choice([0, 1, 2, 30])))
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def frame(spark):
    df = spark.createDataFrame(requests(), "id long, user long, at long, finish long").withColumn("bot", F.lit("b"))
    return df.repartition(6).cache()


@pytest.mark.parametrize("task_rows", [10_000, 100, 40, 7])
def test_throttle(frame, task_rows):
    wanted, last = {}, {}
    for i, user, at, _ in sorted(requests(), key=lambda r: (r[2], r[0])):
        last[user] = wanted[i] = max(at, last[user] + GAP) if user in last else at
    got = throttle_schedule(frame, "user", "at", "id", GAP, task_rows).collect()
    assert len(got) == 600
    assert {r.id: r.send_us for r in got} == wanted
    assert all(r.delay_us == r.send_us - r["at"] for r in got)


def test_throttle_gap_equal_to_limit(spark):
    df = spark.createDataFrame([(1, 1, 0), (2, 1, 10), (3, 1, 10), (4, 2, 5)], "id long, user long, at long")
    got = {r.id: r.send_us for r in throttle_schedule(df, "user", "at", "id", 10).collect()}
    assert got == {1: 0, 2: 10, 3: 20, 4: 5}


@pytest.mark.parametrize("task_rows", [10_000, 100, 7])
def test_busy(frame, task_rows):
    rows = sorted(requests(), key=lambda r: (r[2], r[0]))
    wanted = {}
    for n, (i, user, at, _) in enumerate(rows):
        running = [r[1] for r in rows[:n] if r[3] > at]
        wanted[i] = bool(running) and user not in running
    got = busy_at_arrival(frame, "bot", "user", "at", "finish", "id", task_rows).collect()
    assert {r.id: r.busy for r in got} == wanted
    assert 0 < sum(wanted.values()) < 600


@pytest.mark.parametrize("task_rows", [10_000, 60])
def test_ordinal(frame, task_rows):
    seen, wanted = {}, {}
    for i, user, _, _ in sorted(requests(), key=lambda r: (r[2], r[0])):
        wanted[i] = seen[user] = seen.get(user, -1) + 1
    got = scans.ordinal(frame, ["user"], "at", "id", "n", task_rows).collect()
    assert {r.id: r.n for r in got} == wanted


def test_only_large_keys_are_cut(frame):
    slices = scans.slice_hot_keys(frame, ["user"], "at", "id", task_rows=100)
    cut = {r.user: r.n for r in slices.rows.groupBy("user").agg(F.countDistinct("_slice").alias("n")).collect()}
    assert slices.split and cut.pop(1) >= 2 and set(cut.values()) == {1}
    sizes = slices.rows.filter("user = 1").groupBy("_slice").count().agg(F.max("count")).first()[0]
    assert sizes <= 130
    assert not scans.slice_hot_keys(frame, ["user"], "at", "id", task_rows=1000).split


def test_sliced_plan_has_no_nested_loop(frame):
    df = busy_at_arrival(frame, "bot", "user", "at", "finish", "id", 50)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("task_rows", [1000, 10])
def test_rows_without_a_time_come_first(spark, task_rows):
    rows = [(1, None if i % 50 == 0 else i // 3, i) for i in range(100)]
    df = spark.createDataFrame(rows, "key long, at long, id long")
    got = {r.id: r.pos for r in scans.ordinal(df, ["key"], "at", "id", "pos", task_rows).collect()}
    wanted = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
    assert got == {r[2]: i for i, r in enumerate(wanted)}


@pytest.mark.parametrize("at", ["5", "null", "if(id % 4 = 0, null, 9)"])
def test_one_instant_is_cut_by_its_ties(spark, at):
    df = spark.range(1000).selectExpr("1 as key", f"cast({at} as long) as at", "id", "id % 7 as run").repartition(4)
    slices = scans.slice_hot_keys(df, ["key"], "at", "id", task_rows=50)
    assert slices.rows.groupBy("_slice").count().agg(F.max("count")).first()[0] <= 110
    rows = sorted(df.collect(), key=lambda r: (r["at"] is not None, r["at"] or 0, r.id))
    got = {r.id: r.pos for r in scans.ordinal(df, ["key"], "at", "id", "pos", 50).collect()}
    assert got == {r.id: i for i, r in enumerate(rows)}
    for task_rows in (7, 10**6):
        sent = throttle_schedule(df.filter("at is not null"), "key", "at", "id", GAP, task_rows).collect()
        of_time = [r for r in rows if r["at"] is not None]
        assert {r.id: r.send_us for r in sent} == {r.id: r["at"] + i * GAP for i, r in enumerate(of_time)}


def test_order_column_may_be_a_time_and_ties_may_be_text(spark):
    df = spark.range(300).selectExpr("1 as key", "timestamp_seconds(id div 3) as at", "lpad(id, 4, '0') as id")
    got = {int(r.id): r.pos for r in scans.ordinal(df, ["key"], "at", "id", "pos", 20).collect()}
    assert got == {i: i for i in range(300)}
