"""Event-time state against the batch operator: any order within the delay, hot endpoints in cells, bounded state."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from talkloom.operators.busy import busy_at_arrival
from talkloom.plans import files, messages
from talkloom.streaming import busy_state as S

SCHEMA = "endpoint string, user string, start long, finish long, id long"
SECOND = 1_000_000


def requests(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        start = (1000 + i + rng.choice([0, 0, 1])) * SECOND
        finish = rng.choice([start + rng.randrange(8) * SECOND, start - SECOND, None])
        rows.append((rng.choice(["a", "a", "a", "b", None]), rng.choice(["u", "v", "w", None]), start, finish, i))
    return rows


def run(spark, folder, out, checkpoint, parts, cells, delay="30 seconds"):
    for part in parts:
        spark.createDataFrame(part, SCHEMA).repartition(2).write.mode("append").parquet(folder)
        stream = S.busy_state(spark.readStream.schema(SCHEMA).parquet(folder), "endpoint", "user", "start", "finish", "id", delay, cells)
        sink = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True)
        query = sink.start(out)
        query.awaitTermination()
    return query


@pytest.mark.parametrize("cells", [1, 3, "CASE WHEN endpoint = 'a' THEN 4 ELSE 1 END"])
def test_any_order_within_the_delay_equals_batch(spark, tmp_path, cells):
    rows = requests(150, 7)
    rng = random.Random(1)
    # rows are up to 25 seconds late
    arrival = sorted(rows, key=lambda r: r[2] + rng.randrange(25) * SECOND)
    arrival += [(None, "clock", 5000 * SECOND, None, 999)]
    parts = [arrival[:40], arrival[40:80], arrival[80:150], arrival[150:]]
    cells = F.expr(cells) if isinstance(cells, str) else cells
    run(spark, *(str(tmp_path / x) for x in ("in", "out", "cp")), parts, cells)
    got = spark.read.parquet(str(tmp_path / "out")).filter("id < 999").select("id", "busy").collect()
    want = busy_at_arrival(spark.createDataFrame(rows, SCHEMA), "endpoint", "user", "start", "finish", "id").select("id", "busy").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    assert 20 < sum(r["busy"] for r in want) < 130


def test_late_and_timeless_rows_and_bounded_state(spark, tmp_path):
    folder, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "cp"))
    first = [("a", f"u{i}", (1000 + i) * SECOND, (1002 + i) * SECOND, i) for i in range(400)]
    later = [("a", "late", 1001 * SECOND, 9000 * SECOND, 500), ("a", "none", None, 9000 * SECOND, 501), ("a", "x", 1401 * SECOND, 1402 * SECOND, 502)]
    end = [("a", "y", 3000 * SECOND, 3001 * SECOND, 503)]
    query = run(spark, folder, out, checkpoint, [first, later], 1)
    dropped = sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
    assert dropped == 1
    state = spark.read.format("statestore").load(checkpoint).select("value.groupState.*").collect()
    held = state[0]
    pending, running = S._unpacked(held["pending"], S._FIELDS), S._unpacked(held["running"], ["user", "until"])
    # of 400 requests those of the last 30 seconds wait, and those still running are known
    assert len(state) == 1 and len(pending) <= 32 and len(running) <= 4
    run(spark, folder, out, checkpoint, [end, [(None, "clock", 9000 * SECOND, None, 504)]], 1)
    got = {r["id"]: r["busy"] for r in spark.read.parquet(out).collect()}
    assert set(got) - {504} == {*range(400), 501, 502, 503}
    assert not got[0] and all(got[i] for i in range(1, 400)) and not got[501] and not got[503]


def test_outlines_wait_as_spells(spark, tmp_path):
    """Requests that run into one another are one outline in the state of the other cells; gaps stay."""
    folder, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "cp"))
    # one gap, with arrivals before, at and after the last finish
    starts = [1000 + i + 30 * (i >= 200) for i in range(400)]
    rows = [("a", f"u{i % 40}", s * SECOND, (s + 10) * SECOND, i) for i, s in enumerate(starts)]
    rows += [("a", "x", s * SECOND, None, 400 + j) for j, s in enumerate([1101, 1208, 1209, 1210])]
    run(spark, folder, out, checkpoint, [rows], 4, "3000 seconds")
    state = spark.read.format("statestore").load(checkpoint).select("value.groupState.*").collect()
    waiting = [S._unpacked(r["pending"], S._FIELDS) for r in state]
    assert sum((w["kind"] == S._ROW).sum() for w in waiting) == 404
    assert all((w["kind"] == S._OUTLINE).sum() <= 20 for w in waiting)
    run(spark, folder, out, checkpoint, [[(None, "clock", 9000 * SECOND, None, 999)]], 4, "3000 seconds")
    got = spark.read.parquet(out).filter("id < 999").select("id", "busy").collect()
    want = busy_at_arrival(spark.createDataFrame(rows, SCHEMA), "endpoint", "user", "start", "finish", "id").select("id", "busy").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_cells_of_the_query_grow_with_its_requests(spark, tmp_path, monkeypatch):
    asked = []
    monkeypatch.setattr(files, "busy_state", lambda *args: asked.append(args[-1]) or S.busy_state(*args))
    monkeypatch.setattr(files, "CELL_ROWS", 20)
    columns = "event_id long, user_id long, ts timestamp_ntz, value double"
    rows = [(i, i % 7, datetime.datetime(2024, 1, 1, 0, i // 4, i % 4), float(i % 50)) for i in range(190)]
    spark.createDataFrame(rows, columns).write.parquet(str(tmp_path / "events.parquet"))
    got = files.stream_busy_state(spark, str(tmp_path))
    assert set(asked) == {10}
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, messages.busy_at_arrival(spark, str(tmp_path)).collect()))
