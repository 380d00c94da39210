"""Admission rules, and the streams against their batch twins."""

import pytest
from pyspark.sql import functions as F

from talkloom import schemas
from talkloom.operators import admission
from talkloom.operators.busy import busy_at_arrival
from talkloom.sources.messages import read_messages
from talkloom.streaming import messages as M


@pytest.mark.parametrize(
    "text, busy, kinds",
    [
        ("", True, ["no_text"]),
        (None, False, ["no_text"]),
        ("x" * 400, False, ["answer"]),
        ("x" * 401, False, ["wait", "answer"]),
        ("x" * 401, True, ["wait", "busy", "answer"]),
        ("x" * 1200, False, ["wait", "answer"]),
        ("x" * 1201, False, ["wait", "too_long"]),
        ("x" * 1201, True, ["wait", "busy", "too_long"]),
        ("\U0001f600" * 400, False, ["answer"]),
        ("hi", True, ["busy", "answer"]),
    ],
)
def test_replies_in_order(spark, text, busy, kinds):
    df = spark.createDataFrame([(text, busy)], "text string, busy boolean")
    rows = admission.replies(admission.admit(df, F.col("busy"))).orderBy("reply_no").collect()
    assert [r.kind for r in rows] == kinds
    assert all((r.reply is None) == (r.kind == "answer") for r in rows)


@pytest.fixture
def inbox(spark, tmp_path):
    rows = [
        ("message_new", i % 5 != 0, i % 3, 7, ["hi", "", "x" * 500, "y" * 1300][i % 4]) for i in range(40)
    ] + [("typing", True, 1, 7, "hi")]
    folder = str(tmp_path / "inbox")
    spark.createDataFrame(rows, schemas.MESSAGE).repartition(4).write.parquet(folder)
    return folder


def _rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).na.fill("none").collect())


def test_stream_of_replies_equals_batch(spark, inbox, tmp_path):
    stream = admission.admit(read_messages(spark, inbox, files_per_batch=1))
    M.write_replies(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    batch = admission.replies(admission.admit(admission.new_for_us(spark.read.parquet(inbox))))
    columns = ("user_id", "text", "reply_no", "kind", "reply")
    assert _rows(spark.read.parquet(str(tmp_path / "out")), *columns) == _rows(batch, *columns)
    M.write_replies(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == batch.count() > 40 - 8


def test_stream_of_answers(spark, inbox, tmp_path):
    def make():
        return lambda texts: [f"re: {t[:3]}" for t in texts]

    stream = admission.admit(read_messages(spark, inbox))
    M.answer_stream(stream, make, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    sent = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {r.reply for r in sent if r.kind == "answer"} == {"re: hi", "re: xxx"}
    assert {r.kind for r in sent} == {"no_text", "wait", "too_long", "answer"} and not any(r.error for r in sent)


def test_busy_stream_equals_batch(spark, tmp_path):
    schema = "endpoint string, user long, start long, finish long, id long"
    rows = [(f"e{i % 2}", (i * 7) % 5, i * 3, i * 3 + (i * 13) % 40, i) for i in range(90)]
    folder = str(tmp_path / "in")
    checkpoint, out = str(tmp_path / "cp"), str(tmp_path / "out")

    def arrive(part):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
        M.busy_stream(stream, out, checkpoint, "endpoint", "user", "start", "finish", "id").awaitTermination()

    for begin in (0, 30, 60):
        arrive(rows[begin : begin + 30])
    batch = busy_at_arrival(spark.createDataFrame(rows, schema), "endpoint", "user", "start", "finish", "id")
    columns = ("id", "user", "busy")
    wanted = _rows(batch, *columns)
    assert _rows(spark.read.parquet(out), *columns) == wanted
    assert 0 < sum(r[2] for r in wanted) < 90
    state = spark.read.parquet(f"{checkpoint}/running/2")
    assert state.count() <= 10 and state.filter("finish <= 261").count() == 0
