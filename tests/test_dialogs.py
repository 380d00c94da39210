"""Dialogue expansion against a plain loop, also for conversations cut into chunks."""

import random

import pytest
from pyspark.sql import functions as F

from talkloom.operators.dialogs import expand_dialogs, explode_examples


def conversations(seed=3):
    rng = random.Random(seed)
    rows = []
    for conv, size in enumerate([0, 1, 2, 5, 9, 40, 3, 61]):
        turn = rng.randrange(3)
        for i in range(size):
            role = "system" if i == 0 and conv % 2 else rng.choice(["user", "assistant", "user", "assistant", "system"][: 4 + (conv == 7)])
            rows.append((conv, turn, role, f"t{conv}.{i} it's"))
            turn += rng.choice([1, 1, 1, 4])
    return rows


def by_loop(rows, max_history):
    made = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(r for r in rows if r[0] == conv)
        for i in range(1, len(turns)):
            if turns[i][2] != "assistant" or turns[i - 1][2] != "user":
                continue
            before = turns[: i - 1]
            system = next((t[3] for t in turns[:i] if t[2] == "system"), "none")
            kept = before if max_history is None else before[len(before) - min(max_history, len(before)) :]
            lines = [f"{'BOT' if r == 'assistant' else r}: '{t}'" for _, _, r, t in kept]
            made[conv, turns[i][1]] = (system, lines, turns[i - 1][3], turns[i][3])
    return made


@pytest.mark.parametrize("chunk", [1000, 7, 2])
@pytest.mark.parametrize("max_history", [None, 0, 1, 5])
def test_expansion(spark, chunk, max_history):
    rows = conversations()
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    made = expand_dialogs(turns, default_system="none", max_history=max_history, names={"assistant": "BOT"}, chunk=chunk)
    got = made.collect()
    result = {
        (r.conv_id, r.turn): (r.system, r.prompt.History, r.prompt.UserInput, r.answer.MessageText) for r in got
    }
    assert len(result) == len(got)
    assert result == by_loop(rows, max_history)


def test_long_conversation_is_not_one_group(spark):
    turns = spark.range(600).select(
        F.lit(1).alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.col("id").cast("string").alias("text"),
    )
    made = expand_dialogs(turns, max_history=4, chunk=50)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "collect_list" in line and "Window" in line]
    assert windows and all("_chunk" in line for line in windows)
    assert made.count() == 300
    last = made.filter("turn = 599").first()
    assert last.prompt.History == [f"{'assistant' if i % 2 else 'user'}: '{i}'" for i in range(594, 598)]


@pytest.mark.parametrize("max_history", [None, 3])
def test_other_conversations_change_nothing(spark, max_history):
    one = [(1, None, "user", "n"), (1, -300, "system", None), (1, -1, "system", "S2"), (1, 0, "user", "u"), (1, 1, "assistant", "a")]
    other = [(2, i, ("user", "assistant")[i % 2], str(i)) for i in range(600)]

    def of_one(rows):
        turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
        return expand_dialogs(turns, max_history=max_history).filter("conv_id = 1").collect()

    alone = of_one(one)
    assert alone == of_one(one + other)
    assert alone[0].system == "S2" and alone[0].prompt.History[-1] == "system: 'S2'"


def test_empty_table(spark):
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert expand_dialogs(turns).count() == 0


def test_actions_and_action(spark):
    turns = spark.createDataFrame([(1, 0, "user", "u"), (1, 1, "assistant", "a")], "conv_id int, turn int, role string, text string")
    row = expand_dialogs(turns, ["x", "y"], F.lit("x")).first()
    assert row.prompt.AvailableActions == ["x", "y"] and row.answer.Content.Action == "x" and row.system is None


def test_explode_examples_of_both_shapes(spark):
    kind = "struct<prompt:struct<UserInput:string>,answer:struct<MessageText:string>>"
    one = (("hi",), ("yo",))
    as_map = spark.createDataFrame([("s", {"b": one, "a": one})], f"system string, examples map<string,{kind}>")
    assert {r.example_id for r in explode_examples(as_map).collect()} == {"a", "b"}
    as_array = spark.createDataFrame([("s", [one, one])], f"system string, examples array<{kind}>")
    assert [(r.pos, r.example_id, r.system) for r in explode_examples(as_array).collect()] == [(0, "0", "s"), (1, "1", "s")]
