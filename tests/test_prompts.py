import json

import pytest
from pyspark.sql import functions as F

from talkloom import schemas
from talkloom.functions import prompts as P
from talkloom.operators.inference import build_requests

NASTY = ["", "a", "it's", 'say "x"', "it's \"x\"", "a\\b", "l1\nl2\r\tz", "é ü 漢", "\U0001f600'", "\x00\x1f\x7f", "\xa0\xad",
         "\u2028\u200b", "\U000e0001", "it's\n\\'", "\\'\""]


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_python_repr(spark):
    df = spark.createDataFrame([(t,) for t in NASTY], "t string")
    got = {r[0]: r[1] for r in df.select("t", P.python_repr(F.col("t"))).collect()}
    assert got == {t: repr(t) for t in NASTY}
    listed = df.groupBy().agg(F.collect_list("t").alias("l")).select("l", P.python_list(F.col("l"))).first()
    assert listed[1] == repr(listed[0])


def test_targets(spark):
    for text in NASTY:
        answer = {"MessageText": text, "Content": {"Action": "A"}}
        message, action = F.lit(text), F.lit("A")
        assert one(spark, P.answer_target(message, action, "repr")) == str(answer)
        assert json.loads(one(spark, P.answer_target(message, action))) == answer
    nothing = F.lit(None).cast("string")
    assert one(spark, P.answer_target(nothing, nothing)) == '{"MessageText":null,"Content":{"Action":null}}'
    assert one(spark, P.answer_target(nothing, nothing, "repr")) == "{'MessageText': None, 'Content': {'Action': None}}"
    assert one(spark, P.wrap_target(F.lit("x"))) == "START\nx\nEND"
    with pytest.raises(ValueError):
        P.answer_target(nothing, nothing, "xml")


def test_user_prompt(spark):
    template = P.PromptTemplate("P:", "\nA:", "Talk", ", ", "\nU:")
    def shown(history, actions):
        h = F.array(*map(F.lit, history)).cast("array<string>")
        a = F.array(*map(F.lit, actions)).cast("array<string>")
        return one(spark, P.render_user_prompt(template, h, a, F.lit("hi")))

    assert shown(["one", "two"], ["x", "y"]) == "P:\none\ntwo\nA:Talk, x, y\nU:hi"
    assert shown([], []) == "P:\nA:Talk, \nU:hi"


def test_chat_templates(spark):
    full = P.to_messages(system=F.lit("S"), user=F.lit("U"), assistant=F.lit("B"))
    assert one(spark, P.apply_chat_template(full, P.ROLE_TAGS)) == "<s>system\nS</s><s>user\nU</s><s>bot\nB</s>"
    asked = P.to_messages(system=F.lit("S"), user=F.lit("U"))
    assert one(spark, P.apply_chat_template(asked, P.INST)) == "[INST] <<SYS>>\nS\n<</SYS>>\n\nU [/INST]"
    without = P.to_messages(system=F.lit(None).cast("string"), user=F.lit("U"))
    assert one(spark, P.apply_chat_template(without, P.INST)) == "[INST] U [/INST]"
    with pytest.raises(Exception, match="no role tool"):
        one(spark, P.apply_chat_template(P.to_messages(tool=F.lit("x")), P.INST))


def test_reinforcement_prompt_has_no_answer(spark):
    history = F.array(F.lit("system: 's'"), F.lit("user: 'u'"))
    text = one(spark, P.grpo_prompt(history, F.array(F.lit("Open Door"), F.lit("it's")), F.lit("go")))
    assert text == "system: 's'\nAvailableActions: ['Open Door', \"it's\"]\nUser: go"
    assert one(spark, P.grpo_prompt(F.array().cast("array<string>"), F.array(F.lit("x")), F.lit("go"))).startswith("\nAvail")


def test_requests(spark):
    schema = json.loads(P.schema_json(schemas.RESPONSE))
    assert schema["required"] == ["MessageText", "Content"] and schema["additionalProperties"] is False
    assert schema["properties"]["Content"]["properties"] == {"Action": {"type": "string"}}
    assert [tuple(m) for m in one(spark, build_requests(F.lit("u")))] == [("user", "u")]
    both = one(spark, build_requests(F.lit("u"), F.lit("s"), "{}"))
    assert [m.role for m in both] == ["system", "user"] and both[0].content.startswith("s ") and both[0].content.endswith("{}")


def test_few_shot(spark):
    text = one(spark, P.few_shot_prompt("a", "b", F.lit("src"), "Rewrite."))
    assert "'a' -> 'b'" in text and "[src]" in text and text.endswith("Rewrite.")
