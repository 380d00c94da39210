"""Compiled chat templates: rendered texts, white space, and what is refused."""

import pytest
from pyspark.sql import functions as F

from talkloom.functions.templates import compile_template

MESSAGES = "array<struct<role:string,content:string>>"
CHAT = [("system", " be kind "), ("user", "hi\n"), ("assistant", "yo"), ("user", None)]


def render(spark, text, chat=CHAT, **variables):
    df = spark.createDataFrame([(chat,)], f"m {MESSAGES}")
    return df.select(compile_template(text, **variables)(F.col("m")).alias("t")).first()["t"]


TAGS = "{% for message in messages %}<{{ message['role'] }}>{{ message['content'] }}</{{ message.role }}>{% endfor %}"
LINES = """{{- bos_token }}
{%- for m in messages %}
    {%- if m['role'] == 'system' %}
        {{- '[S]' + m['content'] | trim + '\\n' }}
    {%- elif m.role in ['user', 'tool'] and not loop.last %}
        {{- '[U]' + m['content']|trim }}
    {%- else %}
        {{- '[' + m['role'] | upper + ' ' + loop.index0 + ']' + m['content'] }}
    {%- endif %}
{%- endfor %}
{%- if add_generation_prompt %}{{ '[A]' }}{% endif %}"""
BLOCKS = """start
{% for m in messages %}
  {% if loop.first %}
first: {{ m.content }}
  {% endif %}
{% endfor %}
{# a note #}
n={{ messages | length }} {{ 'even' if messages|length % 2 == 0 else 'odd' }} {{ messages[1].content|trim }}{{ messages[9]['content'] }}"""


@pytest.mark.parametrize(
    ("text", "wanted"),
    [
        (TAGS, "<system> be kind </system><user>hi\n</user><assistant>yo</assistant><user></user>"),
        (LINES, "<s>[S]be kind\n[U]hi[ASSISTANT 2]yo[USER 3][A]"),
        (BLOCKS, "start\nfirst:  be kind \nn=4 even hi"),
        ("{{ 'a|b' + \"{%\" + 'it\\'s' }}", "a|b{%it's"),
        ("plain", "plain"),
        ("", ""),
    ],
)
def test_rendered(spark, text, wanted):
    assert render(spark, text, bos_token="<s>", add_generation_prompt=True) == wanted


def test_variables_may_be_columns_and_empty_chats(spark):
    df = spark.createDataFrame([([], "x"), (None, "y")], f"m {MESSAGES}, mark string")
    made = compile_template(TAGS + "{{ mark }}{% if messages[0].role == 'user' or false %}!{% endif %}", mark=F.col("mark"))
    assert [r[0] for r in df.select(made(F.col("m"))).collect()] == ["x", "y"]


def test_raise_exception_only_where_reached(spark):
    text = "{% for m in messages %}{% if m.role == 'tool' %}{{ raise_exception('no ' + m.role) }}{% endif %}{{ m.role }}{% endfor %}"
    assert render(spark, text) == "systemuserassistantuser"
    with pytest.raises(Exception, match="no tool"):
        render(spark, text, [("tool", "x")])


@pytest.mark.parametrize(
    "text",
    [
        "{% set x = 1 %}", "{% for m in other %}{% endfor %}", "{% for m in messages %}", "{% endfor %}", "{{ unknown }}", "{{ m.role }}",
        "{% macro f() %}{% endmacro %}", "{{ messages.items() }}", "{{ 'a' | replace('a', 'b') }}", "{{ messages[0].tools }}", "{{ 1 +", "{{ }}",
        "{% if true %}a{% else %}b{% else %}c{% endif %}", "{% if %}a{% endif %}", "{{ messages[-1].role }}", "{{ __import__('os') }}", "{{ 2 ** 9 }}",
    ],
)
def test_refused(spark, text):
    with pytest.raises(ValueError):
        render(spark, text)
