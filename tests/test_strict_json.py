import json
import random

import pytest
from pyspark.sql import functions as F

from talkloom.functions import strict_json as J

HAND = [
    "", " ", "{}", "[]", "null", "true", "1", "-0", "01", "1.", ".5", "1e5", "1E+5", '"a"', "'a'", "{'a':1}",
    '{"a":1} x', '{"a":1},{"a":2}', '{"a":1}],[{"a":2}', '1],[1', '1},{"v":1', '{"a":1,}', "[1,]", "[,1]", '{"a":1,"a":2}',
    '{"a"}', '{"a":}', '{a:1}', '"a\nb"', '"a\\nb"', '"\\ud800"', '"\\x"', "\n {} \t", "nul", "{}{}", "{} {}", "[1][2]",
    '{"v":1}}', '{"a":{"b":[1,{"c":null}]}}', "// c\n{}", "/* c */{}", "tru", '" "', "﻿{}", "+1", "0x1", "1_0",
    '"é"', '{"a":"\U0001f600"}', "\x00", '"\x00"', "\x0b{}", "\xa0{}",
]


def accepts(text):
    def reject(name):
        raise ValueError(name)

    try:
        json.loads(text, parse_constant=reject)
        return True
    except ValueError:
        return False


def mutations(n, seed=7):
    rng = random.Random(seed)
    seeds = ['{"MessageText":"m","Content":{"Action":"Talk"}}', '[1, {"a": [true, null]}, "x"]', '{"a":1.5e3}']
    alphabet = '{}[],:"\'\\ \n0123456789aetrufalsn.-+'
    for _ in range(n):
        text = list(rng.choice(seeds))
        for _ in range(rng.randint(1, 3)):
            at = rng.randrange(len(text))
            kind = rng.random()
            if kind < 0.4:
                del text[at]
            elif kind < 0.8:
                text.insert(at, rng.choice(alphabet))
            else:
                text[at] = rng.choice(alphabet)
        yield "".join(text)


def test_agrees_with_the_strict_reader(spark):
    texts = HAND + list(mutations(3000))
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: (r.ok, r.parsed) for r in df.select(
        "t", J.is_strict_json(F.col("t")).alias("ok"), J.strict_variant(F.col("t")).isNotNull().alias("parsed")
    ).collect()}
    wrong = [t for t in texts if got[t] != (accepts(t), accepts(t))]
    assert wrong == []
    assert sum(accepts(t) for t in texts) > 300


@pytest.mark.parametrize("text", ["NaN", "Infinity", "-Infinity", '{"a":NaN}'])
def test_non_finite_numbers_are_rejected(spark, text):
    row = spark.createDataFrame([(text,)], "t string").select(J.is_strict_json(F.col("t")))
    assert row.first()[0] is False


def test_last_of_equal_keys_wins(spark):
    df = spark.createDataFrame([('{"Content":{"Action":"A"},"Content":{"Action":"B"}}',)], "t string")
    value = J.string_of(J.action_of(J.strict_variant(F.col("t"))))
    assert df.select(value).first()[0] == "B"


def test_block_is_first_brace_to_last(spark):
    import re

    texts = ["", "x", "{", "}", "}{", "{}", "a{b}c", "{a}{b}", "{\n}", "{{}", "{}}", "}{}", "\U0001f600{\U0001f600}é", "{a} } {"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r[0]: r[1] for r in df.select("t", J.json_block(F.col("t"))).collect()}
    for t in texts:
        found = re.search(r"(\{.*\})", t, re.DOTALL)
        assert got[t] == (found.group(1) if found else ""), t
    assert spark.range(1).select(J.json_block(F.lit(None).cast("string"))).first()[0] is None


@pytest.mark.parametrize(
    "text, ok",
    [
        ('{"MessageText":"m","Content":{"Action":"A"}}', True),
        ('{"Content":{"Action":"A"},"MessageText":"m"}', True),
        ('{"MessageText":"m","Content":{"Action":"A"},"x":1}', False),
        ('{"MessageText":"m","Content":{"Action":"A","x":1}}', False),
        ('{"MessageText":1,"Content":{"Action":"A"}}', False),
        ('{"MessageText":"m","Content":{"Action":null}}', False),
        ('{"MessageText":"m","Content":[]}', False),
        ('{"Content":{"Action":"A"}}', False),
        ("[]", False),
        ("x", False),
    ],
)
def test_schema_conformity(spark, text, ok):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(J.conforms(J.strict_variant(F.col("t")))).first()[0] is ok
