import json
import random

import pytest
from pyspark.sql import functions as F

from talkloom.functions import shape
from talkloom.functions.strict_json import strict_variant

SPEC = {
    "type": "object",
    "properties": {
        "name": {"type": "string"},
        "kind": {"enum": ["a", "b c", 3, True, None]},
        "tags": {"type": "array", "items": {"type": ["string", "null"]}, "minItems": 1, "maxItems": 3},
        "odd key": {"type": "object", "properties": {"n": {"type": "integer"}, "x": {"type": "number"}}, "additionalProperties": False},
        "deep": {"type": "array", "items": {"type": "object", "required": ["v"], "properties": {"v": {"type": "array", "items": {"type": "boolean"}}}}},
    },
    "required": ["name", "kind"],
    "additionalProperties": False,
}


def types_of(v):
    if v is None:
        return {"null"}
    if isinstance(v, bool):
        return {"boolean"}
    if isinstance(v, int):
        return {"integer", "number"}
    return {{float: "number", str: "string", list: "array", dict: "object"}[type(v)]}


def below(path, key):
    return f"{path}.{key}" if key.isidentifier() else f'{path}["{key}"]'


def plain(v, spec, path="$"):
    wanted = spec.get("type")
    if wanted and not types_of(v) & ({wanted} if isinstance(wanted, str) else set(wanted)):
        return path, "type"
    if "enum" in spec and not any(type(v) is type(e) and v == e for e in spec["enum"]):
        return path, "enum"
    if isinstance(v, dict):
        for key in spec.get("required", []):
            if key not in v:
                return below(path, key), "missing"
        extra = sorted(set(v) - set(spec.get("properties", {})))
        if extra and spec.get("additionalProperties") is False:
            return below(path, extra[0]), "extra"
        for key, part in spec.get("properties", {}).items():
            if key in v and (found := plain(v[key], part, below(path, key))):
                return found
    if isinstance(v, list):
        if not spec.get("minItems", 0) <= len(v) <= spec.get("maxItems", len(v)):
            return path, "items"
        for i, e in enumerate(v):
            if "items" in spec and (found := plain(e, spec["items"], f"{path}[{i}]")):
                return found
    return None


def made(rng, spec, wrong=0.12):
    """A value near the schema, wrong here and there."""
    if rng.random() < wrong:
        return rng.choice([None, True, 7, 2.5, "a", "", [], {}, [1], {"v": 1}, 10**20])
    if "enum" in spec:
        return rng.choice(spec["enum"])
    kind = spec.get("type", "string")
    kind = kind if isinstance(kind, str) else rng.choice(kind)
    if kind == "object":
        out = {k: made(rng, p, wrong) for k, p in spec.get("properties", {}).items() if rng.random() < 0.9}
        if rng.random() < wrong:
            out[rng.choice(["zz", "extra key", "_a"])] = 1
        return out
    if kind == "array":
        return [made(rng, spec["items"], wrong) for _ in range(rng.randrange(0, 5))]
    return {"string": "text", "integer": rng.choice([0, -5, 10**19]), "number": 1.5, "boolean": False, "null": None}[kind]


def faults(spark, texts, spec):
    frame = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    rows = frame.select("i", shape.violation(strict_variant(F.col("t")), spec).alias("v")).orderBy("i").collect()
    return [tuple(r["v"]) if r["v"] else None for r in rows]


def test_generated_values_equal_a_plain_validator(spark):
    rng = random.Random(4)
    values = [made(rng, SPEC, 0.03 * (i % 5)) for i in range(1500)]
    got = faults(spark, [json.dumps(v) for v in values], SPEC)
    want = [plain(v, SPEC) for v in values]
    assert got == want and None in want and {r for f in want if f for r in f[1:]} == {"type", "enum", "missing", "extra", "items"}


def test_edges(spark):
    assert faults(spark, [None, "", "{", "null", "3"], {"type": "null"}) == [("$", "not_json")] * 3 + [None, ("$", "type")]
    assert faults(spark, ['{"a":1}', "[]", "1"], {}) == [None] * 3
    assert faults(spark, ['{"a":1}', "{}"], {"additionalProperties": False}) == [("$.a", "extra"), None]
    assert faults(spark, ["[" * 30 + "]" * 30], {"items": {"items": {"type": "string"}}}) == [("$[0][0]", "type")]


@pytest.mark.parametrize("spec", [{"pattern": "x"}, {"type": "date"}, {"additionalProperties": {}}, {"enum": [1.5]}, {"properties": {"a": {"oneOf": []}}}])
def test_what_is_not_supported_is_refused(spark, spec):
    with pytest.raises(ValueError):
        shape.violation(F.col("v"), spec)
