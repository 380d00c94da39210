"""Response schemas compiled to one Column that names the first violation."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

NOT_JSON, TYPE, ENUM, MISSING, EXTRA, ITEMS = "not_json", "type", "enum", "missing", "extra", "items"
_KEYWORDS = {"type", "enum", "properties", "required", "additionalProperties", "items", "minItems", "maxItems", "title", "description"}
# how schema_of_variant() prints the types; a whole number is one written without fraction or exponent
_TYPES: dict[str, str] = {
    "string": "STRING",
    "boolean": "BOOLEAN",
    "null": "VOID",
    "integer": r"BIGINT|DECIMAL\([0-9]+,0\)",
    "number": r"BIGINT|DOUBLE|FLOAT|DECIMAL.*",
    "object": "OBJECT.*",
    "array": "ARRAY.*",
}


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _found(path: Column, reason: str) -> Column:
    return F.struct(path.alias("path"), F.lit(reason).alias("reason"))


def _below(path: Column, key: str) -> Column:
    plain = key.isidentifier() and key.isascii()
    return F.concat(path, F.lit(f".{key}" if plain else f"[{json.dumps(key, ensure_ascii=False)}]"))


def _allowed(value: Column, kind: Column, values: list) -> Column:
    """True for a value of the list; numbers are told apart from booleans and texts."""
    texts = [v for v in values if isinstance(v, str)]
    others = [json.dumps(v) for v in values if not isinstance(v, str)]
    is_text = kind == "STRING"
    return F.when(is_text, F.try_variant_get(value, "$", "string").isin(texts)).otherwise(F.coalesce(F.to_json(value), F.lit("null")).isin(others))


def _check(spec: dict) -> None:
    unknown = set(spec) - _KEYWORDS
    if unknown:
        raise ValueError(f"keywords not supported: {sorted(unknown)}")
    if not isinstance(spec.get("additionalProperties", True), bool):
        raise ValueError("additionalProperties has to be true or false")
    if not all(v is None or isinstance(v, str | bool | int) for v in spec.get("enum", [])):
        raise ValueError("enum takes texts, whole numbers, booleans and null")


def _object(value: Column, spec: dict, path: Column) -> Column:
    parts = spec.get("properties", {})

    def faults(fields: Column) -> Column:
        found = [F.when(~F.map_contains_key(fields, key), _found(_below(path, key), MISSING)) for key in spec.get("required", [])]
        if not spec.get("additionalProperties", True):
            known = F.array(*map(F.lit, parts)) if parts else F.array().cast("array<string>")
            first = F.array_min(F.array_except(F.map_keys(fields), known))
            plain = F.rlike(first, F.lit("^[A-Za-z_][A-Za-z0-9_]*$"))
            named = F.when(plain, F.concat(F.lit("."), first)).otherwise(F.concat(F.lit('["'), first, F.lit('"]')))
            found.append(F.when(first.isNotNull(), _found(F.concat(path, named), EXTRA)))
        for key, part in parts.items():
            found.append(F.when(F.map_contains_key(fields, key), _fault(F.try_element_at(fields, F.lit(key)), part, _below(path, key))))
        return F.coalesce(*found) if found else F.lit(None)

    return _bound(F.try_variant_get(value, "$", "map<string,variant>"), faults)


def _array(value: Column, spec: dict, path: Column) -> Column:
    def faults(elements: Column) -> Column:
        found = [F.when(~F.size(elements).between(spec.get("minItems", 0), spec.get("maxItems", 2**31 - 1)), _found(path, ITEMS))]
        if "items" in spec:
            each = F.transform(elements, lambda e, i: _fault(e, spec["items"], F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))))
            found.append(F.get(F.filter(each, lambda f: f.isNotNull()), F.lit(0)))
        return F.coalesce(*found)

    return _bound(F.try_variant_get(value, "$", "array<variant>"), faults)


def _fault(value: Column, spec: dict, path: Column) -> Column:
    _check(spec)

    def faults(v: Column) -> Column:
        kind = F.coalesce(F.schema_of_variant(v), F.lit("VOID"))
        found = []
        if "type" in spec:
            names = [spec["type"]] if isinstance(spec["type"], str) else list(spec["type"])
            if not set(names) <= set(_TYPES):
                raise ValueError(f"unknown type in {names}")
            found.append(F.when(~F.rlike(kind, F.lit("^(?:" + "|".join(_TYPES[n] for n in names) + ")$")), _found(path, TYPE)))
        if "enum" in spec:
            found.append(F.when(~_allowed(v, kind, spec["enum"]), _found(path, ENUM)))
        if {"properties", "required", "additionalProperties"} & set(spec):
            found.append(F.when(F.startswith(kind, F.lit("OBJECT")), _object(v, spec, path)))
        if {"items", "minItems", "maxItems"} & set(spec):
            found.append(F.when(F.startswith(kind, F.lit("ARRAY")), _array(v, spec, path)))
        return F.coalesce(*found, _none()) if found else _none()

    return _bound(value, faults)


def _none() -> Column:
    return F.lit(None).cast("struct<path:string,reason:string>")


def violation(value: Column, spec: dict) -> Column:
    """struct(path, reason) of the first violation of a parsed value, null if it conforms.

    `spec` is a JSON schema of nested objects, arrays, types and enums; keywords beyond those raise. At each level the order is: type, enum, missing
    keys as required, the least extra key, then the parts in their order, elements of arrays from the first. A null value is not JSON. Everything stays
    in one expression: each level reads its object or array once, however many parts it has.
    """
    return F.when(value.isNull(), _found(F.lit("$"), NOT_JSON)).otherwise(_fault(value, spec, F.lit("$")))


def schema_text(spec: dict) -> str:
    """E7. The schema as it goes into a request."""
    return json.dumps(spec, ensure_ascii=False, separators=(",", ":"))
