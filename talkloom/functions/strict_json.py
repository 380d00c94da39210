"""Column functions that find and parse JSON the way a strict reader does."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from talkloom import constants as C
from talkloom import schemas


def json_block(text: Column) -> Column:
    """E1. Text from the first "{" to the last "}", empty when there is none. Linear time."""
    begin = F.locate("{", text)
    end = F.length(text) - F.length(F.substring_index(text, "}", -1))
    found = (begin > 0) & (end > begin)
    return F.when(found, F.substring(text, begin, end - begin + 1)).otherwise(
        F.when(text.isNotNull(), F.lit(""))
    )


def strict_variant(text: Column) -> Column:
    """E2. The parsed value when the text is one complete JSON value and nothing else, else null.

    The parser stops after the first complete value, so the text is read inside an array, where it
    has to be the only element, and inside an object, where a text that closes the array itself
    ("1],[1") cannot be complete. Bare NaN and Infinity are rejected.
    """
    in_array = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    in_object = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    elements = F.try_variant_get(in_array, "$", "array<variant>")
    # an index outside for a text that is not one value, so that nothing is parsed a third time
    alone = F.coalesce(F.size(elements) == 1, F.lit(False)) & in_object.isNotNull()
    return F.get(elements, F.when(alone, F.lit(0)).otherwise(F.lit(-1)))


def is_strict_json(text: Column) -> Column:
    """E2. True for a text that is strictly one JSON value."""
    return strict_variant(text).isNotNull()


def is_object(value: Column) -> Column:
    return F.coalesce(F.startswith(F.schema_of_variant(value), F.lit("OBJECT")), F.lit(False))


def is_string(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value) == "STRING", F.lit(False))


def action_of(value: Column) -> Column:
    """Action as a variant: null when a key is missing, a JSON null stays a value."""
    return F.try_variant_get(value, "$.Content.Action", "variant")


def action_fault(value: Column, action: Column) -> Column:
    """Why there is no action, null when there is one. An action found says both levels are objects."""
    content = F.try_variant_get(value, "$.Content", "variant")
    return (
        F.when(action.isNotNull(), F.lit(None))
        .when(value.isNull(), F.lit(C.BAD_JSON))
        .when(~is_object(value), F.lit(C.BAD_STRUCTURE))
        .when(content.isNotNull() & ~is_object(content), F.lit(C.BAD_STRUCTURE))
        .otherwise(F.lit(C.MISSING_KEY))
    )


def string_of(value: Column) -> Column:
    """The text of a JSON string, null for any other value."""
    return F.when(is_string(value), F.try_variant_get(value, "$", "string"))


def conforms(value: Column, shape: str = schemas.RESPONSE_VARIANT) -> Column:
    """E6. Exactly the required keys, each of the required type, at both levels."""
    return F.coalesce(F.schema_of_variant(value) == shape, F.lit(False))


def message_text(value: Column) -> Column:
    """E8. MessageText when it is a string."""
    return string_of(F.try_variant_get(value, "$.MessageText", "variant"))
