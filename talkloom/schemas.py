"""Explicit schemas: no reader of this package infers one."""

from pyspark.sql import types as T

_S = T.StringType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


PROMPT = _struct(History=T.ArrayType(_S), AvailableActions=T.ArrayType(_S), UserInput=_S)
ANSWER = _struct(MessageText=_S, Content=_struct(Action=_S))
EXAMPLE = _struct(prompt=PROMPT, answer=ANSWER)

# one JSON line per example, the form for large corpora
EXAMPLE_LINE = _struct(example_id=_S, system=_S, prompt=PROMPT, answer=ANSWER)
DIALOG_MAP = _struct(system=_S, examples=T.MapType(_S, EXAMPLE))
DIALOG_ARRAY = _struct(system=_S, examples=T.ArrayType(EXAMPLE))

SFT = _struct(system=_S, user=_S, bot=_S)
PAIR = _struct(translated=_S, original=_S)
MESSAGE = _struct(type=_S, to_me=T.BooleanType(), user_id=T.LongType(), peer_id=T.LongType(), text=_S)

# what a model response has to look like, and the same as schema_of_variant() prints it
RESPONSE = ANSWER
RESPONSE_VARIANT = "OBJECT<Content: OBJECT<Action: STRING>, MessageText: STRING>"
