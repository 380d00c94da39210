"""Column functions that render prompts, targets and chat messages."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkloom import constants as C


@dataclass(frozen=True)
class PromptTemplate:
    """Texts around history, actions and user input. All of them are parameters."""

    preamble: str = "[history]"
    actions: str = "\n[allowed]\n"
    default_action: str = "Talk"
    action_separator: str = ", "
    user_input: str = "\n[input]\n"


def render_user_prompt(
    template: PromptTemplate, history: Column, actions: Column, user_input: Column
) -> Column:
    """P3. Every history line starts on a new line; the default action leads the list.

    An empty action list leaves the separator at the end of the line.
    """
    separator = F.lit(template.action_separator)
    return F.concat(
        F.lit(template.preamble),
        F.array_join(F.transform(history, lambda line: F.concat(F.lit("\n"), line)), ""),
        F.lit(template.actions + template.default_action),
        separator,
        F.array_join(actions, template.action_separator),
        F.lit(template.user_input),
        user_input,
    )


def python_repr(value: Column) -> Column:
    """The literal Python prints for a string, built from native functions."""
    backslashed = F.replace(value, F.lit("\\"), F.lit("\\\\"))
    for char, escape in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        backslashed = F.replace(backslashed, F.lit(char), F.lit(escape))
    hidden = r"[\p{C}\p{Z}&&[^ ]]"

    def hex_escape(char: Column) -> Column:
        code = F.ascii(char)
        digits = F.lower(F.hex(code))
        return (
            F.when(code < 0x100, F.concat(F.lit("\\x"), F.lpad(digits, 2, "0")))
            .when(code < 0x10000, F.concat(F.lit("\\u"), F.lpad(digits, 4, "0")))
            .otherwise(F.concat(F.lit("\\U"), F.lpad(digits, 8, "0")))
        )

    escaped = F.when(
        F.rlike(backslashed, F.lit(hidden)),
        F.array_join(
            F.transform(
                F.regexp_extract_all(backslashed, F.lit("(?s)."), F.lit(0)),
                lambda c: F.when(F.rlike(c, F.lit(hidden)), hex_escape(c)).otherwise(c),
            ),
            "",
        ),
    ).otherwise(backslashed)
    double = F.contains(value, F.lit("'")) & ~F.contains(value, F.lit('"'))
    return F.when(double, F.concat(F.lit('"'), escaped, F.lit('"'))).otherwise(
        F.concat(F.lit("'"), F.replace(escaped, F.lit("'"), F.lit("\\'")), F.lit("'"))
    )


def python_list(values: Column) -> Column:
    """The literal Python prints for a list of strings."""
    return F.concat(F.lit("["), F.array_join(F.transform(values, python_repr), ", "), F.lit("]"))


def answer_target(message: Column, action: Column, mode: str = "json") -> Column:
    """P4. The target text: JSON by default, the printed Python dict with mode="repr"."""
    if mode == "json":
        content = F.struct(action.alias("Action")).alias("Content")
        answer = F.struct(message.alias("MessageText"), content)
        return F.to_json(answer, {"ignoreNullFields": "false"})
    if mode != "repr":
        raise ValueError(f"unknown target mode {mode!r}")

    def or_none(value: Column) -> Column:
        return F.coalesce(python_repr(value), F.lit("None"))

    return F.concat(
        F.lit("{'MessageText': "), or_none(message),
        F.lit(", 'Content': {'Action': "), or_none(action), F.lit("}}"),
    )


def prompt_repr(history: Column, actions: Column, user_input: Column) -> Column:
    """P10. The whole prompt object as Python prints it, user text of the older record form."""
    return F.concat(
        F.lit("{'History': "), python_list(history),
        F.lit(", 'AvailableActions': "), python_list(actions),
        F.lit(", 'UserInput': "), python_repr(user_input), F.lit("}"),
    )


def wrap_target(target: Column, start: str = C.TARGET_START, end: str = C.TARGET_END) -> Column:
    """P10. Target between a start and an end line."""
    return F.concat(F.lit(start + "\n"), target, F.lit("\n" + end))


def to_messages(**by_role: Column) -> Column:
    """P6/P11. Chat messages in keyword order; a role whose text is null is left out."""
    messages = [
        F.when(text.isNotNull(), F.struct(F.lit(role).alias("role"), text.alias("content")))
        for role, text in by_role.items()
    ]
    return F.filter(F.array(*messages), lambda m: m.isNotNull())


@dataclass(frozen=True)
class ChatTemplate:
    """Text before and after a message of each role, and at both ends of the chat."""

    before: Mapping[str, str]
    after: Mapping[str, str]
    start: str = ""
    end: str = ""


# Two chat formats, as text.
ROLE_TAGS = ChatTemplate(
    before={"system": "<s>system\n", "user": "<s>user\n", "assistant": "<s>bot\n"},
    after={"system": "</s>", "user": "</s>", "assistant": "</s>"},
)

INST = ChatTemplate(
    start="[INST] ",
    before={"system": "<<SYS>>\n", "user": "", "assistant": " "},
    after={"system": "\n<</SYS>>\n\n", "user": " [/INST]", "assistant": "</s>"},
)


def _lookup(table: Mapping[str, str], role: Column) -> Column:
    entries = [F.lit(x) for pair in table.items() for x in pair]
    missing = F.raise_error(F.concat(F.lit("chat template has no role "), role))
    return F.coalesce(F.element_at(F.create_map(*entries), role), missing)


def apply_chat_template(messages: Column, template: ChatTemplate) -> Column:
    """P7. One string from an array of messages; an unknown role is an error, not a gap."""
    parts = F.transform(
        messages,
        lambda m: F.concat(
            _lookup(template.before, m["role"]),
            F.coalesce(m["content"], F.lit("")),
            _lookup(template.after, m["role"]),
        ),
    )
    return F.concat(F.lit(template.start), F.array_join(parts, ""), F.lit(template.end))


def grpo_prompt(history: Column, actions: Column, user_input: Column) -> Column:
    """P8. First history line, the printed action list, the user line. Never the answer."""
    return F.concat(
        F.coalesce(F.get(history, F.lit(0)), F.lit("")),
        F.lit(C.ACTIONS_LABEL), python_list(actions),
        F.lit(C.USER_LABEL), user_input,
    )


def few_shot_prompt(example_from: str, example_to: str, source: Column, task: str) -> Column:
    """P12. A worked pair, the source in square brackets, the task."""
    return F.concat(F.lit(f"pair: '{example_from}' -> '{example_to}'\nsource: ["), source, F.lit(f"]\n{task}"))


def schema_json(schema: T.StructType) -> str:
    """E7. JSON-schema text of a struct of strings and structs, extra keys forbidden."""

    def describe(kind: T.DataType) -> dict:
        if isinstance(kind, T.StructType):
            return {
                "type": "object",
                "properties": {f.name: describe(f.dataType) for f in kind.fields},
                "required": [f.name for f in kind.fields],
                "additionalProperties": False,
            }
        if isinstance(kind, T.StringType):
            return {"type": "string"}
        raise TypeError(f"no JSON schema for {kind.simpleString()}")

    return json.dumps(describe(schema), ensure_ascii=False)
