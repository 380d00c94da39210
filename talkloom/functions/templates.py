"""Chat templates given as text, compiled to one Column.

The language is the part of Jinja that chat templates are written in:

* `{{ expression }}`, `{% for message in messages %} ... {% endfor %}`, `{% if %}`, `{% elif %}`, `{% else %}`, `{% endif %}`, comments
  `{# #}`, and `-` inside a mark to strip the white space on its outer side. As with chat templates elsewhere, the line break after
  a `{% %}` mark and the blanks before it on its line are left out.
* In expressions: strings, whole numbers, true and false, `message['role']` and `message.role`, `messages[0]['content']`, `loop.first`, `loop.last`,
  `loop.index`, `loop.index0`, given variables, `+`, `==`, `!=`, `<` and its like, `%`, `and`, `or`, `not`, `in` with a list of constants, `x if c else y`, the filters trim, upper, lower and
  length, `messages | length`, and `raise_exception(text)`.

Anything else is a ValueError when the template is compiled. A null text counts as empty. What the template needs of the rows is one
array of structs; loops become `transform`, conditions `when`, so all stays in the plan's generated code and no row goes to Python.
"""

from __future__ import annotations

import ast
import re
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_MARK = re.compile(r"(\{\{.*?\}\}|\{%.*?%\}|\{#.*?#\})", re.S)
_STRING = re.compile(r"""('(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")""", re.S)
_SPACES = " \t\r\n\v\f"

Scope = Mapping[str, object]
Body = Callable[[Scope], Column]


def _blanks(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


_FILTERS: dict[str, Callable[[Column], Column]] = {"trim": _blanks, "upper": F.upper, "lower": F.lower, "length": F.length}
_COMPARED = {
    ast.Eq: lambda a, b: a == b, ast.NotEq: lambda a, b: a != b, ast.Lt: lambda a, b: a < b,
    ast.LtE: lambda a, b: a <= b, ast.Gt: lambda a, b: a > b, ast.GtE: lambda a, b: a >= b,
}


@dataclass(frozen=True)
class _Messages:
    """An array of messages, which may be looped over, indexed and counted."""

    column: Column


@dataclass(frozen=True)
class _Message:
    column: Column


@dataclass(frozen=True)
class _Loop:
    at: Column
    size: Column


def compile_template(text: str, **variables: str | bool | int | Column) -> Callable[[Column], Column]:
    """P7. A function from a column of messages (array of structs of role and content) to the rendered text.

    `variables` are what the template may name besides `messages`, such as bos_token or add_generation_prompt.
    """
    given = {name: value if isinstance(value, Column) else F.lit(value) for name, value in variables.items()} if variables else {}
    names = {"messages", *given}
    marks = list(_marks(text))
    body, end = _block(marks, 0, (), names)
    if end != len(marks):
        raise ValueError(f"unexpected {{% {marks[end][1]} %}}")
    return lambda messages: body({**given, "messages": _Messages(messages)})


def _marks(text: str) -> Iterator[tuple[str, str]]:
    """(kind, content) of texts, outputs ({{) and statements ({%), with white space control done."""
    parts = _MARK.split(text)
    for i, part in enumerate(parts):
        if i % 2:
            inner = part[2:-2].removeprefix("-").removesuffix("-").strip()
            if part[1] != "#":
                yield part[:2], inner
            continue
        if i and (parts[i - 1][-3] == "-"):
            part = part.lstrip(_SPACES)
        elif i and parts[i - 1][1] in "%#":
            part = part.removeprefix("\n")
        if i + 1 < len(parts):
            if parts[i + 1][2] == "-":
                part = part.rstrip(_SPACES)
            elif parts[i + 1][1] in "%#":
                line = re.search(r"(^|\n)[ \t]*\Z", part)
                # blanks are left out only where the mark is the first thing of its line
                if line and (line[1] or not i or parts[i - 1].endswith(("%}", "#}")) and parts[i].startswith("\n")):
                    part = part[: line.end(1)]
        if re.search(r"\{[{%#]|[%}#]\}", part):
            raise ValueError(f"unclosed mark in {part!r}")
        if part:
            yield "", part


def _joined(bodies: list[Body]) -> Body:
    if not bodies:
        return lambda scope: F.lit("")
    return bodies[0] if len(bodies) == 1 else lambda scope: F.concat(*[b(scope) for b in bodies])


def _block(marks: list[tuple[str, str]], at: int, ends: tuple[str, ...], names: set[str]) -> tuple[Body, int]:
    """The body up to one of the statements that end it, and where that is."""
    bodies: list[Body] = []
    while at < len(marks):
        kind, content = marks[at]
        word = content.split(None, 1)[0] if kind == "{%" and content else ""
        if kind == "":
            bodies.append(lambda scope, text=content: F.lit(text))
        elif kind == "{{":
            bodies.append(_text(_expression(content, names)))
        elif word in ends:
            return _joined(bodies), at
        elif word == "for":
            body, at = _for(marks, at, names)
            bodies.append(body)
        elif word == "if":
            body, at = _if(marks, at, names)
            bodies.append(body)
        else:
            raise ValueError(f"unsupported statement {{% {content} %}}")
        at += 1
    if ends:
        raise ValueError(f"no {{% {ends[-1]} %}}")
    return _joined(bodies), at


def _for(marks: list[tuple[str, str]], at: int, names: set[str]) -> tuple[Body, int]:
    head = re.fullmatch(r"for\s+([A-Za-z_]\w*)\s+in\s+messages", marks[at][1])
    if head is None:
        raise ValueError(f"unsupported loop {{% {marks[at][1]} %}}")
    name = head[1]
    body, end = _block(marks, at + 1, ("endfor",), names | {name, "loop"})

    def run(scope: Scope) -> Column:
        messages = scope["messages"].column
        each = lambda m, i: body({**scope, name: _Message(m), "loop": _Loop(i, F.size(messages))})
        return F.coalesce(F.array_join(F.transform(messages, each), ""), F.lit(""))

    return run, end


def _if(marks: list[tuple[str, str]], at: int, names: set[str]) -> tuple[Body, int]:
    cases: list[tuple[Body | None, Body]] = []
    word = "if"
    while word != "endif":
        statement = marks[at][1].split(None, 1)
        if (word == "else") != (len(statement) == 1) or (cases and cases[-1][0] is None):
            raise ValueError(f"unsupported branch {{% {marks[at][1]} %}}")
        test = None if word == "else" else _expression(statement[1], names)
        body, at = _block(marks, at + 1, ("elif", "else", "endif"), names)
        cases.append((test, body))
        word = marks[at][1].split(None, 1)[0]

    def run(scope: Scope) -> Column:
        out = F.lit("")
        for test, body in reversed(cases):
            out = body(scope) if test is None else F.when(_truth(test(scope)), body(scope)).otherwise(out)
        return out

    return run, at


def _text(value: Body) -> Body:
    def run(scope: Scope) -> Column:
        return F.coalesce(_column(value(scope)).cast("string"), F.lit(""))

    return run


def _column(value: object) -> Column:
    if not isinstance(value, Column):
        raise ValueError("messages and loops are no texts")
    return value


def _truth(value: object) -> Column:
    return F.coalesce(_column(value).cast("boolean"), F.lit(False))


def _expression(text: str, names: set[str]) -> Body:
    """Parsed as Python, whose expressions these are, with the filter bar as an operator that binds tighter than `+`."""
    parts = _STRING.split(text)
    code = "".join(p if i % 2 else re.sub(r"\btrue\b", "True", re.sub(r"\bfalse\b", "False", p.replace("|", "@"))) for i, p in enumerate(parts))
    try:
        tree = ast.parse(code.strip(), mode="eval").body
    except SyntaxError as failure:
        raise ValueError(f"unsupported expression {text!r}") from failure
    return _node(tree, names, text)


def _node(node: ast.expr, names: set[str], text: str) -> Body:
    unsupported = ValueError(f"unsupported expression {text!r}")
    inner = lambda part: _node(part, names, text)
    if isinstance(node, ast.Constant) and isinstance(node.value, str | bool | int):
        return lambda scope: F.lit(node.value)
    if isinstance(node, ast.Name):
        if node.id not in names:
            raise ValueError(f"unknown name {node.id!r} in {text!r}")
        return lambda scope: scope[node.id]
    if isinstance(node, ast.Attribute) or (isinstance(node, ast.Subscript) and isinstance(node.slice, ast.Constant)):
        field = node.attr if isinstance(node, ast.Attribute) else node.slice.value
        of = inner(node.value)
        if not (field in ("role", "content", "first", "last", "index", "index0") or (isinstance(field, int) and field >= 0)) or isinstance(field, bool):
            raise unsupported
        return lambda scope: _field(of(scope), field, unsupported)
    if isinstance(node, ast.BinOp) and isinstance(node.op, ast.MatMult) and isinstance(node.right, ast.Name) and node.right.id in _FILTERS:
        of = inner(node.left)
        return lambda scope: _filtered(of(scope), node.right.id)
    if isinstance(node, ast.BinOp) and isinstance(node.op, ast.Add):
        left, right = _text(inner(node.left)), _text(inner(node.right))
        return lambda scope: F.concat(left(scope), right(scope))
    if isinstance(node, ast.BinOp) and isinstance(node.op, ast.Mod):
        left, right = inner(node.left), inner(node.right)
        return lambda scope: _column(left(scope)) % _column(right(scope))
    if isinstance(node, ast.Compare) and len(node.ops) == 1:
        left, (op,), (right,) = inner(node.left), node.ops, node.comparators
        if isinstance(op, ast.In | ast.NotIn) and isinstance(right, ast.List | ast.Tuple) and all(isinstance(e, ast.Constant) for e in right.elts):
            values = [e.value for e in right.elts]
            among = lambda scope: F.coalesce(_column(left(scope)).isin(values), F.lit(False))
            return among if isinstance(op, ast.In) else lambda scope: ~among(scope)
        if type(op) in _COMPARED:
            other = inner(right)
            return lambda scope: _COMPARED[type(op)](_column(left(scope)), _column(other(scope)))
    if isinstance(node, ast.BoolOp):
        parts = [inner(v) for v in node.values]
        join = (lambda a, b: a & b) if isinstance(node.op, ast.And) else (lambda a, b: a | b)
        return lambda scope: reduce(join, [_truth(p(scope)) for p in parts])
    if isinstance(node, ast.UnaryOp) and isinstance(node.op, ast.Not):
        of = inner(node.operand)
        return lambda scope: ~_truth(of(scope))
    if isinstance(node, ast.IfExp):
        test, yes, no = inner(node.test), _text(inner(node.body)), _text(inner(node.orelse))
        return lambda scope: F.when(_truth(test(scope)), yes(scope)).otherwise(no(scope))
    if isinstance(node, ast.Call) and isinstance(node.func, ast.Name) and node.func.id == "raise_exception" and len(node.args) == 1 and not node.keywords:
        said = _text(inner(node.args[0]))
        return lambda scope: F.raise_error(said(scope)).cast("string")
    raise unsupported


def _field(of: object, field: str | int, unsupported: ValueError) -> object:
    if isinstance(of, _Messages) and isinstance(field, int):
        return _Message(F.get(of.column, F.lit(field)))
    if isinstance(of, _Message) and field in ("role", "content"):
        return of.column[field]
    if isinstance(of, _Loop) and field in ("first", "last", "index", "index0"):
        return {"first": of.at == 0, "last": of.at == of.size - 1, "index": of.at + 1, "index0": of.at}[field]
    raise unsupported


def _filtered(of: object, name: str) -> Column:
    if isinstance(of, _Messages) and name == "length":
        return F.size(of.column)
    return _FILTERS[name](F.coalesce(_column(of).cast("string"), F.lit("")))
