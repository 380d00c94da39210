"""Chat formatting with a grammar round trip: render, reparse, compare, escape what conflicts, until the parse equals the source.

Grammar of a conversation: piece*, piece = "<|im_start|>" role "\\n" text "<|im_end|>\\n". The parser splits at the start marker, takes
the role up to the first line break and the text up to the end marker, and undoes escapes in both.

Escapes put one backslash after the "<" of every "<", backslashes, "|" in a text, so no marker is left in it and texts that hold
escapes already come back as they were. In a role, whose line break ends it, a line break becomes "<n|", and the same rule covers
"<", backslashes, "n", "|".

Only columns functions are used. Null roles and texts count as empty. Turns are ordered by turn (null first), then role, then text;
conv_id null is a conversation of its own; an empty table has no conversations. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"
_MASKED_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def escape_role(role: Column) -> Column:
    return F.replace(F.regexp_replace(role, r"<(\\*)(n?)\|", r"<\\$1$2|"), F.lit("\n"), F.lit("<n|"))


def unescape_role(role: Column) -> Column:
    return F.regexp_replace(F.replace(role, F.lit("<n|"), F.lit("\n")), r"<\\(\\*)(n?)\|", "<$1$2|")


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(END))


def parse(formatted: Column) -> Column:
    """Turns of a formatted text: array of role and text. What does not follow the grammar gives turns that differ from any source."""
    pieces = F.filter(F.split(formatted, r"<\|im_start\|>", -1), lambda _, i: i > 0)

    def turn(piece: Column) -> Column:
        text = F.substring(piece, F.instr(piece, "\n") + F.lit(1), F.length(piece))
        closed = F.endswith(text, F.lit(END))
        body = F.substring(text, F.lit(1), F.length(text) - F.lit(len(END)))
        return F.struct(
            unescape_role(F.substring_index(piece, "\n", 1)).alias("role"),
            unescape(F.when(closed & ~F.contains(body, F.lit("<|")), body)).alias("text"),
        )

    return F.transform(pieces, turn)


def format_turns(turns: DataFrame) -> DataFrame:
    """Add piece, the rendered turn. A turn is escaped only if its raw rendering does not parse back to it; no shuffle."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    raw = render(role, text)
    same = parse(raw) == F.array(F.struct(role.alias("role"), text.alias("text")))
    return turns.withColumn("piece", F.when(F.coalesce(same, F.lit(False)), raw).otherwise(render(escape_role(role), escape(text))))


def format_conversations(turns: DataFrame) -> DataFrame:
    """conv_id, formatted, parsed, round_trip (the parse equals the source): one row for each conversation, which is one text."""
    rows = format_turns(turns.select("conv_id", "turn", "role", "text"))
    row = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), "piece")
    convs = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("_rows"))
    convs = convs.select("conv_id", F.transform("_rows", lambda r: F.struct(r["role"].alias("role"), r["text"].alias("text"))).alias("_source"), F.array_join(F.transform("_rows", lambda r: r["piece"]), "").alias("formatted"))
    convs = convs.withColumn("parsed", parse(F.col("formatted")))
    return convs.select("conv_id", "formatted", "parsed", F.coalesce(F.col("parsed") == F.col("_source"), F.lit(False)).alias("round_trip"))


def masked(parsed: Column, role: str = _MASKED_ROLE) -> Column:
    """Texts under the loss mask, in order."""
    return F.transform(F.filter(parsed, lambda t: t["role"] == role), lambda t: t["text"])
