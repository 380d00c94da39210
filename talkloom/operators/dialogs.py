"""Examples from dialogues: nested files and turn tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkloom.operators import scans, skew

CHUNK_TURNS = 256
# Turns without a number come first.
_FIRST_CHUNK = -(2**62)


def explode_examples(dialogs: DataFrame) -> DataFrame:
    """P1. One row per example with its id, source position and the dialogue's system text.

    `examples` is an array of examples (ids are positions) or a map from id to example.
    """
    carried = [c for c in dialogs.columns if c != "examples"]
    if dialogs.schema["examples"].dataType.typeName() == "map":
        rows = dialogs.select(*carried, F.posexplode("examples").alias("pos", "example_id", "_example"))
    else:
        rows = dialogs.select(*carried, F.posexplode("examples").alias("pos", "_example"))
        rows = rows.withColumn("example_id", F.col("pos").cast("string"))
    return rows.select(*carried, "pos", "example_id", "_example.prompt", "_example.answer")


def history_line(role: Column, text: Column, names: Mapping[str, str] | None = None) -> Column:
    """"<role>: '<text>'", with roles renamed by `names`."""
    shown = role
    for name, display in (names or {}).items():
        shown = F.when(role == name, F.lit(display)).otherwise(shown)
    return F.concat(shown, F.lit(": '"), F.coalesce(text, F.lit("")), F.lit("'"))


def expand_dialogs(
    turns: DataFrame,
    actions: Column | Sequence[str] = (),
    action: Column | None = None,
    default_system: str | None = None,
    max_history: int | None = None,
    names: Mapping[str, str] | None = None,
    chunk: int = CHUNK_TURNS,
) -> DataFrame:
    """P2. One example per assistant turn that answers a user turn.

    The preceding user turn is the input, all turns before it (or the last `max_history`) are the
    history, the first system turn before it that has a text is the system text. `turns` has conv_id, turn, role and
    text; turns are distinct within a conversation. `actions` and `action` may use these columns.

    While every turn number is below `chunk`, one window per conversation does it. Otherwise long
    conversations are cut into chunks of turns so that none of them has to fit in one task. The rows
    are the same either way. Turns without a number come first.
    """
    turns = turns.select(
        "conv_id", "turn", "role", "text",
        _as_array(actions).alias("_actions"),
        (F.lit(None).cast("string") if action is None else action).alias("_action"),
    )
    longest = turns.agg(F.max("turn")).first()[0]
    if longest is None or longest < chunk:
        rows = _windowed(turns, max_history)
    elif max_history is None:
        rows = _with_prefix(turns, chunk)
    else:
        rows = _with_halo(turns, max_history, max(chunk, max_history + 2))
    return _as_examples(rows, default_system, max_history, names)


def _as_array(actions: Column | Sequence[str]) -> Column:
    if isinstance(actions, Column):
        return actions
    return F.array(*[F.lit(a) for a in actions]).cast("array<string>")


def _turn_struct() -> Column:
    return F.struct("role", "text")


def _first_system(window) -> Column:
    text = F.when(F.col("role") == "system", F.col("text"))
    return F.first(text, ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, 0))


def _answers_user() -> Column:
    return (F.col("role") == "assistant") & (F.get("_before", F.size("_before") - 1)["role"] == "user")


def _windowed(turns: DataFrame, max_history: int | None) -> DataFrame:
    order = Window.partitionBy("conv_id").orderBy("turn")
    reach = Window.unboundedPreceding if max_history is None else -(max_history + 1)
    return turns.select(
        "*",
        F.collect_list(_turn_struct()).over(order.rowsBetween(reach, -1)).alias("_before"),
        _first_system(order).alias("system"),
    ).filter(_answers_user())


def _with_prefix(turns: DataFrame, chunk: int) -> DataFrame:
    """Full history of long conversations: earlier chunks as one array, the own chunk by window.

    A row carries its whole history, so a conversation is never longer than a row can hold; the
    chunk arrays of one conversation are therefore a bounded group.
    """
    number = F.call_function("div", F.col("turn"), F.lit(chunk))
    cut = turns.withColumn("_chunk", F.coalesce(number, F.lit(_FIRST_CHUNK)))
    order = Window.partitionBy("conv_id", "_chunk").orderBy("turn")
    local = cut.select(
        "*",
        F.collect_list(_turn_struct())
        .over(order.rowsBetween(Window.unboundedPreceding, -1))
        .alias("_inside"),
    ).filter(F.col("role") == "assistant")

    long_ids = cut.filter(F.col("_chunk") != 0).select(F.col("conv_id").alias("_long")).distinct()
    pieces = (
        cut.join(long_ids, F.col("conv_id").eqNullSafe(F.col("_long")), "left_semi")
        .groupBy("conv_id", "_chunk")
        .agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("_piece"))
    )
    earlier = Window.partitionBy("conv_id").orderBy("_chunk")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    prefixes = pieces.select(
        "conv_id", "_chunk", F.flatten(F.collect_list("_piece").over(earlier)).alias("_prefix")
    )
    nothing = F.array().cast("array<struct<role:string,text:string>>")
    prefix = F.transform("_prefix", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    joined = skew.left_join_null_safe(local, prefixes, ["conv_id", "_chunk"]).withColumn(
        "_before", F.concat(F.coalesce(prefix, nothing), "_inside")
    )
    systems = F.filter("_before", lambda t: (t["role"] == "system") & t["text"].isNotNull())
    return joined.filter(_answers_user()).withColumn("system", F.get(systems, F.lit(0))["text"])


def _with_halo(turns: DataFrame, max_history: int, chunk: int) -> DataFrame:
    """Bounded history of long conversations: each chunk also gets the turns just before it."""
    placed = scans.ordinal(turns, ["conv_id"], "turn", "turn", "_pos", task_rows=chunk * 1024)
    own = F.call_function("div", F.col("_pos"), F.lit(chunk))
    near_end = F.col("_pos") % chunk >= chunk - (max_history + 1)
    copies = F.when(near_end, F.array(own, own + 1)).otherwise(F.array(own))
    cut = placed.select("*", own.alias("_own"), F.explode(copies).alias("_chunk"))
    order = Window.partitionBy("conv_id", "_chunk").orderBy("_pos")
    rows = cut.select(
        "*",
        F.collect_list(_turn_struct()).over(order.rowsBetween(-(max_history + 1), -1)).alias("_before"),
    ).filter((F.col("_own") == F.col("_chunk")) & _answers_user())

    systems = (
        turns.filter((F.col("role") == "system") & F.col("text").isNotNull())
        .groupBy("conv_id")
        .agg(F.min(F.struct(F.col("turn").alias("_system_turn"), F.col("text").alias("_text"))).alias("_s"))
        .select("conv_id", "_s._system_turn", "_s._text")
    )
    earlier_system = F.when(F.col("_system_turn").isNull() | (F.col("_system_turn") < F.col("turn")), F.col("_text"))
    joined = skew.join_unique(rows, systems, "conv_id", "left", chunk * 1024, counted=turns)
    return joined.withColumn("system", earlier_system)


def _as_examples(
    rows: DataFrame, default_system: str | None, max_history: int | None, names: Mapping[str, str] | None
) -> DataFrame:
    size = F.size("_before")
    history = F.slice("_before", F.lit(1), size - 1)
    lines = F.transform(history, lambda t: history_line(t["role"], t["text"], names))
    return rows.select(
        "conv_id",
        "turn",
        F.coalesce("system", F.lit(default_system).cast("string")).alias("system"),
        F.struct(
            lines.alias("History"),
            F.col("_actions").alias("AvailableActions"),
            F.get("_before", size - 1)["text"].alias("UserInput"),
        ).alias("prompt"),
        F.struct(
            F.col("text").alias("MessageText"),
            F.struct(F.col("_action").alias("Action")).alias("Content"),
        ).alias("answer"),
    )
