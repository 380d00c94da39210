"""Which replies a chat message gets before the model answers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkloom import constants as C

ANSWER = "answer"


@dataclass(frozen=True)
class Notices:
    """Texts of the notices; all of them are parameters."""

    no_text: str = "notice: empty"
    wait: str = "notice: queued"
    busy: str = "notice: shared"
    too_long: str = "notice: refused"


def new_for_us(messages: DataFrame, new_type: str = "message_new") -> DataFrame:
    """F1. New messages that are addressed to us."""
    return messages.filter((F.col("type") == new_type) & F.col("to_me"))


def admission_class(text: Column) -> Column:
    """F2. empty, normal, long or too_long, by code points; both limits are still inside."""
    length = F.length(text)
    return (
        F.when(F.coalesce(length, F.lit(0)) == 0, F.lit("empty"))
        .when(length > C.REJECT_ABOVE, F.lit("too_long"))
        .when(length > C.WAIT_ABOVE, F.lit("long"))
        .otherwise(F.lit("normal"))
    )


def admit(messages: DataFrame, busy: Column | None = None, notices: Notices = Notices()) -> DataFrame:
    """R1. Add `admission` and `replies`, an array of (kind, text) in sending order.

    A too long message gets the wait notice, the busy notice if it applies, and the refusal, and is
    not answered. The text of the reply of kind "answer" is still to be generated. Row by row, so it
    works on a batch and on a stream.
    """
    klass = F.col("admission")
    over_wait = klass.isin("long", "too_long")
    occupied = F.lit(False) if busy is None else F.coalesce(busy, F.lit(False))

    def reply(condition: Column, kind: str, text: str | None) -> Column:
        value = F.struct(F.lit(kind).alias("kind"), F.lit(text).cast("string").alias("text"))
        return F.when(condition, value)

    options = F.array(
        reply(klass == "empty", "no_text", notices.no_text),
        reply(over_wait, "wait", notices.wait),
        reply((klass != "empty") & occupied, "busy", notices.busy),
        reply(klass == "too_long", "too_long", notices.too_long),
        reply(klass.isin("normal", "long"), ANSWER, None),
    )
    return messages.withColumn("admission", admission_class(F.col("text"))).withColumn(
        "replies", F.filter(options, lambda r: r.isNotNull())
    )


def replies(admitted: DataFrame) -> DataFrame:
    """R2. One row per reply, `reply_no` is its place in the message's sending order."""
    kept = [c for c in admitted.columns if c != "replies"]
    return admitted.select(*kept, F.posexplode("replies").alias("reply_no", "_r")).select(
        *kept, "reply_no", F.col("_r.kind").alias("kind"), F.col("_r.text").alias("reply")
    )
