"""Model calls as a batch job (M1) and their request messages."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkloom.functions import prompts

Client = Callable[[list[str]], Sequence["str | None"]]

NO_CHOICE = "no choice returned"


def build_requests(user: Column, system: Column | None = None, schema_text: str | None = None) -> Column:
    """P11. Messages of a request; the answer schema may be part of the system message."""
    if schema_text is not None:
        head = F.lit("") if system is None else F.concat(system, F.lit(" "))
        system = F.concat(head, F.lit("Answer with JSON of this schema: " + schema_text))
    return prompts.to_messages(user=user) if system is None else prompts.to_messages(system=system, user=user)


def paced(client: Client, gap_seconds: float) -> Client:
    """M2. The client, called at most once in `gap_seconds`; the first call does not wait."""
    last = float("-inf")

    def call(texts: list[str]) -> Sequence[str | None]:
        nonlocal last
        time.sleep(max(0.0, last + gap_seconds - time.monotonic()))
        last = time.monotonic()
        return client(texts)

    return call


def generate(
    df: DataFrame,
    make_client: Callable[[], Client],
    prompt: str = "prompt",
    batch_size: int = 32,
    tasks: int | None = None,
    gap_seconds: float = 0.0,
) -> DataFrame:
    """M1. Add `response` (stripped) and `error`; a failing prompt does not fail the others.

    `make_client` runs once per task. Only the prompt column goes to Python. A batch that fails is
    repeated one prompt at a time. `tasks` deals the prompts out to that many clients; each of them
    waits until `gap_seconds` have passed since its last call.
    """
    df = df if tasks is None else df.repartition(tasks)

    def one_by_one(client: Client, texts: list[str]) -> Iterator[tuple[str | None, str | None]]:
        for text in texts:
            try:
                yield from answers(client([text]), 1)
            except Exception as failure:
                yield None, f"{type(failure).__name__}: {failure}"

    def answers(replies: Sequence[str | None], wanted: int) -> list[tuple[str | None, str | None]]:
        replies = list(replies)
        if len(replies) != wanted:
            raise RuntimeError(f"{len(replies)} replies for {wanted} prompts")
        return [(None, NO_CHOICE) if r is None else (r.strip(), None) for r in replies]

    def run(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        client = paced(make_client(), gap_seconds)
        for texts in series:
            rows: list[tuple[str | None, str | None]] = []
            for begin in range(0, len(texts), batch_size):
                part = texts.iloc[begin : begin + batch_size].tolist()
                try:
                    rows += answers(client(part), len(part))
                except Exception:
                    rows += one_by_one(client, part)
            yield pd.DataFrame(rows, columns=["response", "error"], dtype=object)

    called = F.pandas_udf(run, "struct<response:string,error:string>").asNondeterministic()
    with_reply = df.withColumn("_reply", called(prompt))
    return with_reply.select("*", "_reply.response", "_reply.error").drop("_reply")
