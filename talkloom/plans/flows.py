"""Whole jobs made of the operators: training rows, and an evaluation run."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkloom import constants as C
from talkloom import session
from talkloom.functions import arrays as A
from talkloom.functions import prompts as P
from talkloom.operators import scoring as S
from talkloom.operators import tokens as T
from talkloom.operators.inference import Client, generate
from talkloom.sinks.tables import write_report


def build_sft(
    examples: DataFrame, template: P.PromptTemplate = P.PromptTemplate(), target: str = "json"
) -> DataFrame:
    """P5. system, user and bot next to the other columns of the examples."""
    kept = [c for c in examples.columns if c not in ("system", "prompt", "answer")]
    user = P.render_user_prompt(
        template, F.col("prompt.History"), F.col("prompt.AvailableActions"), F.col("prompt.UserInput")
    )
    bot = P.answer_target(F.col("answer.MessageText"), F.col("answer.Content.Action"), target)
    return examples.select(*kept, "system", user.alias("user"), bot.alias("bot"))


def chat_texts(records: DataFrame, template: P.ChatTemplate = P.ROLE_TAGS) -> DataFrame:
    """P6, P7. Records as one chat text each, in column `text`."""
    kept = [c for c in records.columns if c not in ("system", "user", "bot")]
    messages = P.to_messages(system=F.col("system"), user=F.col("user"), assistant=F.col("bot"))
    return records.select(*kept, P.apply_chat_template(messages, template).alias("text"))


def training_rows(
    texts: DataFrame, vocab: T.Vocabulary, cutoff: int = C.CUTOFF_LEN, pad: str = C.PAD_TOKEN
) -> DataFrame:
    """T2-T4. input_ids of exactly `cutoff` ids and their attention_mask, no shuffle of the texts.

    The text is marked by its chat template, so no special id is added again.
    """
    kept = [c for c in texts.columns if c != "text"]
    cut = T.encode(texts, vocab, {"text": "_ids"}, limit=cutoff)
    return cut.select(
        *kept,
        A.pad_right(F.col("_ids"), cutoff, vocab.special_id(pad)).alias("input_ids"),
        A.attention_mask(F.col("_ids"), cutoff).alias("attention_mask"),
    )


def evaluate(
    requests: DataFrame,
    make_client: Callable[[], Client],
    path: str,
    scorers: Sequence[S.Scorer] = (S.ACTION,),
    batch_size: int = 32,
) -> DataFrame:
    """M1, A3, K3. Ask the model once per request, run every scorer on the same responses, report.

    `requests` has example_id, prompt, expected_action and expected_answer. Responses are written
    before they are scored: no scorer, failure or repeated stage asks the model again. Returns the
    metrics per suite; `path` then holds responses, results and summary.
    """
    spark = session.prepare(requests.sparkSession)
    generated = generate(requests, make_client, "prompt", batch_size)
    generated.write.mode("overwrite").parquet(f"{path}/responses")
    responses = spark.read.schema(generated.schema).parquet(f"{path}/responses")
    scored = S.run_scorers(S.parse_responses(responses, "response", "expected_answer"), scorers)
    suites = F.array(*[F.struct(F.lit(s.name).alias("suite"), F.col(s.name).alias("r")) for s in scorers])
    results = scored.select("example_id", "prompt", "response", "error", "expected_action", F.inline(suites))
    write_report(
        results.select(
            "example_id", "suite", "prompt", "expected_action", "response", "error", "r.passed", "r.reason"
        ),
        path,
    )
    return spark.read.parquet(f"{path}/summary")
