"""Registered queries that are whole jobs: from dialogue files to training rows, and from requests to the metrics of a report."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkloom import session
from talkloom.functions import arrays as A
from talkloom.operators import tokens as T
from talkloom.operators.inference import build_requests
from talkloom.plans import evaluation, flows, tokens
from talkloom.plans import inputs as I
from talkloom.plans.files import dialogue_documents
from talkloom.plans.records import SFT_SQL
from talkloom.sinks.tables import write_jsonl
from talkloom.sources import dialogues

#: Every so many conversations, one is for validation.
HELD_OUT = 10
#: The cutoff as a settings file may have it; it stands for the model's own limit.
LIMIT = "None"


def train_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dialogue documents in files, records in files as splits, a vocabulary of the training
    split, and rows of ids of both splits. Files hold many documents or records each, one a line."""
    documents = dialogue_documents(spark, sf_dir).select("value", (F.pmod("conv_id", F.lit(HELD_OUT)) == 0).alias("held_out"))
    read, records = session.shared_dir(spark), {}
    documents.write.partitionBy("held_out").text(read)
    for split, held_out in (("train", "false"), ("validation", "true")):
        records[split] = session.shared_dir(spark)
        examples = dialogues.read_dialogue_lines(spark, f"{read}/held_out={held_out}")
        write_jsonl(flows.build_sft(examples).select("system", "user", "bot"), records[split])
    texts = flows.chat_texts(dialogues.read_sft(spark, records))
    vocab = T.build_vocab(texts.filter(F.col("split") == "train"), "text", tokens.VOCAB_SIZE)
    rows = flows.training_rows(texts, vocab, A.limit_or_model(LIMIT, tokens.CUTOFF))
    joined = [F.array_join(F.col(c).cast("array<string>"), " ").alias(c) for c in ("input_ids", "attention_mask")]
    return rows.select("split", *joined)


TRAIN_JOB = f"""WITH {SFT_SQL},
chats AS (SELECT row_number() OVER () AS n, CASE WHEN conv_id % {HELD_OUT} = 0 THEN 'validation' ELSE 'train' END AS split,
  concat('<s>system', chr(10), system, '</s><s>user', chr(10), "user", '</s><s>bot', chr(10), bot, '</s>') AS text FROM sft),
learnt AS (SELECT text FROM chats WHERE split = 'train'),
{tokens._vocab_sql("learnt").strip()},
positions AS (SELECT n, unnest({tokens._tokens_sql()}) AS token, generate_subscripts({tokens._tokens_sql()}, 1) AS pos FROM chats),
found AS (SELECT p.n, list(coalesce(v.token_id, 0) ORDER BY p.pos)[1:{tokens.CUTOFF}] AS ids
  FROM positions p LEFT JOIN vocab v ON p.token = v.token GROUP BY p.n)
SELECT split, rtrim(concat(array_to_string(ids, ' '), ' ', repeat('3 ', {tokens.CUTOFF} - len(ids)))) AS input_ids,
  rtrim(concat(repeat('1 ', len(ids)), repeat('0 ', {tokens.CUTOFF} - len(ids)))) AS attention_mask
FROM chats JOIN found USING (n)"""


def _answering():
    """A stand-in for a model: it says what the user's message holds."""

    def call(requests: list[str]) -> list[str | None]:
        return [next((m.get("content") for m in json.loads(r) if m["role"] == "user"), None) for r in requests]

    return call


def eval_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request messages, one answer each, every suite over the same answers, results and summary in files."""
    request = F.to_json(build_requests(F.col("response"), F.lit("Answer.")))
    requests = I.responses(spark, sf_dir).select("example_id", request.alias("prompt"), "expected_action", "expected_answer")
    return flows.evaluate(requests, _answering, session.shared_dir(spark), evaluation.SUITES)


EVAL_JOB = evaluation.SUITE_METRICS

QUERIES = {"train_job": (train_job, TRAIN_JOB), "eval_job": (eval_job, EVAL_JOB)}
