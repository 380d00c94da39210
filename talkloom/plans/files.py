"""Registered queries that go through files and streams: dialogue files, prompt arrays, parallel text, message streams."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkloom import session
from talkloom.operators import admission
from talkloom.plans import inputs as I
from talkloom.plans.flows import build_sft
from talkloom.plans.messages import BUSY_AT_ARRIVAL, MESSAGES_REPLIES, busy_requests, messages, replies_sql
from talkloom.plans.records import SFT_SQL
from talkloom.sinks.tables import write_prompt_array
from talkloom.sources import dialogues, nested
from talkloom.sources import messages as inbox
from talkloom.streaming import messages as streams
from talkloom.streaming.busy_state import busy_state

#: Turn numbers that one dialogue document spans, so that a long conversation is several documents.
DOCUMENT_TURNS = 256
#: Parts in which the requests of stream_busy arrive.
ARRIVALS = 4
#: Keys that the one endpoint of stream_busy_state is cut into at least, and requests of a key at most, on average.
CELLS, CELL_ROWS = 4, 100_000
#: Tasks that read a document at least, if their blocks hold between LEAST_BLOCK and MOST_BLOCK bytes; and its system text.
DOCUMENT_TASKS, LEAST_BLOCK, MOST_BLOCK = 16, 1 << 16, 128 << 20
DOCUMENT_HEAD = 'say "yes", or \\ "examples": ['
_QUOTED_HEAD = json.dumps(DOCUMENT_HEAD)
SHOT = ("a long line", "a line")
TASK = "Write the answer."


def dialogue_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, part and value: the examples of some turns as one JSON document, in both shapes."""
    part = F.call_function("div", F.col("turn"), F.lit(DOCUMENT_TURNS))
    example = F.struct("turn", "example_id", F.struct("prompt", "answer").alias("example"))
    documents = (
        I.examples(spark, sf_dir)
        .groupBy("conv_id", part.alias("part"))
        .agg(F.min("system").alias("system"), F.array_sort(F.collect_list(example)).alias("e"))
    )
    by_id = F.map_from_entries(F.transform("e", lambda x: F.struct(x["example_id"], x["example"])))
    as_map = F.to_json(F.struct("system", by_id.alias("examples")))
    as_array = F.to_json(F.struct("system", F.col("e.example").alias("examples")))
    return documents.select("conv_id", "part", F.when(F.col("conv_id") % 2 == 0, as_map).otherwise(as_array).alias("value"))


def dialogues_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dialogue documents in both shapes, written as a file each and read back in source order.

    A document names its conversation itself, so that its file needs no folder of its own: each task writes a folder of files, and puts them
    in their place when it ends.
    """
    folder = session.shared_dir(spark)
    named = F.concat(F.lit('{"conv_id":'), F.coalesce(F.col("conv_id").cast("string"), F.lit("null")), F.lit(","), F.substr("value", F.lit(2)))
    files = dialogue_documents(spark, sf_dir).select(F.spark_partition_id().alias("task"), named.alias("value"))
    files.write.partitionBy("task").options(**{"maxRecordsPerFile": 1, "mapreduce.fileoutputcommitter.algorithm.version": 2}).text(folder)
    return dialogues.read_dialogues(spark, folder, fields=T.StructType([T.StructField("conv_id", T.LongType())])).select(
        "conv_id",
        "system",
        F.col("pos").cast("bigint").alias("pos"),
        "example_id",
        F.col("prompt.UserInput").alias("user_input"),
        F.size("prompt.History").cast("bigint").alias("n_history"),
        F.col("answer.MessageText").alias("message_text"),
        F.col("answer.Content.Action").alias("action"),
    )


DIALOGUES_ROUNDTRIP = f"""WITH {I.EXAMPLES_SQL},
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn // {DOCUMENT_TURNS} ORDER BY turn) - 1 AS pos FROM examples)
SELECT conv_id, system, pos, CASE WHEN conv_id % 2 = 0 THEN example_id ELSE CAST(pos AS VARCHAR) END AS example_id,
  user_input, CAST(len(history) AS BIGINT) AS n_history, message_text, action
FROM placed"""


def document_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations as two documents, an object of examples and an array, each read by many tasks."""
    made = I.examples(spark, sf_dir).select(
        "example_id", "conv_id", "turn", F.to_json(F.struct("prompt", "answer")).alias("value"), (F.col("conv_id") % 2 == 0).alias("keyed")
    )
    first = made.groupBy("keyed").agg(F.min(F.struct("conv_id", "turn")).alias("first"))
    examples = made.join(F.broadcast(first), "keyed").select(
        "keyed", F.lit(1).alias("part"), "conv_id", "turn",
        F.concat(
            F.when(F.struct("conv_id", "turn") == F.col("first"), F.lit("")).otherwise(F.lit(",")),
            F.when(F.col("keyed"), F.concat(F.to_json(F.array("example_id")).substr(F.lit(2), F.length("example_id") + 2), F.lit(":"))).otherwise(F.lit("")),
            "value",
        ).alias("value"),
    )
    head = F.concat(F.lit('{"system":'), F.lit(_QUOTED_HEAD), F.lit(', "examples": '), F.when(F.col("keyed"), F.lit("{")).otherwise(F.lit("[")))
    edge = lambda part, value: first.select("keyed", F.lit(part).alias("part"), *(F.lit(0).cast("bigint").alias(c) for c in ("conv_id", "turn")), value.alias("value"))
    tail = F.when(F.col("keyed"), F.lit("}}")).otherwise(F.lit("]}"))
    lines = edge(0, head).unionByName(examples).unionByName(edge(2, tail))
    folders = {}
    for keyed in (True, False):
        folders[keyed] = session.shared_dir(spark)
        mine = lines.filter(F.col("keyed") == keyed).orderBy("part", "conv_id", "turn").select("value")
        mine.coalesce(1).write.text(folders[keyed])
    total = made.agg(F.sum(F.octet_length("value"))).first()[0] or 0
    block = min(MOST_BLOCK, max(LEAST_BLOCK, total // (2 * DOCUMENT_TASKS)))
    both = [nested.read_document(spark, folder, block_bytes=block).withColumn("keyed", F.lit(keyed)) for keyed, folder in folders.items()]
    return both[0].unionByName(both[1]).select(
        "keyed", "system", F.col("pos").cast("bigint").alias("pos"), "example_id",
        F.col("prompt.UserInput").alias("user_input"), F.size("prompt.History").cast("bigint").alias("n_history"),
        F.col("answer.MessageText").alias("message_text"), F.col("answer.Content.Action").alias("action"),
    )


DOCUMENT_ROUNDTRIP = f"""WITH {I.EXAMPLES_SQL},
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id % 2 = 0 ORDER BY conv_id, turn) - 1 AS pos FROM examples)
SELECT conv_id % 2 = 0 AS keyed, {I.quote(DOCUMENT_HEAD)} AS system, pos,
  CASE WHEN conv_id % 2 = 0 THEN example_id ELSE CAST(pos AS VARCHAR) END AS example_id,
  user_input, CAST(len(history) AS BIGINT) AS n_history, message_text, action
FROM placed"""


def prompt_array_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2, S3: all records as one JSON array in parts, read back."""
    sft = build_sft(I.examples(spark, sf_dir))
    folder = session.shared_dir(spark)
    write_prompt_array(sft, folder, ["conv_id", "turn"], ["system", "user", "bot"])
    return dialogues.read_prompt_parts(spark, folder)


PROMPT_ARRAY_ROUNDTRIP = f'WITH {SFT_SQL} SELECT system, "user", bot FROM sft'


def pairs_to_sft(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Question and answer as one line each of parallel text, read back, as records."""
    one_line = lambda text: F.regexp_replace(F.coalesce(text, F.lit("")), r"[\r\n]+", " ")
    pairs = I.examples(spark, sf_dir, max_history=0).select(
        one_line(F.col("answer.MessageText")).alias("translated"), one_line(F.col("prompt.UserInput")).alias("original")
    )
    folder = session.shared_dir(spark)
    kept = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    pairs.write.options(sep="|", header="true", quoteAll="true", **kept).csv(folder)
    return dialogues.pairs_to_sft(dialogues.read_pairs(spark, folder), SHOT, TASK, "rewrite")


PAIRS_TO_SFT = rf"""WITH {I.EXAMPLES_SQL},
lines AS (SELECT regexp_replace(coalesce(user_input, ''), '[\r\n]+', ' ', 'g') AS original,
  regexp_replace(coalesce(message_text, ''), '[\r\n]+', ' ', 'g') AS translated FROM examples)
SELECT 'rewrite' AS system, translated AS bot, concat({I.quote(f"pair: '{SHOT[0]}' -> '{SHOT[1]}'")}, chr(10), 'source: [',
  original, ']', chr(10), {I.quote(TASK)}) AS "user" FROM lines"""


def _inbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All turns as a stream of admitted messages."""
    folder = session.shared_dir(spark)
    sent = messages(spark, sf_dir)
    sent.write.parquet(folder)
    return admission.admit(inbox.read_messages(spark, folder, sent.schema), busy=F.col("turn") == 0)


def _sent(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(folder).select(
        "conv_id", "turn", F.col("reply_no").cast("bigint").alias("reply_no"), "kind", "reply"
    )


def stream_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The replies to a stream of messages, as a table."""
    out, state = session.shared_dir(spark), session.shared_dir(spark)
    streams.write_replies(_inbox(spark, sf_dir), out, state).awaitTermination()
    return _sent(spark, out)


def stream_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with generated answers, here by a stand-in for a model."""

    def make_client():
        return lambda texts: [f"answer to {len(t)} characters" for t in texts]

    out, state = session.shared_dir(spark), session.shared_dir(spark)
    streams.answer_stream(_inbox(spark, sf_dir), make_client, out, state).awaitTermination()
    return _sent(spark, out)


STREAM_ANSWERS = replies_sql("concat('answer to ', length(text), ' characters')")


def stream_busy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Busy flags of requests that arrive in parts, each part a micro-batch with the state of the one before."""
    requests = busy_requests(spark, sf_dir)
    shares = [i / ARRIVALS for i in range(1, ARRIVALS)]
    cuts = requests.agg(F.percentile_approx("start_us", shares)).first()[0] or []
    borders = [None, *sorted(set(cuts)), None]
    folder, out, state = (session.shared_dir(spark) for _ in range(3))
    for low, high in zip(borders, borders[1:], strict=False):
        part = requests if low is None else requests.filter(F.col("start_us") >= low)
        part = part if high is None else part.filter(F.col("start_us") < high)
        part.write.mode("append").parquet(folder)
        arrived = spark.readStream.schema(requests.schema).parquet(folder)
        flagged = streams.busy_stream(arrived, out, state, "endpoint", "user_id", "start_us", "finish_us", "event_id")
        flagged.awaitTermination()
    return spark.read.parquet(out).select("event_id", "user_id", "start_us", "finish_us", "busy")


def stream_busy_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same flags from a stream in shuffled order: every other request comes one part late, the latest first."""
    requests = busy_requests(spark, sf_dir)
    shares = [i / ARRIVALS for i in range(ARRIVALS + 1)]
    cuts, number_of = requests.agg(F.percentile_approx("start_us", shares), F.count(F.lit(1))).first()
    cuts, cells = cuts or [0], max(CELLS, -(-number_of // CELL_ROWS))
    part = F.size(F.filter(F.lit(cuts[1:-1]), lambda c: c <= F.col("start_us"))) + F.pmod(F.xxhash64("event_id"), F.lit(2))
    # a request can come behind one that starts up to two parts after it
    delay_us = 2 * max([b - a for a, b in zip(cuts, cuts[1:], strict=False)] or [0]) + 1_000_000
    columns = ["event_id", "user_id", "endpoint", "start_us", "finish_us"]
    folder, out, state = (session.shared_dir(spark) for _ in range(3))

    def run() -> None:
        arrived = spark.readStream.schema(requests.select(*columns).schema).parquet(folder)
        flagged = busy_state(arrived, "endpoint", "user_id", "start_us", "finish_us", "event_id", f"{delay_us} microseconds", cells)
        sink = flagged.writeStream.format("parquet").option("checkpointLocation", state).trigger(availableNow=True)
        sink.start(out).awaitTermination()

    for number in range(ARRIVALS + 1):
        coming = requests.filter(part == number).select(*columns)
        coming.orderBy(F.col("start_us").desc()).write.mode("append").parquet(folder)
        run()
    # a row of no endpoint that never runs moves the clock past all requests
    clock = requests.agg((F.max("start_us") + 2 * delay_us).alias("start_us")).filter("start_us IS NOT NULL")
    clock.select(*[F.col(c) if c == "start_us" else F.lit(None if c in ("endpoint", "finish_us") else 0).cast(requests.schema[c].dataType).alias(c) for c in columns]).write.mode("append").parquet(folder)
    run()
    return spark.read.parquet(out).filter("endpoint IS NOT NULL").select("event_id", "user_id", "start_us", "finish_us", "busy")


QUERIES = {
    "dialogues_roundtrip": (dialogues_roundtrip, DIALOGUES_ROUNDTRIP),
    "document_roundtrip": (document_roundtrip, DOCUMENT_ROUNDTRIP),
    "prompt_array_roundtrip": (prompt_array_roundtrip, PROMPT_ARRAY_ROUNDTRIP),
    "pairs_to_sft": (pairs_to_sft, PAIRS_TO_SFT),
    "stream_replies": (stream_replies, MESSAGES_REPLIES),
    "stream_answers": (stream_answers, STREAM_ANSWERS),
    "stream_busy": (stream_busy, BUSY_AT_ARRIVAL),
    "stream_busy_state": (stream_busy_state, BUSY_AT_ARRIVAL),
}
