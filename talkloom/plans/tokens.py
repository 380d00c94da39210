"""Registered queries: vocabulary, encoding, lengths, batches and steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talkloom import constants as C
from talkloom import session
from talkloom.functions import arrays as A
from talkloom.operators import batches as B
from talkloom.operators import tokens as T
from talkloom.plans import inputs as I
from talkloom.plans.flows import build_sft, chat_texts, training_rows
from talkloom.plans.records import SFT_SQL

VOCAB_SIZE = 2000
CUTOFF = C.CUTOFF_LEN
EOS_CUTOFF = C.OLDER_CUTOFF_LEN
CONTEXT = C.CONTEXT_IDS
CUTOFFS = (64, 512, 2048)
BUCKET_ROWS = 64


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.table(spark, sf_dir, "documents").select("doc_id", "lang", "text")


def _vocab(documents: DataFrame) -> T.Vocabulary:
    return T.build_vocab(documents, "text", VOCAB_SIZE)


def _joined(ids: Column) -> Column:
    return F.array_join(ids.cast("array<string>"), " ")


def _tokens_sql(text: str = "text") -> str:
    return f"regexp_extract_all({text}, '[^ \\n\\t\\r]+')"


def _vocab_sql(table: str, size: int = VOCAB_SIZE) -> str:
    return f"""
tokens AS (SELECT unnest({_tokens_sql()}) AS token FROM {table}),
counts AS (SELECT token, count(*) AS freq FROM tokens GROUP BY token ORDER BY freq DESC, token LIMIT {size}),
vocab AS (SELECT token, freq,
  CAST(row_number() OVER (ORDER BY freq DESC, token) - 1 + {len(T.SPECIALS)} AS BIGINT) AS token_id FROM counts)"""


# every text as the list of its ids, in order; texts without a token have an empty list
_ENCODED_SQL = f"""{_vocab_sql("documents")},
positions AS (SELECT doc_id, unnest({_tokens_sql()}) AS token, generate_subscripts({_tokens_sql()}, 1) AS pos
  FROM documents),
found AS (SELECT p.doc_id, list(coalesce(v.token_id, 0) ORDER BY p.pos) AS ids
  FROM positions p LEFT JOIN vocab v ON p.token = v.token GROUP BY p.doc_id),
encoded AS (SELECT d.doc_id, coalesce(f.ids, []) AS ids FROM documents d LEFT JOIN found f ON d.doc_id = f.doc_id)"""


def vocab_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _vocab(_documents(spark, sf_dir)).table
    return table.select("token", "freq", F.col("token_id").cast("bigint").alias("token_id"))


VOCAB_TOPK = f"WITH {_vocab_sql('documents')} SELECT token, freq, token_id FROM vocab"


def _encoded(spark: SparkSession, sf_dir: str, limit: int | None = None) -> tuple[DataFrame, T.Vocabulary]:
    documents = _documents(spark, sf_dir)
    vocab = _vocab(documents)
    return T.encode(documents, vocab, {"text": "ids"}, limit=limit), vocab


def encode_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded, _ = _encoded(spark, sf_dir)
    return encoded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_ids"), _joined(F.col("ids")).alias("ids")
    )


ENCODE_IDS = f"""WITH {_ENCODED_SQL}
SELECT doc_id, CAST(len(ids) AS BIGINT) AS n_ids, coalesce(array_to_string(ids, ' '), '') AS ids FROM encoded"""


def encode_padded(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut, vocab = _encoded(spark, sf_dir, CUTOFF)
    pad_id = vocab.special_id("<|pad|>")
    return cut.select(
        "doc_id",
        _joined(A.pad_right(F.col("ids"), CUTOFF, pad_id)).alias("input_ids"),
        _joined(A.attention_mask(F.col("ids"), CUTOFF)).alias("attention_mask"),
    )


ENCODE_PADDED = f"""WITH {_ENCODED_SQL},
cut AS (SELECT doc_id, ids[1:{CUTOFF}] AS ids FROM encoded)
SELECT doc_id,
  rtrim(concat(array_to_string(ids, ' '), CASE WHEN len(ids) = 0 THEN '' ELSE ' ' END,
    repeat('3 ', {CUTOFF} - len(ids)))) AS input_ids,
  rtrim(concat(repeat('1 ', len(ids)), repeat('0 ', {CUTOFF} - len(ids)))) AS attention_mask
FROM cut"""


def train_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From turns to padded ids in one plan: examples, records, chat texts, ids."""
    texts = chat_texts(build_sft(I.examples(spark, sf_dir))).select("example_id", "text")
    vocab = T.build_vocab(I.table(spark, sf_dir, "conversations"), "text", VOCAB_SIZE)
    rows = training_rows(texts, vocab, CUTOFF)
    return rows.select(
        "example_id",
        _joined(F.col("input_ids")).alias("input_ids"),
        _joined(F.col("attention_mask")).alias("attention_mask"),
    )


TRAIN_ROWS = f"""WITH {SFT_SQL}, {_vocab_sql("conversations")},
chats AS (SELECT example_id, concat('<s>system', chr(10), system, '</s><s>user', chr(10), "user", '</s><s>bot',
  chr(10), bot, '</s>') AS txt FROM sft),
positions AS (SELECT example_id, unnest({_tokens_sql("txt")}) AS token,
  generate_subscripts({_tokens_sql("txt")}, 1) AS pos FROM chats),
found AS (SELECT p.example_id, list(coalesce(v.token_id, 0) ORDER BY p.pos) AS ids
  FROM positions p LEFT JOIN vocab v ON p.token = v.token GROUP BY p.example_id),
cut AS (SELECT example_id, ids[1:{CUTOFF}] AS ids FROM found)
SELECT example_id,
  rtrim(concat(array_to_string(ids, ' '), ' ', repeat('3 ', {CUTOFF} - len(ids)))) AS input_ids,
  rtrim(concat(repeat('1 ', len(ids)), repeat('0 ', {CUTOFF} - len(ids)))) AS attention_mask
FROM cut"""


def encode_eos_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut, vocab = _encoded(spark, sf_dir, EOS_CUTOFF)
    ids = A.append_eos(F.col("ids"), vocab.special_id("</s>"), EOS_CUTOFF)
    ended = cut.select("doc_id", ids.alias("ids"))
    return ended.select(
        "doc_id",
        _joined(F.col("ids")).alias("input_ids"),
        F.size(A.attention_mask(F.col("ids"), 0)).cast("bigint").alias("mask_ones"),
        _joined(F.col("ids")).alias("labels"),
    )


ENCODE_EOS_LABELS = f"""WITH {_ENCODED_SQL},
cut AS (SELECT doc_id, ids[1:{EOS_CUTOFF}] AS ids FROM encoded),
ended AS (SELECT doc_id, CASE WHEN len(ids) < {EOS_CUTOFF} AND (len(ids) = 0 OR ids[-1] <> 2)
  THEN list_concat(ids, [2]) ELSE ids END AS ids FROM cut)
SELECT doc_id, array_to_string(ids, ' ') AS input_ids, CAST(len(ids) AS BIGINT) AS mask_ones,
  array_to_string(ids, ' ') AS labels
FROM ended"""


def context_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = I.table(spark, sf_dir, "conversations")
    vocab = T.build_vocab(turns, "text", VOCAB_SIZE)
    pairs = I.examples(spark, sf_dir, max_history=0).select("example_id", "system", F.col("prompt.UserInput").alias("user"))
    made = T.encode_context(pairs, vocab, "system", "user", CONTEXT)
    return made.select(
        "example_id",
        F.col("n_tokens").cast("bigint").alias("n_tokens"),
        "over_context",
        _joined(F.col("context")).alias("context"),
    )


CONTEXT_TAIL = f"""WITH {I.EXAMPLES_SQL}, {_vocab_sql("conversations")},
sides AS (SELECT example_id, 1 AS side, system AS txt FROM examples
  UNION ALL SELECT example_id, 2, user_input FROM examples),
positions AS (SELECT example_id, side, unnest({_tokens_sql("txt")}) AS token,
  generate_subscripts({_tokens_sql("txt")}, 1) AS pos FROM sides),
found AS (SELECT p.example_id,
    coalesce(list(coalesce(v.token_id, 0) ORDER BY p.pos) FILTER (WHERE p.side = 1), []) AS s,
    coalesce(list(coalesce(v.token_id, 0) ORDER BY p.pos) FILTER (WHERE p.side = 2), []) AS u
  FROM positions p LEFT JOIN vocab v ON p.token = v.token GROUP BY p.example_id),
whole AS (SELECT example_id, list_concat(list_concat(list_concat([1, 1788, 13], s), list_concat([2], [1, 1404, 13])),
  list_concat(u, [2, 1, 9225, 13])) AS ids FROM found)
SELECT example_id, CAST(len(ids) AS BIGINT) AS n_tokens, len(ids) > {CONTEXT} AS over_context,
  array_to_string(CASE WHEN len(ids) > {CONTEXT} THEN ids[len(ids) - {CONTEXT} + 1 : len(ids)] ELSE ids END, ' ')
    AS context
FROM whole"""


def _lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    length = F.size(T.tokens_of(F.col("text"))).cast("bigint")
    return _documents(spark, sf_dir).select("doc_id", "lang", length.alias("length"))


_LENGTHS_SQL = f"lengths AS (SELECT doc_id, lang, CAST(len({_tokens_sql()}) AS BIGINT) AS length FROM documents)"


def length_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.length_profile(_lengths(spark, sf_dir), "length", CUTOFFS, by=["lang"])


LENGTH_PROFILE = f"""WITH {_LENGTHS_SQL}
SELECT lang, count(*) AS n_rows, min(length) AS min_len, max(length) AS max_len,
  CAST(sum(length) AS BIGINT) AS sum_len, quantile_cont(CAST(length AS DOUBLE), 0.25) AS p25,
  quantile_cont(CAST(length AS DOUBLE), 0.5) AS p50, quantile_cont(CAST(length AS DOUBLE), 0.75) AS p75,
  {", ".join(f"count(*) FILTER (WHERE length > {c}) AS over_{c}" for c in CUTOFFS)}
FROM lengths GROUP BY lang"""


def _batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = _lengths(spark, sf_dir).select("doc_id", "length")
    return B.length_batches(lengths, "doc_id", "length", B.range_bucket("doc_id", BUCKET_ROWS))


def length_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rank = F.col("rank").cast("bigint").alias("rank")
    return _batches(spark, sf_dir).select("doc_id", "length", "bucket", rank, "batch")


_BATCHES_SQL = f"""{_LENGTHS_SQL},
bucketed AS (SELECT doc_id, length, CAST(doc_id // {BUCKET_ROWS} AS BIGINT) AS bucket FROM lengths),
ranked AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY length DESC, doc_id) - 1 AS rank FROM bucketed),
batches AS (SELECT doc_id, length, bucket, rank, CAST(rank // 2 AS BIGINT) AS batch FROM ranked)"""

LENGTH_BATCHES = f"WITH {_BATCHES_SQL} SELECT doc_id, length, bucket, rank, batch FROM batches"


def step_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = B.step_plan(_batches(spark, sf_dir), "length")
    return plan.select(
        "bucket", "batch", "n_rows", "max_len", "sum_len", "batch_no", "step", "logs", "evaluates"
    )


STEP_PLAN = f"""WITH {_BATCHES_SQL},
summary AS (SELECT bucket, batch, count(*) AS n_rows, max(length) AS max_len, CAST(sum(length) AS BIGINT) AS sum_len
  FROM batches GROUP BY bucket, batch),
numbered AS (SELECT *, row_number() OVER (ORDER BY bucket, batch) - 1 AS batch_no FROM summary),
steps AS (SELECT *, CAST(batch_no // 4 + 1 AS BIGINT) AS step FROM numbered)
SELECT bucket, batch, n_rows, max_len, sum_len, batch_no, step, step % 5 = 0 AS logs, step % 20 = 0 AS evaluates
FROM steps"""

SHUFFLE_SEED = 42


def grouped_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in a seeded, length-grouped epoch."""
    lengths = session.materialize(_lengths(spark, sf_dir).select("doc_id", "length"))
    n = (lengths.agg(F.max("doc_id")).first()[0] or 0) + 1
    return B.grouped_batches(lengths, "doc_id", "length", n, SHUFFLE_SEED)


def _shuffle_sql() -> str:
    steps = ["swap0 AS (SELECT doc_id, length, doc_id AS x, max(doc_id) OVER () + 1 AS n FROM lengths)"]
    for r, key in enumerate(B._round_keys(SHUFFLE_SEED, B.SHUFFLE_ROUNDS)):
        other = f"(({key} % n) - x + n) % n"
        steps.append(
            f"swap{r + 1} AS (SELECT doc_id, length, CASE WHEN md5(concat('{SHUFFLE_SEED}:{r}:', greatest(x, {other})))[1] >= '8' THEN {other} ELSE x END AS x, n FROM swap{r})"
        )
    return ", ".join(steps)


GROUPED_BATCHES = f"""WITH {_LENGTHS_SQL}, {_shuffle_sql()},
placed AS (SELECT doc_id, length, CAST(x AS BIGINT) AS shuffled, CAST(x // {2 * B.MEGA_BATCHES} AS BIGINT) AS mega_batch FROM swap{B.SHUFFLE_ROUNDS}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY mega_batch ORDER BY length DESC, shuffled) - 1 AS rank FROM placed)
SELECT *, CAST(mega_batch * {B.MEGA_BATCHES} + rank // 2 AS BIGINT) AS batch FROM ranked"""

QUERIES = {
    "grouped_batches": (grouped_batches, GROUPED_BATCHES),
    "vocab_topk": (vocab_topk, VOCAB_TOPK),
    "encode_ids": (encode_ids, ENCODE_IDS),
    "encode_padded": (encode_padded, ENCODE_PADDED),
    "train_rows": (train_rows, TRAIN_ROWS),
    "encode_eos_labels": (encode_eos_labels, ENCODE_EOS_LABELS),
    "context_tail": (context_tail, CONTEXT_TAIL),
    "length_profile": (length_profile, LENGTH_PROFILE),
    "length_batches": (length_batches, LENGTH_BATCHES),
    "step_plan": (step_plan, STEP_PLAN),
}
