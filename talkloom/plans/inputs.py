"""Tables the registered queries start from, and the same as SQL text.

The given tables hold neither actions nor model responses. Both are derived from every row of
`conversations` by the same rule in Spark and in SQL, so their number grows with the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkloom import session
from talkloom.functions.prompts import PromptTemplate
from talkloom.operators.dialogs import expand_dialogs

TEMPLATE = PromptTemplate()
DEFAULT_SYSTEM = "default system"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return session.prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def micros(column: str):
    """Microseconds of a zone-less timestamp read as UTC, whatever the session's zone."""
    return F.unix_micros(F.from_utc_timestamp(F.col(column).cast("timestamp"), F.current_timezone()))


def _action():
    n = (F.col("conv_id") + F.col("turn")) % 3
    return F.when(n == 0, F.lit("Talk")).when(n == 1, F.lit("Open Door")).otherwise(F.lit("Lights Off"))


def _actions():
    n = F.col("conv_id") % 3
    return (
        F.when(n == 0, F.array().cast("array<string>"))
        .when(n == 1, F.array(F.lit("Open Door")))
        .otherwise(F.array(F.lit("Open Door"), F.lit("Captain's Log")))
    )


def _id():
    return F.concat_ws("-", "conv_id", "turn").alias("example_id")


def _escaped(text):
    """A text as it stands between the quotes of a JSON string."""
    whole = F.to_json(F.struct(text.alias("t")))
    return F.substring(whole, F.lit(7), F.length(whole) - 8)


def examples(spark: SparkSession, sf_dir: str, max_history: int | None = None) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    made = expand_dialogs(turns, _actions(), _action(), DEFAULT_SYSTEM, max_history)
    return made.select(_id(), "*")


def responses(spark: SparkSession, sf_dir: str, shifts: tuple[int, ...] = (0,)) -> DataFrame:
    """Responses per assistant turn, going through every way a response can be right or wrong.

    The message of a response is the whole text of its turn.

    One response per shift; `g` numbers them.
    """
    turns = table(spark, sf_dir, "conversations").filter(F.col("role") == "assistant")
    samples = turns.select("*", F.posexplode(F.array(*[F.lit(s) for s in shifts])).alias("g", "shift"))
    named = samples.select(
        _id(),
        F.col("g").cast("bigint").alias("g"),
        ((F.col("conv_id") * 31 + F.col("turn") + F.col("shift")) % 16).alias("k"),
        _action().alias("expected_action"),
        _escaped(F.coalesce("text", F.lit(""))).alias("m"),
    )
    a, m, k = F.col("expected_action"), F.col("m"), F.col("k")
    text = F.concat(F.lit('{"MessageText":"'), m, F.lit('","Content":'))
    good = F.concat(text, F.lit('{"Action":"'), a, F.lit('"}}'))
    made = (
        F.when(k <= 3, good)
        .when(k == 4, F.concat(text, F.lit('{"Action":"'), a, F.lit('"},"Extra":1}')))
        .when(k == 5, F.concat(text, F.lit('{"Action":"Other"}}')))
        .when(k == 6, F.concat(F.lit("Sure: "), good, F.lit(" done")))
        .when(k == 7, F.replace(good, F.lit('"'), F.lit("'")))
        .when(k == 8, F.concat(text, F.lit("{}}")))
        .when(k == 9, F.concat(F.lit("no structure in "), m))
        .when(k == 10, F.concat(F.lit("["), good, F.lit("]")))
        .when(k == 11, F.concat(text, F.lit('"'), a, F.lit('"}')))
        .when(k == 12, F.concat(text, F.lit('{"Action":["'), a, F.lit('"]}}')))
        .when(k == 13, F.concat(good, F.lit(" "), good))
        .when(k == 14, F.concat(F.lit(" \n"), good, F.lit("\n")))
    )
    return named.select(
        "example_id",
        "g",
        "expected_action",
        F.concat(F.lit('{"MessageText":"","Content":{"Action":"'), a, F.lit('"}}')).alias("expected_answer"),
        made.alias("response"),
    )


def quote(text: str) -> str:
    """A Python string as an SQL literal."""
    lines = ["'" + part.replace("'", "''") + "'" for part in text.split("\n")]
    return "concat(" + ", chr(10), ".join(lines) + ")"


EXAMPLES_SQL = f"""
turns AS (
  SELECT conv_id, turn, role, text,
    lag(role) OVER w AS prev_role, lag(text) OVER w AS user_input,
    max(CASE WHEN role = 'system' THEN text END) OVER (PARTITION BY conv_id) AS own_system,
    coalesce(list(concat(role, ': ''', text, '''')) OVER (PARTITION BY conv_id ORDER BY turn
      ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING), []) AS history
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
examples AS (
  SELECT concat(conv_id, '-', turn) AS example_id, conv_id, turn, history, user_input,
    coalesce(own_system, {quote(DEFAULT_SYSTEM)}) AS system,
    CASE conv_id % 3 WHEN 0 THEN [] WHEN 1 THEN ['Open Door']
      ELSE ['Open Door', 'Captain''s Log'] END AS actions,
    text AS message_text,
    CASE (conv_id + turn) % 3 WHEN 0 THEN 'Talk' WHEN 1 THEN 'Open Door' ELSE 'Lights Off' END AS action
  FROM turns WHERE role = 'assistant' AND prev_role = 'user')"""

USER_PROMPT_SQL = f"""concat({quote(TEMPLATE.preamble)},
  coalesce(array_to_string(list_transform(history, lambda h: concat(chr(10), h)), ''), ''),
  {quote(TEMPLATE.actions + TEMPLATE.default_action)}, ', ',
  coalesce(array_to_string(actions, ', '), ''), {quote(TEMPLATE.user_input)}, user_input)"""

JSON_TARGET_SQL = (
    "CAST(json_object('MessageText', message_text, 'Content', json_object('Action', action)) AS VARCHAR)"
)


def responses_sql(name: str = "responses", shift: int = 0) -> str:
    return f"""
{name} AS (
  SELECT example_id, expected_action,
    concat('{{"MessageText":"","Content":{{"Action":"', expected_action, '"}}}}') AS expected_answer,
    CASE WHEN k <= 3 THEN good
      WHEN k = 4 THEN concat(head, '{{"Action":"', expected_action, '"}},"Extra":1}}')
      WHEN k = 5 THEN concat(head, '{{"Action":"Other"}}}}')
      WHEN k = 6 THEN concat('Sure: ', good, ' done')
      WHEN k = 7 THEN replace(good, '"', '''')
      WHEN k = 8 THEN concat(head, '{{}}}}')
      WHEN k = 9 THEN concat('no structure in ', m)
      WHEN k = 10 THEN concat('[', good, ']')
      WHEN k = 11 THEN concat(head, '"', expected_action, '"}}')
      WHEN k = 12 THEN concat(head, '{{"Action":["', expected_action, '"]}}}}')
      WHEN k = 13 THEN concat(good, ' ', good)
      WHEN k = 14 THEN concat(' ', chr(10), good, chr(10)) END AS response
  FROM (SELECT *, concat(head, '{{"Action":"', expected_action, '"}}}}') AS good
    FROM (SELECT *, concat('{{"MessageText":"', m, '","Content":') AS head
      FROM (SELECT concat(conv_id, '-', turn) AS example_id, (conv_id * 31 + turn + {shift}) % 16 AS k,
          CASE (conv_id + turn) % 3 WHEN 0 THEN 'Talk' WHEN 1 THEN 'Open Door'
            ELSE 'Lights Off' END AS expected_action,
          CAST(to_json(coalesce(text, '')) AS VARCHAR)[2:-2] AS m
        FROM conversations WHERE role = 'assistant') a) b) c)"""


# The scorers once more, as SQL over `responses`.
SCORED_SQL = """
blocks AS (
  SELECT *, regexp_extract(response, '(?s)(\\{.*\\})', 1) AS block,
    response IS NOT NULL AND json_valid(response) AS valid FROM responses),
parsed AS (SELECT *, block <> '' AND json_valid(block) AS block_valid FROM blocks),
scored AS (
  SELECT *,
    CASE WHEN response IS NULL THEN 'missing_response' WHEN NOT valid THEN 'bad_json'
      WHEN json_type(response) <> 'OBJECT' THEN 'bad_structure'
      WHEN json_type(response, '$.Content') IS NULL THEN 'missing_key'
      WHEN json_type(response, '$.Content') <> 'OBJECT' THEN 'bad_structure'
      WHEN json_type(response, '$.Content.Action') IS NULL THEN 'missing_key'
      WHEN CAST(json_extract(response, '$.Content.Action') AS VARCHAR)
        = CAST(json_extract(expected_answer, '$.Content.Action') AS VARCHAR) THEN 'match'
      ELSE 'mismatch' END AS action_reason,
    CASE WHEN response IS NULL THEN 'missing_response' WHEN block = '' THEN 'no_json'
      WHEN NOT block_valid THEN 'bad_json'
      WHEN json_type(block, '$.Content') IS NOT NULL AND json_type(block, '$.Content') <> 'OBJECT'
        THEN 'bad_structure'
      WHEN json_type(block, '$.Content.Action') = 'VARCHAR'
        AND json_extract_string(block, '$.Content.Action') = expected_action THEN 'match'
      ELSE 'mismatch' END AS extracted_reason,
    CASE WHEN response IS NULL OR NOT valid THEN false
      WHEN json_type(response) <> 'OBJECT' THEN false
      WHEN list_sort(json_keys(response)) <> ['Content', 'MessageText'] THEN false
      WHEN json_type(response, '$.MessageText') <> 'VARCHAR' THEN false
      WHEN json_type(response, '$.Content') <> 'OBJECT' THEN false
      WHEN json_keys(response, '$.Content') <> ['Action'] THEN false
      ELSE json_type(response, '$.Content.Action') = 'VARCHAR' END AS schema_ok,
    CASE WHEN response IS NULL THEN NULL WHEN block = '' THEN 'ERROR: No JSON found'
      WHEN NOT block_valid THEN 'ERROR: Invalid JSON'
      ELSE json_extract_string(block, '$.Content.Action') END AS predicted
  FROM parsed)"""
