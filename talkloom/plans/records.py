"""Registered queries: examples, prompts, records and chat texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talkloom import schemas, session
from talkloom.functions import prompts as P
from talkloom.functions.templates import compile_template
from talkloom.operators.inference import build_requests
from talkloom.plans import inputs as I
from talkloom.plans.flows import build_sft, chat_texts
from talkloom.sinks.tables import write_jsonl
from talkloom.sources.dialogues import read_sft

def _history() -> Column:
    return F.col("prompt.History")


def _actions() -> Column:
    return F.col("prompt.AvailableActions")


def _input() -> Column:
    return F.col("prompt.UserInput")


def _target(mode: str = "json") -> Column:
    return P.answer_target(F.col("answer.MessageText"), F.col("answer.Content.Action"), mode)


def dialog_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.examples(spark, sf_dir).select(
        "example_id", "conv_id", "turn", "system",
        F.array_join(_history(), "\n").alias("history"),
        F.size(_history()).cast("bigint").alias("n_history"),
        F.array_join(_actions(), "|").alias("actions"),
        _input().alias("user_input"),
        F.col("answer.MessageText").alias("message_text"),
        F.col("answer.Content.Action").alias("action"),
    )


DIALOG_EXAMPLES = f"""WITH {I.EXAMPLES_SQL}
SELECT example_id, conv_id, turn, system, coalesce(array_to_string(history, chr(10)), '') AS history,
  CAST(len(history) AS BIGINT) AS n_history, coalesce(array_to_string(actions, '|'), '') AS actions,
  user_input, message_text, action
FROM examples"""


def sft_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_sft(I.examples(spark, sf_dir)).select("example_id", "system", "user", "bot")


SFT_SQL = f"""{I.EXAMPLES_SQL},
sft AS (SELECT example_id, conv_id, system, {I.USER_PROMPT_SQL} AS "user", {I.JSON_TARGET_SQL} AS bot
  FROM examples)"""

SFT_RECORDS = f"""WITH {SFT_SQL} SELECT example_id, system, "user", bot FROM sft"""


def sft_wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.examples(spark, sf_dir).select(
        "example_id",
        "system",
        P.prompt_repr(_history(), _actions(), _input()).alias("user"),
        P.wrap_target(_target("repr")).alias("bot"),
    )


def _repr_sql(value: str) -> str:
    escaped = (
        f"replace(replace(replace(replace({value}, '\\', '\\\\'), chr(10), '\\n'), "
        "chr(13), '\\r'), chr(9), '\\t')"
    )
    return (
        f"CASE WHEN contains({value}, '''') AND NOT contains({value}, '\"') "
        f"THEN concat('\"', {escaped}, '\"') "
        f"ELSE concat('''', replace({escaped}, '''', '\\'''), '''') END"
    )


def _repr_list_sql(values: str) -> str:
    shown = f"list_transform({values}, lambda x: {_repr_sql('x')})"
    return f"concat('[', coalesce(array_to_string({shown}, ', '), ''), ']')"


SFT_WRAPPED = f"""WITH {I.EXAMPLES_SQL}
SELECT example_id, system,
  concat('{{''History'': ', {_repr_list_sql("history")}, ', ''AvailableActions'': ', {_repr_list_sql("actions")},
    ', ''UserInput'': ', {_repr_sql("user_input")}, '}}') AS "user",
  concat('START', chr(10), '{{''MessageText'': ', {_repr_sql("message_text")}, ', ''Content'': {{''Action'': ',
    {_repr_sql("action")}, '}}}}', chr(10), 'END') AS bot
FROM examples"""


def chat_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    sft = build_sft(I.examples(spark, sf_dir))
    messages = P.to_messages(system=F.col("system"), user=F.col("user"), assistant=F.col("bot"))
    return sft.select("example_id", F.posexplode(messages).alias("pos", "m")).select(
        "example_id", F.col("pos").cast("bigint").alias("pos"), "m.role", "m.content"
    )


CHAT_MESSAGES = f"""WITH {SFT_SQL}
SELECT example_id, CAST(0 AS BIGINT) AS pos, 'system' AS role, system AS content FROM sft
UNION ALL SELECT example_id, 1, 'user', "user" FROM sft
UNION ALL SELECT example_id, 2, 'assistant', bot FROM sft"""


def chat_template_role_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_texts(build_sft(I.examples(spark, sf_dir))).select("example_id", "text")


CHAT_TEMPLATE_ROLE_TAGS = f"""WITH {SFT_SQL}
SELECT example_id, concat('<s>system', chr(10), system, '</s><s>user', chr(10), "user", '</s><s>bot', chr(10), bot,
  '</s>') AS text FROM sft"""


def chat_template_inst(spark: SparkSession, sf_dir: str) -> DataFrame:
    sft = build_sft(I.examples(spark, sf_dir))
    messages = P.to_messages(system=F.col("system"), user=F.col("user"))
    return sft.select("example_id", P.apply_chat_template(messages, P.INST).alias("text"))


CHAT_TEMPLATE_INST = f"""WITH {SFT_SQL}
SELECT example_id, concat('[INST] <<SYS>>', chr(10), system, chr(10), '<</SYS>>', chr(10), chr(10), "user",
  ' [/INST]') AS text FROM sft"""


#: Three chat formats as template text: role tags, a bracketed turn, and marked turns with an open answer.
TEMPLATES = {
    "tags": """{% for message in messages %}
<s>{{ 'bot' if message['role'] == 'assistant' else message['role'] }}
{{ message['content'] }}</s>{% endfor %}""",
    "inst": """{{- '[INST] ' }}
{%- for m in messages %}
  {%- if m.role == 'system' %}{{ '<<SYS>>\\n' + m.content + '\\n<</SYS>>\\n\\n' }}
  {%- elif m.role == 'user' %}{{ m.content | trim + ' [/INST]' }}
  {%- else %}{{ ' ' + m.content + (eos_token if loop.last else '') }}{% endif %}
{%- endfor %}""",
    "turns": """{%- for m in messages %}
    {%- if m['role'] in ['system', 'user'] or not loop.last %}
        {{- '<|im_start|>' + m['role'] + '\\n' + m['content'] + '<|im_end|>\\n' }}
    {%- endif %}
{%- endfor %}
{%- if add_generation_prompt %}{{ '<|im_start|>assistant\\n' }}{% endif %}""",
}


def chat_template_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records through three templates given as text."""
    sft = build_sft(I.examples(spark, sf_dir))
    messages = P.to_messages(system=F.col("system"), user=F.col("user"), assistant=F.col("bot"))
    made = {n: compile_template(t, eos_token="</s>", add_generation_prompt=True)(messages) for n, t in TEMPLATES.items()}
    return sft.select("example_id", *[column.alias(name) for name, column in made.items()])


CHAT_TEMPLATE_TEXT = f"""WITH {SFT_SQL}
SELECT example_id,
  concat('<s>system', chr(10), system, '</s><s>user', chr(10), "user", '</s><s>bot', chr(10), bot, '</s>') AS tags,
  concat('[INST] <<SYS>>', chr(10), system, chr(10), '<</SYS>>', chr(10), chr(10),
    regexp_replace("user", '^\\s+|\\s+$', '', 'g'), ' [/INST] ', bot, '</s>') AS inst,
  concat('<|im_start|>system', chr(10), system, '<|im_end|>', chr(10), '<|im_start|>user', chr(10), "user",
    '<|im_end|>', chr(10), '<|im_start|>assistant', chr(10)) AS turns
FROM sft"""


def grpo_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    correct = F.array(F.col("answer.Content.Action"))
    return I.examples(spark, sf_dir).select(
        "example_id",
        P.grpo_prompt(_history(), _actions(), _input()).alias("prompt"),
        F.array_join(correct, "|").alias("correct_actions"),
        F.size(correct).cast("bigint").alias("n_correct"),
    )


GRPO_PROMPTS = f"""WITH {I.EXAMPLES_SQL}
SELECT example_id, concat(coalesce(history[1], ''), chr(10), 'AvailableActions: ', {_repr_list_sql("actions")},
  chr(10), 'User: ', user_input) AS prompt, action AS correct_actions, CAST(1 AS BIGINT) AS n_correct
FROM examples"""


def eval_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    sft = build_sft(I.examples(spark, sf_dir))
    schema = P.schema_json(schemas.RESPONSE)
    both = build_requests(F.col("user"), F.col("system"), schema)
    return sft.select(
        "example_id",
        F.size(both).cast("bigint").alias("n_messages"),
        F.get(both, F.lit(0))["content"].alias("system_content"),
        F.get(both, F.lit(1))["content"].alias("user_content"),
        F.size(build_requests(F.col("user"))).cast("bigint").alias("n_user_only"),
    )


EVAL_REQUESTS = f"""WITH {SFT_SQL}
SELECT example_id, CAST(2 AS BIGINT) AS n_messages,
  concat(system, ' Answer with JSON of this schema: ', {I.quote(P.schema_json(schemas.RESPONSE))}) AS system_content,
  "user" AS user_content, CAST(1 AS BIGINT) AS n_user_only
FROM sft"""


def sft_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written once with the split as folder, read back as named splits."""
    split = F.when(F.col("conv_id") % 10 == 0, F.lit("test")).otherwise(F.lit("train"))
    sft = build_sft(I.examples(spark, sf_dir)).select("system", "user", "bot", split.alias("split"))
    folder = session.shared_dir(spark)
    write_jsonl(sft, folder, partition_by=["split"])
    return read_sft(spark, {name: f"{folder}/split={name}" for name in ("train", "test")})


SFT_ROUNDTRIP = f"""WITH {SFT_SQL}
SELECT system, "user", bot, CASE WHEN conv_id % 10 = 0 THEN 'test' ELSE 'train' END AS split FROM sft"""


def eval_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2 at scale: the prompt list as JSON lines, as text."""
    sft = build_sft(I.examples(spark, sf_dir))
    record = F.struct("system", "user", "bot")
    return sft.select("example_id", F.to_json(record, {"ignoreNullFields": "false"}).alias("line"))


EVAL_PROMPTS = f"""WITH {SFT_SQL}
SELECT example_id, CAST(json_object('system', system, 'user', "user", 'bot', bot) AS VARCHAR) AS line FROM sft"""

QUERIES = {
    "dialog_examples": (dialog_examples, DIALOG_EXAMPLES),
    "sft_records": (sft_records, SFT_RECORDS),
    "sft_wrapped": (sft_wrapped, SFT_WRAPPED),
    "chat_messages": (chat_messages, CHAT_MESSAGES),
    "chat_template_role_tags": (chat_template_role_tags, CHAT_TEMPLATE_ROLE_TAGS),
    "chat_template_text": (chat_template_text, CHAT_TEMPLATE_TEXT),
    "chat_template_inst": (chat_template_inst, CHAT_TEMPLATE_INST),
    "grpo_prompts": (grpo_prompts, GRPO_PROMPTS),
    "eval_requests": (eval_requests, EVAL_REQUESTS),
    "sft_roundtrip": (sft_roundtrip, SFT_ROUNDTRIP),
    "eval_prompts": (eval_prompts, EVAL_PROMPTS),
}
