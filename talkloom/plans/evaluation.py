"""Registered queries: parsing, scoring, metrics, rewards and generation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkloom import session
from talkloom.functions import shape
from talkloom.functions import strict_json as J
from talkloom.operators import inference, resumable, rewards
from talkloom.operators import scoring as S
from talkloom.operators.alignment import align_by_position, number_rows
from talkloom.plans import inputs as I
from talkloom.sinks.tables import write_report

SUITES = [S.ACTION, S.EXTRACTED, S.DIRECT, S.SCHEMA]

_SCORED = f"{I.responses_sql()}, {I.SCORED_SQL}"


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.parse_responses(I.responses(spark, sf_dir), "response", "expected_answer")


def _outcome(spark: SparkSession, sf_dir: str, scorer: S.Scorer) -> DataFrame:
    scored = S.run_scorers(_parsed(spark, sf_dir), [scorer])
    return scored.select("example_id", f"{scorer.name}.passed", f"{scorer.name}.reason")


def extract_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.responses(spark, sf_dir).select("example_id", J.json_block(F.col("response")).alias("block"))


EXTRACT_JSON = f"WITH {_SCORED} SELECT example_id, block FROM scored"


def parse_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = _parsed(spark, sf_dir)
    return parsed.select(
        "example_id",
        F.col("value").isNotNull().alias("is_json"),
        J.is_object(F.col("value")).alias("is_object"),
    )


PARSE_STATUS = f"""WITH {_SCORED}
SELECT example_id, valid AS is_json, CASE WHEN valid THEN json_type(response) = 'OBJECT' ELSE false END AS is_object
FROM scored"""


def score_action(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _outcome(spark, sf_dir, S.ACTION)


SCORE_ACTION = f"""WITH {_SCORED}
SELECT example_id, action_reason = 'match' AS passed, action_reason AS reason FROM scored"""


def score_extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = S.results_table(_parsed(spark, sf_dir), "example_id", "response", "expected_action")
    return results.select(
        F.col("prompt").alias("example_id"), "expected", "predicted", "full_response", "passed", "reason"
    )


SCORE_EXTRACTED = f"""WITH {_SCORED}
SELECT example_id, expected_action AS expected, predicted, response AS full_response,
  extracted_reason = 'match' AS passed, extracted_reason AS reason
FROM scored"""


def score_direct(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = F.coalesce(F.col("passed").cast("string"), F.lit("unknown"))
    return _outcome(spark, sf_dir, S.DIRECT).withColumn("passed", known)


# an action that is not a string differs from every expected action, as in action_reason
SCORE_DIRECT = f"""WITH {_SCORED}
SELECT example_id, CASE WHEN action_reason = 'match' THEN 'true'
  WHEN action_reason IN ('mismatch', 'missing_response') THEN 'false' ELSE 'unknown' END AS passed,
  action_reason AS reason
FROM scored"""


def schema_conformity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir).select("example_id", J.conforms(F.col("value")).alias("conforms"))


SCHEMA_CONFORMITY = f"WITH {_SCORED} SELECT example_id, schema_ok AS conforms FROM scored"


def message_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parsed(spark, sf_dir).select("example_id", J.message_text(F.col("value")).alias("message_text"))


MESSAGE_TEXT = f"""WITH {_SCORED}
SELECT example_id, CASE WHEN valid THEN CASE WHEN json_type(response) = 'OBJECT'
  THEN json_extract_string(response, '$.MessageText') END END AS message_text
FROM scored"""


def suite_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.suite_metrics(S.run_scorers(_parsed(spark, sf_dir), SUITES), SUITES)


_SUMS = """sums AS (
  SELECT 'action' AS suite, count(*) FILTER (WHERE action_reason = 'match') AS passed, count(*) AS total FROM scored
  UNION ALL SELECT 'extracted', count(*) FILTER (WHERE extracted_reason = 'match'), count(*) FROM scored
  UNION ALL SELECT 'direct', count(*) FILTER (WHERE action_reason = 'match'), count(*) FROM scored
  UNION ALL SELECT 'schema', count(*) FILTER (WHERE schema_ok), count(*) FROM scored)"""

_RATE = """CASE WHEN total = 0 THEN 0.0 ELSE CAST(passed AS DOUBLE) / total END"""

SUITE_METRICS = f"""WITH {_SCORED}, {_SUMS}
SELECT suite, passed, total, {_RATE} AS accuracy, printf('%.2f (%d/%d)', {_RATE}, passed, total) AS shown FROM sums"""


def eval_pass_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = S.results_table(_parsed(spark, sf_dir), "example_id", "response", "expected_action")
    return S.pass_rate(results, ["expected"])


EVAL_PASS_RATE = f"""WITH {_SCORED}, sums AS (SELECT expected_action AS expected,
  count(*) FILTER (WHERE extracted_reason = 'match') AS passed, count(*) AS total FROM scored GROUP BY expected_action)
SELECT expected, passed, total, {_RATE} AS accuracy, printf('%.2f (%d/%d)', {_RATE}, passed, total) AS shown FROM sums"""


def eval_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = S.results_table(_parsed(spark, sf_dir), "example_id", "response", "expected_action")
    return S.failures(results).select(
        F.col("prompt").alias("example_id"), "reason", F.col("full_response").alias("response"), "expected"
    )


EVAL_FAILURES = f"""WITH {_SCORED}
SELECT example_id, extracted_reason AS reason, response, expected_action AS expected
FROM scored WHERE extracted_reason <> 'match'"""


def eval_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every prompt with its answer by id; a prompt without an answer is a failed one."""
    prompts = I.examples(spark, sf_dir, max_history=0).select("example_id", F.col("prompt.UserInput").alias("user_input"))
    answers = I.responses(spark, sf_dir).filter(F.col("response").isNotNull())
    parsed = S.parse_responses(S.align(prompts, answers), "response", "expected_answer")
    scored = S.run_scorers(parsed, [S.ACTION])
    return scored.select("example_id", "user_input", "response", "action.passed", "action.reason")


def eval_align_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 by position: expected answers and responses as two lists of files, the second without its last rows."""
    made = I.responses(spark, sf_dir)
    last = made.agg(F.max("example_id").alias("last"))
    answers = made.join(F.broadcast(last), F.col("example_id") < F.col("last")).drop("last")
    lists = {"expected": made.select("example_id", "expected_answer"), "response": answers.select("example_id", "response")}
    read = {}
    for name, rows in lists.items():
        folder = session.shared_dir(spark)
        rows.orderBy("example_id").write.option("ignoreNullFields", "false").json(folder)
        kept = [c for c in rows.columns if name == "expected" or c != "example_id"]
        schema = T.StructType([T.StructField(c, T.StringType()) for c in kept])
        read[name] = number_rows(spark.read.schema(schema).json(folder))
    both = align_by_position(read["expected"], read["response"])
    scored = S.run_scorers(S.parse_responses(both, "response", "expected_answer"), [S.ACTION])
    return scored.select("pos", "example_id", "response", "side", "action.passed", "action.reason")


EVAL_ALIGN_POSITION = f"""WITH {_SCORED}
SELECT row_number() OVER (ORDER BY example_id) - 1 AS pos, example_id,
  CASE WHEN example_id < last THEN response END AS response,
  CASE WHEN example_id < last THEN 'both' ELSE 'left only' END AS side,
  example_id < last AND action_reason = 'match' AS passed,
  CASE WHEN example_id < last THEN action_reason ELSE 'missing_response' END AS reason
FROM scored, (SELECT max(example_id) AS last FROM scored)"""


EVAL_ALIGN = f"""WITH {I.EXAMPLES_SQL}, {_SCORED}
SELECT e.example_id, e.user_input, s.response, coalesce(s.action_reason = 'match', false) AS passed,
  coalesce(s.action_reason, 'missing_response') AS reason
FROM examples e LEFT JOIN (SELECT * FROM scored WHERE response IS NOT NULL) s ON e.example_id = s.example_id"""


def eval_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3. Both written tables read back: the summary and what the results folder holds."""
    scored = S.run_scorers(_parsed(spark, sf_dir), [S.ACTION, S.EXTRACTED])
    suites = F.array(
        F.struct(F.lit("action").alias("suite"), F.col("action").alias("r")),
        F.struct(F.lit("extracted").alias("suite"), F.col("extracted").alias("r")),
    )
    results = scored.select("example_id", F.inline(suites)).select("example_id", "suite", "r.passed", "r.reason")
    folder = session.shared_dir(spark)
    write_report(results, folder)
    summary = spark.read.parquet(f"{folder}/summary")
    written = spark.read.schema(results.schema).parquet(f"{folder}/results")
    failed = written.groupBy("suite").agg(F.count_if(~F.col("passed")).alias("failed"))
    return summary.join(failed, "suite")


EVAL_REPORT = f"""WITH {_SCORED}, {_SUMS}
SELECT suite, passed, total, {_RATE} AS accuracy, printf('%.2f (%d/%d)', {_RATE}, passed, total) AS shown,
  total - passed AS failed
FROM sums WHERE suite IN ('action', 'extracted')"""


def judge_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = I.table(spark, sf_dir, "documents").select("doc_id", "source")
    scores = I.table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("score"))
    return S.pass_rate(S.judge_gate(documents, scores, "doc_id", "score"), ["source"])


JUDGE_GATE = f"""WITH sums AS (SELECT d.source, count(*) FILTER (WHERE coalesce(l.quality >= 0.7, false)) AS passed,
  count(*) AS total FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY d.source)
SELECT source, passed, total, {_RATE} AS accuracy, printf('%.2f (%d/%d)', {_RATE}, passed, total) AS shown FROM sums"""


def _completions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two completions per prompt, and the prompts' targets."""
    completions = I.responses(spark, sf_dir, shifts=(0, 5)).select(
        F.col("example_id").alias("prompt_id"), "g", F.col("response").alias("completion")
    )
    targets = I.responses(spark, sf_dir).select(
        F.col("example_id").alias("prompt_id"), F.col("expected_action").alias("correct_action")
    )
    return completions, targets


def grpo_rewards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rewarded = rewards.reward_action(*_completions(spark, sf_dir))
    return rewarded.select("prompt_id", "g", "reward")


_REWARD = """CASE WHEN completion IS NULL OR NOT json_valid(completion) THEN -1.0
    WHEN json_type(completion) <> 'OBJECT' THEN -1.0
    WHEN json_type(completion, '$.Content') IS NOT NULL AND json_type(completion, '$.Content') <> 'OBJECT' THEN -1.0
    WHEN json_type(completion, '$.Content.Action') = 'VARCHAR'
      AND json_extract_string(completion, '$.Content.Action') = expected_action THEN 1.0 ELSE 0.0 END"""

_REWARDS_SQL = f"""{I.responses_sql("first_sample")}, {I.responses_sql("second_sample", 5)},
completions AS (
  SELECT example_id AS prompt_id, CAST(0 AS BIGINT) AS g, response AS completion, expected_action FROM first_sample
  UNION ALL SELECT example_id, 1, response, expected_action FROM second_sample),
rewards AS (SELECT prompt_id, g, CAST({_REWARD} AS DOUBLE) AS reward FROM completions)"""

GRPO_REWARDS = f"WITH {_REWARDS_SQL} SELECT prompt_id, g, reward FROM rewards"


def grpo_advantage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rewards are a written table: statistics and rows both read it, completions are parsed once."""
    completions, targets = _completions(spark, sf_dir)
    rewarded = rewards.apply_reward(completions, lambda df: rewards.reward_action(df, targets))
    written = session.materialize(rewarded.select("prompt_id", "g", "reward"))
    made = rewards.group_advantage(written)
    return made.select("prompt_id", "g", "reward", F.round("advantage", 9).alias("advantage"))


GRPO_ADVANTAGE = f"""WITH {_REWARDS_SQL},
stats AS (SELECT *, avg(reward) OVER (PARTITION BY prompt_id) AS mean,
  coalesce(stddev_samp(reward) OVER (PARTITION BY prompt_id), 0.0) AS dev FROM rewards)
SELECT prompt_id, g, reward, round((reward - mean) / (dev + 0.0001), 9) AS advantage FROM stats"""


def _stub_client():
    """Stands in for a model: describes the prompt, declines some, fails on others."""

    def call(texts: list[str]) -> list[str | None]:
        if any(len(t) % 7 == 0 for t in texts):
            raise ValueError("unlucky length")
        return [None if len(t) % 5 == 0 else f"  {len(t)} chars, starts {t.split(' ')[0]}\n" for t in texts]

    return call


def eval_generate(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompts = I.examples(spark, sf_dir, max_history=0).select("example_id", F.col("prompt.UserInput").alias("prompt"))
    return inference.generate(prompts, _stub_client, "prompt").select("example_id", "response", "error")


EVAL_GENERATE = f"""WITH {I.EXAMPLES_SQL}
SELECT example_id,
  CASE WHEN length(user_input) % 7 <> 0 AND length(user_input) % 5 <> 0
    THEN concat(length(user_input), ' chars, starts ', split_part(user_input, ' ', 1)) END AS response,
  CASE WHEN length(user_input) % 7 = 0 THEN 'ValueError: unlucky length'
    WHEN length(user_input) % 5 = 0 THEN 'no choice returned' END AS error
FROM examples"""



def eval_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 resumed: a first run answers the prompts of even length, a second one all; it asks only what has no good answer yet."""
    prompts = I.examples(spark, sf_dir, max_history=0).select("example_id", F.col("prompt.UserInput").alias("prompt"))
    store = session.shared_dir(spark)
    resumable.generate_resumable(prompts.filter(F.length("prompt") % 2 == 0), _stub_client, store, rounds=2)
    done = resumable.generate_resumable(prompts, _stub_client, store, rounds=2)
    return done.select("example_id", "response", "error", "run")


EVAL_RESUMED = f"""WITH {I.EXAMPLES_SQL}, asked AS (SELECT example_id, user_input, length(user_input) AS n FROM examples)
SELECT example_id,
  CASE WHEN n % 7 <> 0 AND n % 5 <> 0 THEN concat(n, ' chars, starts ', split_part(user_input, ' ', 1)) END AS response,
  CASE WHEN n IS NULL THEN 'no prompt' WHEN n % 7 = 0 THEN 'ValueError: unlucky length' WHEN n % 5 = 0 THEN 'no choice returned' END AS error,
  CAST(CASE WHEN n IS NULL THEN NULL WHEN n % 2 = 0 AND n % 7 <> 0 AND n % 5 <> 0 THEN 1 ELSE 2 END AS BIGINT) AS run
FROM asked"""

#: The shape of a response, as nested parts.
RESPONSE_SHAPE = {
    "type": "object",
    "properties": {
        "MessageText": {"type": "string"},
        "Content": {
            "type": "object",
            "properties": {"Action": {"type": "string", "enum": ["Talk", "Open Door", "Lights Off"]}},
            "required": ["Action"],
            "additionalProperties": False,
        },
    },
    "required": ["MessageText", "Content"],
    "additionalProperties": False,
}


def schema_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E6 for any schema: where each response first breaks it, and how."""
    made = _parsed(spark, sf_dir).select("example_id", shape.violation(F.col("value"), RESPONSE_SHAPE).alias("v"))
    return made.select("example_id", "v.path", "v.reason")


SCHEMA_PATHS = f"""WITH {_SCORED}, faults AS (SELECT example_id, CASE
  WHEN response IS NULL OR NOT valid THEN '$ not_json'
  WHEN json_type(response) <> 'OBJECT' THEN '$ type'
  WHEN json_type(response, '$.MessageText') IS NULL THEN '$.MessageText missing'
  WHEN json_type(response, '$.Content') IS NULL THEN '$.Content missing'
  WHEN len([k FOR k IN json_keys(response) IF k NOT IN ('MessageText', 'Content')]) > 0
    THEN concat('$.', list_min([k FOR k IN json_keys(response) IF k NOT IN ('MessageText', 'Content')]), ' extra')
  WHEN json_type(response, '$.MessageText') <> 'VARCHAR' THEN '$.MessageText type'
  WHEN json_type(response, '$.Content') <> 'OBJECT' THEN '$.Content type'
  WHEN json_type(response, '$.Content.Action') IS NULL THEN '$.Content.Action missing'
  WHEN json_type(response, '$.Content.Action') <> 'VARCHAR' THEN '$.Content.Action type'
  WHEN json_extract_string(response, '$.Content.Action') NOT IN ('Talk', 'Open Door', 'Lights Off') THEN '$.Content.Action enum'
  END AS fault FROM scored)
SELECT example_id, split_part(fault, ' ', 1) AS path, split_part(fault, ' ', 2) AS reason FROM faults"""

QUERIES = {
    "eval_resumed": (eval_resumed, EVAL_RESUMED),
    "schema_paths": (schema_paths, SCHEMA_PATHS),
    "extract_json": (extract_json, EXTRACT_JSON),
    "parse_status": (parse_status, PARSE_STATUS),
    "score_action": (score_action, SCORE_ACTION),
    "score_extracted": (score_extracted, SCORE_EXTRACTED),
    "score_direct": (score_direct, SCORE_DIRECT),
    "schema_conformity": (schema_conformity, SCHEMA_CONFORMITY),
    "message_text": (message_text, MESSAGE_TEXT),
    "suite_metrics": (suite_metrics, SUITE_METRICS),
    "eval_pass_rate": (eval_pass_rate, EVAL_PASS_RATE),
    "eval_failures": (eval_failures, EVAL_FAILURES),
    "eval_align": (eval_align, EVAL_ALIGN),
    "eval_align_position": (eval_align_position, EVAL_ALIGN_POSITION),
    "eval_report": (eval_report, EVAL_REPORT),
    "judge_gate": (judge_gate, JUDGE_GATE),
    "grpo_rewards": (grpo_rewards, GRPO_REWARDS),
    "grpo_advantage": (grpo_advantage, GRPO_ADVANTAGE),
    "eval_generate": (eval_generate, EVAL_GENERATE),
}
