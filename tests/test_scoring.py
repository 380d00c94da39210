"""The scorers against the rules written out in Python."""

import json

import pytest
from pyspark.sql import functions as F

from talkloom.functions import strict_json as J
from talkloom.operators import rewards, scoring as S

RESPONSES = [
    '{"Content":{"Action":"A"}}', '{"Content":{"Action":"B"}}', '{"Content":{"Action":1}}', '{"Content":{"Action":["A"]}}',
    '{"Content":{"Action":null}}', '{"Content":{}}', '{"Content":null}', '{"Content":"A"}', '{"Content":["A"]}', "{}",
    '[{"Content":{"Action":"A"}}]', '"A"', "1", "null", "", "x", "{x}", 'Sure {"Content":{"Action":"A"}} done',
    '{"Content":{"Action":"A"}} {}', "{'Content':{'Action':'A'}}", None,
]
EXPECTED = ['{"Content":{"Action":"A"}}', '{"Content":{"Action":1}}', '{"Content":{"Action":["A"]}}', "{}", "oops", "[]"]


def read_action(text):
    """Outcome of reading Content.Action: (fault, value)."""
    try:
        value = json.loads(text)
    except ValueError:
        return "bad_json", None
    for key in ("Content", "Action"):
        if not isinstance(value, dict):
            return "bad_structure", None
        if key not in value:
            return "missing_key", None
        value = value[key]
    return None, value


def rule_action(response, expected):
    if response is None:
        return "missing_response"
    (fault, got), (other_fault, wanted) = read_action(response), read_action(expected)
    if "bad_json" in (fault, other_fault):
        return "bad_json"
    return fault or other_fault or ("match" if type(got) is type(wanted) and got == wanted else "mismatch")


def rule_extracted(response, expected):
    if response is None:
        return "missing_response", None
    begin, end = response.find("{"), response.rfind("}")
    if begin < 0 or end < begin:
        return "no_json", "ERROR: No JSON found"
    try:
        value = json.loads(response[begin : end + 1])
    except ValueError:
        return "bad_json", "ERROR: Invalid JSON"
    content = value.get("Content", {})
    if not isinstance(content, dict):
        return "bad_structure", None
    got = content.get("Action")
    shown = got if isinstance(got, str) or got is None else json.dumps(got)
    return ("match" if got == expected else "mismatch"), shown


def rule_reward(response, expected):
    try:
        value = json.loads(response)
        content = value.get("Content", {})
        return 1.0 if content.get("Action", []) == expected else 0.0
    except (TypeError, ValueError, AttributeError):
        return -1.0


def test_action_scorer(spark):
    pairs = [(r, e, rule_action(r, e)) for r in RESPONSES for e in EXPECTED]
    df = spark.createDataFrame(pairs, "response string, expected_answer string, rule string")
    scored = S.run_scorers(S.parse_responses(df, "response", "expected_answer"), [S.ACTION])
    for r in scored.collect():
        assert r.action.reason == r.rule, (r.response, r.expected_answer)
        assert r.action.passed is (r.rule == "match")


@pytest.mark.parametrize("other, passed", [("1.0", True), ("1e0", True), ("10e-1", True), ("2", False), ("true", False), ('"1"', False), ("[1]", False)])
def test_number_as_action(spark, other, passed):
    texts = ['{"Content":{"Action":%s}}' % v for v in ("1", other)]
    df = spark.createDataFrame([tuple(texts)], "response string, expected_answer string")
    row = S.run_scorers(S.parse_responses(df, "response", "expected_answer"), [S.ACTION]).first()
    assert row.action.passed is passed


def test_extracting_scorer_and_direct_scorer(spark):
    df = spark.createDataFrame([(r, "A") for r in RESPONSES], "response string, expected_action string")
    parsed = S.parse_responses(df)
    for r in S.results_table(parsed.withColumn("p", F.lit("p")), "p", "response", "expected_action").collect():
        assert (r.reason, r.predicted) == rule_extracted(r.full_response, "A"), r.full_response
        assert r.passed is (r.reason == "match")
    for r in S.run_scorers(parsed, [S.DIRECT]).collect():
        rule = rule_action(r.response, '{"Content":{"Action":"A"}}')
        assert r.direct.reason == rule
        known = {"match": True, "mismatch": False, "missing_response": False}
        assert r.direct.passed is known.get(rule)


def test_reward(spark):
    rows = [(i, r) for i, r in enumerate(RESPONSES)]
    completions = spark.createDataFrame(rows, "prompt_id int, completion string")
    targets = spark.createDataFrame([(i, "A") for i, _ in rows], "prompt_id int, correct_action string")
    for r in rewards.reward_action(completions, targets).collect():
        assert r.reward == rule_reward(r.completion, "A"), r.completion


def test_quote_swap_breaks_on_apostrophes(spark):
    texts = ["{'Content': {'Action': 'A'}}", "{'MessageText': \"it's\", 'Content': {'Action': 'A'}}"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(J.is_strict_json(S.swap_quotes(F.col("t")))).collect()
    assert [r[0] for r in got] == [True, False]


def test_python_scorer_keeps_other_rows_alive(spark):
    def check(prompt, response, expected):
        if response == "boom":
            raise RuntimeError("broken")
        if response != expected:
            raise AssertionError("differs")

    df = spark.createDataFrame([("p", "a", "a"), ("p", "b", "a"), ("p", "boom", "a")], "p string, response string, e string")
    scorer = S.python_scorer("mine", check, "p", "response", "e")
    scored = S.run_scorers(S.parse_responses(df), [scorer, S.SCHEMA])
    got = {r.response: tuple(r.mine) for r in scored.collect()}
    assert got == {"a": (True, "match"), "b": (False, "differs"), "boom": (False, "error: RuntimeError: broken")}
    metrics = {r.suite: (r.passed, r.total, r.shown) for r in S.suite_metrics(scored, [scorer, S.SCHEMA]).collect()}
    assert metrics == {"mine": (1, 3, "0.33 (1/3)"), "schema": (0, 3, "0.00 (0/3)")}


def test_shown_rate_is_what_printf_shows(spark):
    rows = [(p, t) for t in (1, 3, 7, 8, 16, 40, 200, 1000, 2000) for p in range(0, t + 1)]
    df = spark.createDataFrame(rows, "passed long, total long")
    wrong = [r for r in S.with_accuracy(df).collect() if r.shown != f"{r.passed / r.total:.2f} ({r.passed}/{r.total})"]
    assert wrong == []


def test_empty_results_have_rate_zero(spark):
    empty = spark.createDataFrame([], "passed boolean")
    row = S.pass_rate(empty).first()
    assert (row.passed, row.total, row.accuracy, row.shown) == (0, 0, 0.0, "0.00 (0/0)")


def test_align_shows_missing_answers_and_failures(spark):
    prompts = spark.createDataFrame([(1, "a"), (2, "b")], "example_id int, prompt string")
    answers = spark.createDataFrame([(2, '{"Content":{"Action":"A"}}')], "example_id int, response string")
    df = S.align(prompts, answers).withColumn("want", F.lit("A"))
    results = S.results_table(S.parse_responses(df), "prompt", "response", "want")
    assert [(r.prompt, r.reason) for r in S.failures(results).collect()] == [("a", "missing_response")]


@pytest.mark.parametrize("score, passed", [(0.7, True), (0.69, False), (None, False)])
def test_judge_gate(spark, score, passed):
    examples = spark.createDataFrame([(1,)], "id int")
    scores = spark.createDataFrame([(1, score)], "id int, score double")
    assert S.judge_gate(examples, scores, "id", "score").first().passed is passed


def test_group_advantage(spark):
    rows = [(1, 1.0), (1, 0.0), (2, 1.0), (2, 1.0), (3, -1.0)]
    df = spark.createDataFrame(rows, "prompt_id int, reward double")
    got = sorted((r.prompt_id, round(r.advantage, 6)) for r in rewards.group_advantage(df, eps=0.0001).collect())
    high = round(0.5 / (0.5**0.5 + 0.0001), 6)
    assert got == [(1, -high), (1, high), (2, 0.0), (2, 0.0), (3, 0.0)]
    pop = [r.advantage for r in rewards.group_advantage(df, eps=0.0, ddof=0).collect() if r.prompt_id == 1]
    assert sorted(pop) == [-1.0, 1.0]


def test_filter_on_a_score_does_not_parse_again(spark):
    df = spark.createDataFrame([("{}", "A")], "response string, expected_action string")
    results = S.results_table(S.parse_responses(df).withColumn("p", F.lit("p")), "p", "response", "expected_action")
    plan = S.failures(results)._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line]
    assert filters and not any("parseJson" in line for line in filters)


@pytest.mark.parametrize("target, passed", [("{'Content': {'Action': 'A'}}", True), ("{'Content': {'Action': 'B'}}", False)])
def test_action_of_a_printed_target(spark, target, passed):
    df = spark.createDataFrame([('{"Content":{"Action":"A"}}', target)], "response string, expected_answer string")
    parsed = S.parse_responses(df, "response", "expected_answer", printed_target=True)
    assert parsed.select(S.score_action().alias("r")).first().r == ("match" if passed else "mismatch")
