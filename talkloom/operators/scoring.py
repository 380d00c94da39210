"""Scorers of model responses and the metrics made from them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from decimal import Decimal

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkloom import constants as C
from talkloom.functions import strict_json as J
from talkloom.operators.once import with_columns_once

PASSED_REASON = "struct<passed:boolean,reason:string>"


def align(prompts: DataFrame, answers: DataFrame, on: str = "example_id") -> DataFrame:
    """J1. Prompts with their answers by id; a prompt without an answer stays."""
    return prompts.join(answers, on, "left")


def read_actions(df: DataFrame, value: str) -> DataFrame:
    """Add what a parsed value says about its action.

    <value>_fault is why there is none, <value>_text the action if it is a string, <value>_other its
    JSON text if it is anything else.
    """
    action = f"{value}_action"
    found = df.withColumn(action, J.action_of(F.col(value)))
    found = found.withColumns(
        {
            f"{value}_fault": J.action_fault(F.col(value), F.col(action)),
            f"{value}_text": J.string_of(F.col(action)),
        }
    )
    other = F.when(F.col(f"{value}_text").isNull(), F.to_json(action))
    return found.withColumn(f"{value}_other", other).drop(action)


def parse_responses(
    df: DataFrame, response: str = "response", expected_answer: str | None = None, printed_target: bool = False
) -> DataFrame:
    """Parse once for all scorers: `value`, `block` and `block_value`, `expected_value`, and their actions.

    `printed_target` reads expected answers in printed-dict form, their quotes swapped. Columns nobody
    reads are pruned from the plan.
    """
    text = F.col(response)
    parsed = df.withColumns({"value": J.strict_variant(text), "block": J.json_block(text)})
    block_value = F.when(F.col("block") == text, F.col("value")).when(
        F.col("block") != "", J.strict_variant(F.col("block"))
    )
    parsed = parsed.withColumn("block_value", block_value)
    values = ["value", "block_value"]
    if expected_answer is not None:
        target = F.col(expected_answer)
        target = swap_quotes(target) if printed_target else target
        parsed = parsed.withColumn("expected_value", J.strict_variant(target))
        values.append("expected_value")
    for value in values:
        parsed = read_actions(parsed, value)
    return parsed


def swap_quotes(text: Column) -> Column:
    """Single quotes to double ones, how a target in printed-dict form is read."""
    return F.replace(text, F.lit("'"), F.lit('"'))


def _match(same: Column) -> Column:
    return F.when(same, F.lit(C.MATCH)).otherwise(F.lit(C.MISMATCH))


def _same_other(a: Column, b: Column) -> Column:
    """Equal JSON texts, or equal numbers not both written as whole ones, whose texts tell more than a double does."""
    whole = r"^-?\d+$"
    numbers = a.try_cast("double") == b.try_cast("double")
    return a.eqNullSafe(b) | F.coalesce(numbers & ~(a.rlike(whole) & b.rlike(whole)), F.lit(False))


def score_action(response: str = "response") -> Column:
    """E3. Both sides parsed; the two actions have to be the same JSON value, type included. Numbers compare by value."""
    value, expected = F.col("value_fault"), F.col("expected_value_fault")
    same = F.col("value_text").eqNullSafe(F.col("expected_value_text")) & _same_other(
        F.col("value_other"), F.col("expected_value_other")
    )
    return (
        F.when(F.col(response).isNull(), F.lit(C.MISSING_RESPONSE))
        .when(expected == C.BAD_JSON, F.lit(C.BAD_JSON))
        .otherwise(F.coalesce(value, expected, _match(same)))
    )


def score_extracted(response: str = "response", expected: str = "expected_action") -> Column:
    """E4. First "{" to last "}" of the response; missing keys are a mismatch without prediction."""
    fault = F.col("block_value_fault")
    return (
        F.when(F.col(response).isNull(), F.lit(C.MISSING_RESPONSE))
        .when(F.col("block") == "", F.lit(C.NO_JSON))
        .when(fault != C.MISSING_KEY, fault)
        .otherwise(_match(F.col("block_value_text") == F.col(expected)))
    )


def predicted_action() -> Column:
    """E4. The action the response names, or the marker that says why there is none."""
    other = F.col("block_value_other")
    return (
        F.when(F.col("block").isNull(), F.lit(None))
        .when(F.col("block") == "", F.lit(C.NO_JSON_MARKER))
        .when(F.col("block_value").isNull(), F.lit(C.BAD_JSON_MARKER))
        .otherwise(F.coalesce("block_value_text", F.when(other != "null", other)))
    )


def score_direct(response: str = "response", expected: str = "expected_action") -> Column:
    """E5. The whole response has to parse and hold both keys."""
    return F.when(F.col(response).isNull(), F.lit(C.MISSING_RESPONSE)).otherwise(
        F.coalesce("value_fault", _match(F.col("value_text") == F.col(expected)))
    )


def score_schema(response: str = "response") -> Column:
    """E6 as a scorer."""
    return (
        F.when(F.col(response).isNull(), F.lit(C.MISSING_RESPONSE))
        .when(F.col("value").isNull(), F.lit(C.BAD_JSON))
        .when(J.conforms(F.col("value")), F.lit(C.MATCH))
        .otherwise(F.lit(C.BAD_STRUCTURE))
    )


def _outcome(reason: Column) -> Column:
    return F.struct((reason == C.MATCH).alias("passed"), reason.alias("reason"))


def _outcome_if_read(reason: Column) -> Column:
    """Unknown instead of failed where the response could not be read."""
    read = reason.isin(C.MATCH, C.MISMATCH, C.MISSING_RESPONSE)
    return F.struct(F.when(read, reason == C.MATCH).alias("passed"), reason.alias("reason"))


@dataclass(frozen=True)
class Scorer:
    """M3. A named result per parsed row and how it becomes struct<passed, reason>."""

    name: str
    result: Callable[[], Column]
    outcome: Callable[[Column], Column] = _outcome


ACTION = Scorer("action", score_action)
EXTRACTED = Scorer("extracted", score_extracted)
DIRECT = Scorer("direct", score_direct, _outcome_if_read)
SCHEMA = Scorer("schema", score_schema)


def python_scorer(
    name: str, test: Callable[[str, str, str], None], prompt: str, response: str, expected: str
) -> Scorer:
    """M3. A supplied test function that raises AssertionError when the response fails.

    Any other exception fails that row only and is kept as its reason.
    """

    @F.pandas_udf(PASSED_REASON)
    def run(prompts: pd.Series, responses: pd.Series, wanted: pd.Series) -> pd.DataFrame:
        def one(row: tuple) -> tuple[bool, str]:
            try:
                test(*row)
            except AssertionError as failure:
                return False, str(failure) or C.MISMATCH
            except Exception as failure:
                return False, f"error: {type(failure).__name__}: {failure}"
            return True, C.MATCH

        return pd.DataFrame(
            [one(row) for row in zip(prompts, responses, wanted)], columns=["passed", "reason"]
        )

    return Scorer(name, lambda: run(prompt, response, expected), lambda result: result)


def run_scorers(parsed: DataFrame, scorers: Sequence[Scorer]) -> DataFrame:
    """A3. One struct column per scorer, all on the same responses, named like the scorer."""
    results = {f"_result_{s.name}": s.result() for s in scorers}
    outcomes = {s.name: s.outcome(F.col(f"_result_{s.name}")) for s in scorers}
    return with_columns_once(parsed.withColumns(results), outcomes).drop(*results)


def suite_metrics(scored: DataFrame, scorers: Sequence[Scorer]) -> DataFrame:
    """A1-A3. suite, passed, total, accuracy; one pass over the rows, whatever the number of suites."""
    sums = [
        F.struct(
            F.lit(s.name).alias("suite"),
            F.count_if(F.col(s.name)["passed"]).alias("passed"),
            F.count("*").alias("total"),
        )
        for s in scorers
    ]
    return with_accuracy(scored.agg(F.array(*sums).alias("_s")).select(F.inline("_s")))


def pass_rate(results: DataFrame, by: Sequence[str] = (), passed: str = "passed") -> DataFrame:
    """A1/A2. Passed, total and accuracy; without rows the total is 0 and so is the accuracy."""
    counts = [F.count_if(F.col(passed)).alias("passed"), F.count("*").alias("total")]
    return with_accuracy(results.groupBy(*by).agg(*counts))


# For each h, which way h + 1/2 hundredths go as a double: by its exact value, a true half to even.
_HALF_GOES_UP = [
    (Decimal((2 * h + 1) / 200), h % 2) > (Decimal(2 * h + 1) / 200, 0) for h in range(100)
]


def two_decimals(passed: Column, total: Column) -> Column:
    """passed/total with two decimals as printf gives it for the quotient.

    format_string rounds halves of the shortest decimal upwards and would show 1/8 as 0.13.
    """
    hundredths = F.call_function("div", passed * 100, total)
    twice_rest = 2 * (passed * 100 - hundredths * total)
    half_up = F.coalesce(F.get(F.lit(_HALF_GOES_UP), hundredths.cast("int")), F.lit(False))
    goes_up = (twice_rest > total) | ((twice_rest == total) & half_up)
    shown = hundredths + goes_up.cast("int")
    text = F.concat(F.call_function("div", shown, F.lit(100)), F.lit("."), F.lpad((shown % 100).cast("string"), 2, "0"))
    return F.when(total > 0, text).otherwise(F.lit("0.00"))


def with_accuracy(counts: DataFrame) -> DataFrame:
    """A1. accuracy, 0 without rows, and how it is shown: rate and counts."""
    passed, total = F.col("passed"), F.col("total")
    accuracy = F.coalesce(F.try_divide(passed.cast("double"), total), F.lit(0.0))
    counted = F.concat(F.lit(" ("), passed, F.lit("/"), total, F.lit(")"))
    shown = F.concat(two_decimals(passed, total), counted)
    return counts.withColumn("accuracy", accuracy).withColumn("shown", shown)


def results_table(parsed: DataFrame, prompt: str, response: str, expected: str) -> DataFrame:
    """E4. prompt, expected, predicted, full_response, passed and reason."""
    results = parsed.withColumns(
        {"_reason": score_extracted(response, expected), "_predicted": predicted_action()}
    )
    made = {
        "prompt": F.col(prompt),
        "expected": F.col(expected),
        "predicted": F.col("_predicted"),
        "full_response": F.col(response),
        "passed": F.col("_reason") == C.MATCH,
        "reason": F.col("_reason"),
    }
    return with_columns_once(results, made).select(*made)


def failures(results: DataFrame) -> DataFrame:
    """E12. What did not pass, including rows whose outcome is unknown."""
    return results.filter(~F.coalesce("passed", F.lit(False)))


def judge_gate(examples: DataFrame, scores: DataFrame, on: str, score: str, threshold: float = C.JUDGE_THRESHOLD) -> DataFrame:
    """E9. A judge's score per example against the threshold; no score is no pass."""
    return align(examples, scores, on).withColumn(
        "passed", F.coalesce(F.col(score) >= threshold, F.lit(False))
    )
