import pytest
from pyspark.sql import functions as F

from talkloom.operators import rewards, skew


@pytest.fixture(scope="module")
def completions(spark):
    """A third of the completions belong to prompt 0; some prompts have no target."""
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") == 1, None).otherwise(F.col("id") % 40)
    text = F.when(F.col("id") % 7 == 0, "x").when(F.col("id") % 2 == 0, '{"Content":{"Action":"A"}}').otherwise("{}")
    return spark.range(300).select(key.alias("prompt_id"), "id", text.alias("completion"))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_keys_give_the_plain_join(spark, completions, how):
    right = spark.range(35).select(F.col("id").alias("prompt_id"), (F.col("id") * 2).alias("v"))
    plain = completions.join(right, "prompt_id", how)
    order = lambda df: sorted(map(str, df.collect()))
    for bounds in ({}, {"few": 0}, {"few_bytes": 0}, {"few": 0, "few_bytes": 0}):
        made = skew.join_unique(completions, right, "prompt_id", how, task_rows=50, **bounds)
        assert made.columns == plain.columns
        assert order(made) == order(plain)


def test_all_hot_keys_are_found(completions):
    for few in (0, 1, 100):
        hot = skew.hot_keys(completions, ["prompt_id"], 4, few).collect()
        wanted = completions.groupBy("prompt_id").count().filter("count > 4").collect()
        assert {tuple(r) for r in hot} == {tuple(r) for r in wanted} and len(hot) > 1
    assert skew.hot_keys(completions, ["prompt_id"], 300) is None


def test_rewards_and_advantages_of_a_hot_prompt(spark, completions):
    targets = spark.range(40).select(F.col("id").alias("prompt_id"), F.lit("A").alias("correct_action"))
    results = []
    for rows in (50, 1000):
        rewarded = rewards.reward_action(completions, targets, task_rows=rows)
        made = rewards.group_advantage(rewarded, task_rows=rows)
        results.append(sorted((r.id, r.reward, round(r.advantage, 9)) for r in made.collect()))
    assert results[0] == results[1] and len(results[0]) == 299
