"""Rewards of sampled completions and their advantage within a prompt."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkloom import constants as C
from talkloom.functions import strict_json as J
from talkloom.operators import skew
from talkloom.operators.once import with_columns_once
from talkloom.operators.scoring import read_actions

Reward = Callable[[DataFrame], DataFrame]


def action_reward(value: str, expected: str) -> Column:
    """E10. 1 for the expected action, 0 for another or none, -1 for what cannot be read as one.

    Reads the columns that scoring.read_actions makes of `value`.
    """
    return (
        F.when(F.col(f"{value}_fault").isin(C.BAD_JSON, C.BAD_STRUCTURE), F.lit(C.REWARD_UNPARSABLE))
        .when(F.col(f"{value}_text") == F.col(expected), F.lit(C.REWARD_MATCH))
        .otherwise(F.lit(C.REWARD_MISMATCH))
    )


def reward_action(
    completions: DataFrame,
    targets: DataFrame,
    on: str = "prompt_id",
    text: str = "completion",
    task_rows: int = skew.TASK_ROWS,
) -> DataFrame:
    """E10. Add `reward`; `targets` has one `correct_action` per prompt, completions many."""
    parsed = read_actions(completions.withColumn("value", J.strict_variant(F.col(text))), "value")
    joined = skew.join_unique(parsed, targets.select(on, "correct_action"), on, task_rows=task_rows)
    rewarded = with_columns_once(joined, {"reward": action_reward("value", "correct_action")})
    return rewarded.select(*completions.columns, "correct_action", "reward")


def apply_reward(completions: DataFrame, reward: Reward) -> DataFrame:
    """M4. Any supplied DataFrame-to-DataFrame reward."""
    return completions.transform(reward)


def group_advantage(
    rewards: DataFrame,
    group: str = "prompt_id",
    eps: float = 1e-4,
    ddof: int = 1,
    task_rows: int = skew.TASK_ROWS,
) -> DataFrame:
    """E11. (reward - mean) / (deviation + eps) within a group, 0 for a group of one.

    Group statistics are combined before the shuffle and joined back, so the completions of one
    prompt are never gathered in a task, however many. The rewards are read more than once: give a
    written table if making them is costly.
    """
    deviation = F.stddev_samp("reward") if ddof == 1 else F.stddev_pop("reward")
    stats = rewards.groupBy(group).agg(
        F.avg("reward").alias("group_mean"), F.coalesce(deviation, F.lit(0.0)).alias("group_std")
    )
    centred = F.col("reward") - F.col("group_mean")
    advantage = F.coalesce(F.try_divide(centred, F.col("group_std") + eps), F.lit(0.0))
    return skew.join_unique(rewards, stats, group, task_rows=task_rows).withColumn("advantage", advantage)
