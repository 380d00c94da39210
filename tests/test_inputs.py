"""Tables the registered queries start from."""

from talkloom.plans import evaluation, inputs


def test_long_conversations_share_no_example_id(spark, tmp_path):
    rows = [(c, t, role, f"{c}.{t} \"{{x}}\\n") for c, t, role in [(1, 1000, "user"), (1, 1001, "assistant"), (2, 0, "user"), (2, 1, "assistant")]]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    made = inputs.responses(spark, str(tmp_path)).collect()
    assert len({r.example_id for r in made}) == len(made) == 2
    assert evaluation.eval_align(spark, str(tmp_path)).count() == 2
    assert evaluation.grpo_rewards(spark, str(tmp_path)).count() == 4
