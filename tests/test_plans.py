"""What the plans of the registered queries may not contain."""

import pytest

import __spark_entry__ as entry

PYTHON = {"eval_generate"}


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_plan(spark, sf_dir, name):
    plan = entry.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    if name not in PYTHON:
        assert "Python" not in plan and "Pandas" not in plan
    if "conversations" in plan and name in ("score_action", "suite_metrics"):
        assert "PushedFilters: [IsNotNull(role), EqualTo(role,assistant)]" in plan


def test_messages_need_no_shuffle(spark, sf_dir):
    for name in ("messages_admit", "messages_replies", "score_extracted", "extract_json", "eval_failures"):
        plan = entry.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan, name


def test_only_lengths_are_shuffled_for_batches(spark, sf_dir):
    plan = entry.queries()["length_batches"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    window = plan.split("Window", 1)[1]
    assert "Project [doc_id" in window and plan.count("Window") == 1


def test_step_offsets_read_only_ids(spark, sf_dir):
    plan = entry.queries()["step_plan"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReadSchema: struct<doc_id:bigint,text:string>") == 1
    assert plan.count("ReadSchema: struct<doc_id:bigint>") == 2
