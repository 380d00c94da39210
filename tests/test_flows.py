from pyspark.sql import functions as F

from talkloom.operators import scoring as S
from talkloom.operators.dialogs import expand_dialogs
from talkloom.operators.tokens import build_vocab
from talkloom.plans import flows


def test_training_rows_have_one_length(spark):
    turns = [(1, 0, "user", "open it"), (1, 1, "assistant", "done " * 60), (2, 0, "user", "hi"), (2, 1, "assistant", "yo")]
    examples = expand_dialogs(
        spark.createDataFrame(turns, "conv_id int, turn int, role string, text string"), ["x"], F.lit("x"), "be kind"
    )
    texts = flows.chat_texts(flows.build_sft(examples))
    assert all(r.text.startswith("<s>system\nbe kind</s><s>user\n") for r in texts.collect())
    rows = flows.training_rows(texts, build_vocab(texts, "text", 50), 60).orderBy("conv_id").collect()
    assert [len(r.input_ids) for r in rows] == [60, 60] == [len(r.attention_mask) for r in rows]
    assert sum(rows[0].attention_mask) == 60 and 0 < sum(rows[1].attention_mask) < 60
    assert set(rows[1].input_ids[sum(rows[1].attention_mask) :]) == {3}


def test_evaluation_asks_once_and_reports(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def make():
        def client(texts):
            calls.add(len(texts))
            return [{"p0": '{"Content":{"Action":"A"}}', "p1": 'so {"Content":{"Action":"A"}}'}.get(t) for t in texts]

        return client

    requests = spark.range(3).selectExpr(
        "id as example_id", "concat('p', id) as prompt", "'A' as expected_action",
        """'{"MessageText":"","Content":{"Action":"A"}}' as expected_answer""",
    )
    metrics = flows.evaluate(requests, make, str(tmp_path / "run"), [S.ACTION, S.EXTRACTED, S.DIRECT, S.SCHEMA])
    got = {r.suite: (r.passed, r.total) for r in metrics.collect()}
    assert got == {"action": (1, 3), "extracted": (2, 3), "direct": (1, 3), "schema": (0, 3)}
    assert calls.value == 3
    failed = S.failures(spark.read.parquet(str(tmp_path / "run" / "results"))).filter("suite = 'extracted'").collect()
    assert [(r.prompt, r.reason, r.error) for r in failed] == [("p2", "missing_response", "no choice returned")]
