from collections import Counter

import pytest

import corpus_pipeline
from talkloom.llm import toxicity
from test_lines import plain_dedup
from test_simhash import plain_components, plain_fingerprint


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    from talkloom.llm.tables import written

    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    out.append(docs)
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, sf_dir))
        out.append(docs)
    return out


def test_every_stage_on_its_own_input(spark, sf_dir, stages):
    rows = [s.collect() for s in stages]
    assert all(s.columns == stages[0].columns for s in stages[:5])
    model = toxicity.train(stages[0], spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(stages[0], model).collect()}
    assert {r["doc_id"] for r in rows[1]} == {d for d, s in scores.items() if s < 0.5}
    assert sorted(((r["doc_id"], r["text"]) for r in rows[2]), key=str) == plain_dedup([(r["doc_id"], r["text"]) for r in rows[1]])
    assert all(r["n_chars"] == len(r["text"]) for r in rows[2])
    group = plain_components([(r["doc_id"], plain_fingerprint(r["text"])) for r in rows[2]])
    assert sorted(r["doc_id"] for r in rows[3]) == sorted({c for c in group.values()})
    before = {r["doc_id"]: tuple(r) for r in rows[3]}
    assert all(tuple(r) == before[r["doc_id"]] for r in rows[4])
    assert max(Counter(r["doc_id"] for r in rows[4]).values()) <= 2
    assert sorted((r["doc_id"], r["text"]) for r in rows[4]) == sorted((r["doc_id"], r["decoded"]) for r in rows[5])


def test_run_applies_the_stages(spark, sf_dir, stages):
    got = corpus_pipeline.run(spark, sf_dir)
    assert got.columns == stages[-1].columns
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(r["doc_id"] for r in stages[-1].collect())
