"""Columns named as the helper columns of the pipeline's operators change nothing."""

import pytest

from talkloom.llm import lines, mixing, simhash, toxicity

CLASHING = ["_n", "node", "root", "_fp", "_root", "_row", "_shard", "_id", "_copy", "_times", "_source", "extra0", "fp", "size", "a.b"]
TEXTS = ["one two three four five six", "one two three four five six", "alpha beta gamma delta\nline of words here", None, "", "other words in this text"]


def frame(spark, names):
    rows = [(i % 5, t, f"s{i % 2}", len(t or ""), *(f"{n}{i}" for n in names)) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, ["doc_id", "text", "source", "n_chars", *names])


@pytest.mark.parametrize("work", [lines.dedup, simhash.representatives, mixing.mixed_documents])
def test_clashing_names(spark, work):
    plain, got = work(frame(spark, [])), work(frame(spark, CLASHING))
    assert got.columns == ["doc_id", "text", "source", "n_chars", *CLASHING]
    rows = [tuple(r) for r in got.collect()]
    assert sorted((r[:4] for r in rows), key=str) == sorted((tuple(r) for r in plain.collect()), key=str)
    for r in rows:
        assert len({v.removeprefix(n) for n, v in zip(CLASHING, r[4:], strict=True)}) == 1


def test_toxicity_keeps_them(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(5)], "doc_id long, toxic int")
    docs = frame(spark, CLASHING)
    kept = toxicity.clean_documents(docs, toxicity.train(docs, labels), 2.0)
    assert kept.columns == docs.columns and kept.count() == len(TEXTS)
