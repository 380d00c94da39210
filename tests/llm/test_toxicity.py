import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from talkloom.llm import buffers, q_toxicity, toxicity

DOCS = "doc_id long, text string, score double, spans string"
LABELS = "doc_id long, toxic int, quality int"


def test_marginals_equal_the_sum_over_all_paths():
    rng = np.random.default_rng(0)
    chain = rng.normal(size=4)
    rows = np.array([0] * 5 + [1] + [2] * 4)
    emission = rng.normal(size=len(rows)) * 2
    got, pair = toxicity.marginals(emission, rows, chain, 0.3)
    trans = np.exp(chain).reshape(2, 2)
    for row in range(3):
        at = np.flatnonzero(rows == row)
        total, toxic, steps = 0.0, np.zeros(len(at)), np.zeros((len(at), 4))
        for path in itertools.product((0, 1), repeat=len(at)):
            p = toxicity._START[path[0]]
            for i, s in enumerate(path):
                p *= np.exp((emission[at[i]] + 0.3) * s) * (trans[path[i - 1], s] if i else 1)
            total += p
            toxic += p * np.array(path)
            for i in range(1, len(path)):
                steps[i, path[i - 1] * 2 + path[i]] += p
        assert got[at] == pytest.approx(toxic / total)
        assert pair[at] == pytest.approx(steps / total)


def made(n, seed):
    rng = random.Random(seed)
    words = ["river", "stone", "quiet", "garden", "winter", "letter", "Été", "moving"]
    bad = ["vilething", "nastyone", "rottenly"]
    docs, labels = [], []
    for i in range(n):
        text = [rng.choice(words) + rng.choice(["", "s", "ing", "er"]) for _ in range(rng.randrange(1, 80))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                text.insert(rng.randrange(len(text) + 1), rng.choice(bad))
        docs.append((i, " ".join(text), 0.5, "x"))
        labels.append((i, int(toxic), 1))
    return docs, labels


def test_offending_offsets_and_held_out_accuracy(spark):
    docs, labels = made(600, 1)
    frame = spark.createDataFrame(docs, DOCS)
    model = toxicity.train(frame, spark.createDataFrame(labels, LABELS))
    got = {r["doc_id"]: r for r in toxicity.score(frame, model).collect()}
    truth = {i: t for i, t, _ in labels}
    assert np.mean([(got[i]["score"] >= 0.5) == bool(truth[i]) for i in got if i % 4]) > 0.98
    found = {docs[i][1][int(a) : int(b)] for i in got for a, b in (s.split(":") for s in got[i]["spans"].split(",") if s)}
    assert {"vilething", "nastyone", "rottenly"} <= found
    kept = {r["doc_id"] for r in toxicity.clean_documents(frame, model).collect()}
    assert kept == {i for i in got if got[i]["score"] < 0.5}


def test_query_on_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = q_toxicity.op9_toxicity(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert np.mean([r["predicted"] == r["toxic"] for r in rows]) > 0.95
    assert np.mean([r["predicted"] for r in rows if r["toxic"] == 0]) < 0.03


def test_edges(spark):
    none = spark.createDataFrame([], DOCS)
    no_labels = spark.createDataFrame([], LABELS)
    assert toxicity.score(none, toxicity.train(none, no_labels)).count() == 0
    docs, labels = made(200, 2)
    docs += [(900, None, 0.0, None), (901, "", 0.0, None), (902, "word " * 100_000, 0.0, None), (902, "word " * 100_000, 0.0, None), (None, "garden", None, None)]
    frame = spark.createDataFrame(docs, DOCS)
    model = toxicity.train(frame, spark.createDataFrame([*labels, (None, 1, 1), (5, None, 1)], LABELS))
    got = [(r["doc_id"], r["score"], r["spans"]) for r in toxicity.score(frame, model).collect() if r["doc_id"] is None or r["doc_id"] >= 900]
    assert len(got) == 5 and all(0 <= s < 0.5 and spans == "" for _, s, spans in got)
    assert toxicity.clean_documents(frame, model).columns == frame.columns
    assert all(r["score"] < 0.01 for r in toxicity.score(frame, toxicity.train(frame, no_labels)).collect())


def test_words_lie_within_texts():
    texts = buffers.from_arrow(pa.array(["ab c", None, "", "cé d ", "x"]))
    found = buffers.words(texts)
    assert list(found.rows) == [0, 0, 3, 3, 4]
    assert [bytes(texts.data[a:b]).decode() for a, b in zip(found.starts, found.ends, strict=True)] == ["ab", "c", "cé", "d", "x"]
    hasher = buffers.Hasher(texts.data)
    assert hasher(found.starts[1:2], found.ends[1:2]) == buffers.Hasher(np.frombuffer(b"c", np.uint8))(np.array([0]), np.array([1]))
    assert [len(c) for c in buffers.chunks(texts, 4)] == [3, 1, 1]
