import hashlib
import random

import numpy as np
import pytest

from talkloom.llm import passages, q_passages

DOCS = "doc_id long, text string, n_bytes string, bucket int"


def plain(docs, length=50):
    first = {}
    raw = [(d, (t or "").encode()) for d, t in docs]
    big = 1 << 62
    for d, b in raw:
        for i in range(len(b) - length + 1):
            s = b[i : i + length]
            first[s] = min(first.get(s, big), big if d is None else d)
    out = []
    for d, b in raw:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if first[b[i : i + length]] < (big if d is None else d):
                gone[i : i + length] = True
        spans = int((gone[:-1] & ~np.append(False, gone[:-2])).sum()) if len(b) else 0
        kept = bytes(np.frombuffer(b, np.uint8)[~gone[:-1]])
        out.append((d, len(b), int(gone[:-1].sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(frame, **options):
    return sorted((tuple(r)[:5] for r in passages.removed(frame, **options).collect()), key=str)


@pytest.mark.parametrize("many", [1, 4096])
def test_random_passages(spark, many):
    rng = random.Random(many)
    pool = ["".join(rng.choices("abé ", k=rng.randrange(20, 140))) for _ in range(12)] + ["a" * 300, "ab" * 90, "x" * 49, "y" * 50]
    docs = [(i // 2 if i % 9 == 0 else i, "".join(rng.choice(pool) if rng.random() < 0.7 else "".join(rng.choices("qwe", k=30)) for _ in range(rng.randrange(0, 5)))) for i in range(120)]
    frame = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], DOCS)
    assert got(frame, many_docs=many, shard_bytes=3000) == plain(docs)
    assert got(frame, many_docs=many) == plain(docs)


def test_query_on_the_table(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert sorted(map(tuple, q_passages.op3_passages(spark, sf_dir).collect()), key=str) == plain(docs)


def test_edges(spark):
    assert passages.removed(spark.createDataFrame([], DOCS)).count() == 0
    long = "".join(random.Random(1).choices("abcdefg ", k=1_500_000))
    docs = [(1, None), (2, ""), (3, "z" * 50), (4, "z" * 50), (4, "z" * 60), (None, "z" * 51), (7, long[:3000]), (8, "é" * 40)]
    frame = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], DOCS)
    assert got(frame) == plain(docs)
    two = spark.createDataFrame([(1, long, "x", 1), (2, long, "x", 1)], DOCS)
    assert [r["n_removed"] for r in passages.removed(two).orderBy("doc_id").collect()] == [0, len(long)]


def test_refinement_tells_suffixes_apart_to_the_length():
    rng = np.random.default_rng(0)
    data = rng.integers(97, 99, 6000).astype(np.uint8)
    data[3000:4000] = data[1000:2000]
    data[4000:4400] = 97
    suffixes = np.arange(len(data) - 50)
    pointer = passages.refined(data, suffixes)
    names = {}
    for s, p in zip(suffixes, pointer, strict=True):
        assert names.setdefault(data[s : s + 50].tobytes(), p) == p
    assert len(set(names.values())) == len(names)
