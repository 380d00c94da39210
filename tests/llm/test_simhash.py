import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash

from talkloom.llm import q_simhash, simhash

DOCS = "doc_id long, text string, fp int, component_id string"


def plain_fingerprint(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    grams = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(rows):
    """rows: (doc_id, fingerprint)."""
    fps = sorted({f for _, f in rows})
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    array = np.array(fps, np.uint64)
    for i, f in enumerate(fps):
        for j in np.flatnonzero(np.bitwise_count(array[i + 1 :] ^ np.uint64(f)) <= 4):
            root[find(fps[i + 1 + j])] = find(f)
    least = {}
    for d, f in rows:
        least[find(f)] = min(least.get(find(f), d), d)
    return {d: least[find(f)] for d, f in rows}


def test_any_four_places_hold_a_triple():
    triples = [set(t) for t in simhash.covering()]
    assert len(triples) == 20
    assert all(any(t <= set(four) for t in triples) for four in combinations(range(8), 4))


def test_query_equals_plain_linking(spark):
    sf_dir = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    want = {d: plain_fingerprint(t) for d, t in texts.items()}
    got = q_simhash.op4_simhash(spark, sf_dir).collect()
    assert {r["doc_id"]: r["fingerprint"] for r in got} == {d: f"{f:016x}" for d, f in want.items()}
    assert {r["doc_id"]: r["component_id"] for r in got} == plain_components(list(want.items()))


@pytest.mark.parametrize("limit", [8, 2048])
def test_links_of_close_and_crowded_fingerprints(spark, monkeypatch, limit):
    rng = random.Random(limit)
    centres = [rng.getrandbits(64) for _ in range(40)] + [0]
    fps = set(centres)
    for c in centres[:5] * 60 + centres * 4:
        f = c
        for _ in range(rng.randrange(1, 7)):
            f ^= 1 << rng.randrange(64)
        fps.add(f)
    fps = sorted(fps)
    if limit < 100:
        _cut(monkeypatch, limit, fps)
    frame = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    edges = simhash.components(simhash.links(frame)).collect()
    roots = {r["node"]: r["root"] for r in edges}
    groups = {}
    for i, f in enumerate(fps):
        s = int(np.uint64(f).astype(np.int64))
        groups.setdefault(roots.get(s, s), set()).add(i)
    want = {}
    for i, c in plain_components(list(enumerate(fps))).items():
        want.setdefault(c, set()).add(i)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def _cut(monkeypatch, limit, fps):
    """A list over the limit gives the same components as one tally."""
    shared = sorted({f & ~0xFFFFFF | 0x123456 for f in fps})
    array = np.array(shared, np.uint64)
    whole = simhash._links(array, (0, 1, 2), 4)
    monkeypatch.setattr(simhash, "LIST", limit)
    cut = simhash._links(array, (0, 1, 2), 4)
    assert dict(zip(*map(np.ndarray.tolist, whole), strict=True)) == dict(zip(*map(np.ndarray.tolist, cut), strict=True))


def test_edges(spark):
    assert simhash.link(spark.createDataFrame([], DOCS)).count() == 0
    long = " ".join(f"w{i}" for i in range(50_000))
    rows = [(5, None, 1, "a"), (3, "", 1, "a"), (9, " \n ", 1, "b"), (4, long, 1, "c"), (4, long, 1, "c"), (2, long.upper(), 1, "d"), (None, "quite another text of words", 1, "e")]
    frame = spark.createDataFrame(rows, DOCS)
    got = sorted(((r["doc_id"], r["component_id"]) for r in simhash.link(frame).collect()), key=str)
    assert got == sorted([(5, 3), (3, 3), (9, 3), (4, 2), (4, 2), (2, 2), (None, None)], key=str)
    kept = simhash.representatives(frame)
    assert kept.columns == frame.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [2, 3, None]


def test_every_component_keeps_one_row(spark):
    text = lambda seed: " ".join(random.Random(seed).choices([f"w{i}" for i in range(999)], k=30))
    rows = [(None, text(i), i, "no id") for i in range(40)]
    rows += [(None, text(0), 0, "copy"), (7, text(100), 1, "one"), (7, text(101), 2, "another"), (3, text(101), 3, "smaller"), (7, text(102), 4, "third"), (None, text(102), 5, "no id")]
    kept = simhash.representatives(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(r["text"] for r in kept) == sorted({r[1] for r in rows})
    assert {r["doc_id"] for r in kept if r["text"] == text(101)} == {3}
    assert [r["doc_id"] for r in kept if r["text"] in (text(100), text(102))] == [7, 7]
