import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from talkloom.llm import q_spelling, spelling

DOCS = "doc_id long, text string, word string, home int"


def plain_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_words(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{doc_id}:{run}".encode()) if doc_id is not None else 1
            if h % 31 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}


def plain_variants(n):
    by_length = {}
    for w in n:
        by_length.setdefault(len(w), []).append(w)
    near = {w: [o for k in (len(w) - 1, len(w), len(w) + 1) for o in by_length.get(k, []) if plain_edit(w, o)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n}


def rows_of(frame):
    assert frame.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return [tuple(r) for r in frame.collect()]


def test_query_equals_brute_force(spark, sf_dir):
    got = rows_of(q_spelling.op13_spelling(spark, sf_dir))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = plain_variants(plain_words([tuple(r) for r in docs]))
    assert len(got) == len(set(got)) == len(want) > 500 and set(got) == want
    assert sum(r[1] is not None for r in got) > 5


def corpus():
    rng = np.random.default_rng(3)
    base = ["".join(rng.choice(list("abcdeghé"), 8)) for _ in range(40)]
    words = [(base[0], 2000), (base[0] + "s", 200), (base[0] + "st", 20), (base[0] + "sta", 2)]  # a chain of forms
    words += [(b, 30) for b in base[1:]] + [(b[:-1], 3) for b in base[1:]] + [(b[::-1], 2) for b in base[1:]]
    words += [("z" * 300, 3), ("z" * 301, 40), ("ab" * 2000, 2), ("ab" * 2000 + "c", 25), ("sixsix", 50), ("sevenxx", 1)]
    return list(dict(words).items())


@pytest.mark.parametrize(("tile", "near_words", "classes"), [(2048, 16_384, 3), (2, 3, 5), (2048, 16_384, 1)])
def test_tiles_and_classes_change_nothing(spark, monkeypatch, tile, near_words, classes):
    monkeypatch.setattr(spelling, "TILE_WORDS", tile)
    monkeypatch.setattr(spelling, "NEAR_WORDS", near_words)
    words = [(w, n) for w, n in corpus() if len(w) >= 7 and n >= 2]
    frame = spark.createDataFrame(words, "word string, n long")
    got = rows_of(spelling.variants(frame, classes=classes))
    assert len(got) == len(words) and set(got) == plain_variants(dict(words))
    assert max(len({r[0] for r in got if r[2] == root}) for root in {r[2] for r in got}) >= 4


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abcé", min_size=3, max_size=3), min_size=1, max_size=6), st.lists(st.text("abcé", min_size=3, max_size=4), min_size=1, max_size=6))
def test_close_pairs(left, right):
    got = set(zip(*(x.tolist() for x in spelling.close_pairs(left, right)), strict=True))
    assert got == {(i, j) for i, a in enumerate(left) for j, b in enumerate(right) if plain_edit(a, b)}


def test_edges(spark):
    none = spark.createDataFrame([], DOCS)
    assert rows_of(spelling.variants(spelling.counted(none, q_spelling.slipped))) == []
    texts = [(1, None), (2, ""), (None, "Wonderful wonderful WONDERFUL"), (3, "wonderfull wonderfull Électricité Électricité ××××××× ×××××××"), (3, "wonderfull " * 40)]
    frame = spark.createDataFrame([(d, t, "x", 1) for d, t in texts] * 2, DOCS)
    got = rows_of(spelling.variants(spelling.counted(frame, q_spelling.slipped)))
    assert set(got) == plain_variants(plain_words(texts * 2)) and len(got) >= 4
