import random

import numpy as np
import pytest

from talkloom.llm import q_sentencepiece
from talkloom.llm import sentencepiece as sp

DOCS = "doc_id long, text string, ids string, decoded int"


@pytest.fixture(scope="module")
def codec():
    with open(sp.MODEL, "rb") as file:
        return sp.Codec(file.read())


def whole_search(codec, text):
    """Best path over the whole text at once."""
    text = (" " + text if codec.prefix and text else text).replace(" ", sp.SPACE)
    best = [(0.0, 0)]
    for end in range(1, len(text) + 1):
        tried = []
        for start in range(max(0, end - codec.longest), end):
            hit = codec.pieces.get(text[start:end])
            if hit or start == end - 1:
                tried.append((best[start][0] + (hit[1] if hit else codec.unknown_score), -start))
        score, start = max(tried)
        best.append((score, -start))
    out, end = [], len(text)
    while end:
        start = best[end][1]
        hit = codec.pieces.get(text[start:end])
        out[:0] = [hit[0]] if hit else codec._spelt(text[start:end])
        end = start
    return out


def ids_of(codec, text):
    return np.frombuffer(codec.encode(text), np.int32).tolist()


def test_equals_a_search_over_whole_texts(codec):
    rng = random.Random(2)
    alphabet = ["a", "the", "ing", " ", "  ", "\n", "é", "漢", "🙂", "\t", "Z", "1", "____", "er", "tion", sp.SPACE]
    for _ in range(400):
        text = "".join(rng.choices(alphabet, k=rng.randrange(0, 60)))
        assert ids_of(codec, text) == whole_search(codec, text.replace(sp.SPACE, " "))


def test_streaming_over_texts_without_spaces(codec):
    rng = random.Random(4)
    text = "".join(rng.choices(["ab", "the", "x", "in", "é", "漢", "==", "0"], k=3000))
    assert ids_of(codec, text) == whole_search(codec, text)
    assert ids_of(codec, "a" * 5000) == whole_search(codec, "a" * 5000)


def test_the_library_decodes_the_ids(codec):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=sp.MODEL)
    for text in ["Hello world", "  two  spaces ", "tab\tand\nline é 漢 🙂"]:
        assert lib.decode(ids_of(codec, text)) == text


def test_query_gives_texts_back(spark, sf_dir, codec):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = q_sentencepiece.op1_sentencepiece(spark, sf_dir).collect()
    assert {r["doc_id"]: r["decoded"] for r in got} == texts
    assert all(r["n_ids"] == len(r["ids"]) for r in got)
    short = [r for r in got if len(texts[r["doc_id"]]) < 1500][:20]
    assert all(r["ids"] == whole_search(codec, texts[r["doc_id"]]) for r in short)


def test_edges(spark):
    assert sp.round_trip(spark.createDataFrame([], DOCS)).count() == 0
    rows = [(None, None, "x", 1), (1, "", "x", 1), (1, " ", "x", 1), (2, "word" * 20_000, "x", 1), (2, "word" * 20_000, "x", 1)]
    got = sp.round_trip(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((r["decoded"] for r in got), key=len) == ["", "", " ", "word" * 20_000, "word" * 20_000]
    assert [r["ids"] for r in got if r["decoded"] == ""] == [[], []]
