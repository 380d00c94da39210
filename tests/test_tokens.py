import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from talkloom.functions import arrays as A
from talkloom.operators import tokens as T

TEXTS = [(0, "the cat and the dog"), (1, ""), (2, None), (3, " the\tend\n\n é \U0001f600 the"), (4, "cat dog zebra the")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(TEXTS, "id int, text string").repartition(3)


def brute_vocab(size):
    counts = Counter(t for _, text in TEXTS if text for t in re.findall(T.WORD, text))
    order = sorted(counts, key=lambda t: (-counts[t], t.encode()))[:size]
    return {t: i + 4 for i, t in enumerate(order)}


def brute_encode(size):
    ids = brute_vocab(size)
    return {i: None if text is None else [ids.get(t, 0) for t in re.findall(T.WORD, text)] for i, text in TEXTS}


@pytest.mark.parametrize("size", [1, 3, 100])
def test_vocab_and_encode(docs, size):
    vocab = T.build_vocab(docs, "text", size)
    assert {r.token: r.token_id for r in vocab.table.collect()} == brute_vocab(size)
    got = {r.id: r.ids for r in T.encode(docs, vocab, {"text": "ids"}).collect()}
    assert got == brute_encode(size)


def test_large_vocabulary_is_the_same(docs):
    vocab = T.build_vocab(docs, "text", 300_000)
    got = {r.id: r.ids for r in T.encode(docs, vocab, {"text": "ids"}).collect()}
    assert got == brute_encode(300_000)
    marked = T.encode(docs, vocab, {"text": "ids"}, add_special=True).filter("id = 1").first()
    assert marked.ids == [vocab.special_id("<s>")]
    pairs = docs.select(F.col("text").alias("s"), F.col("text").alias("u"))
    assert T.encode_context(pairs, vocab, "s", "u").count() == docs.count()


def test_limit_is_truncation(docs):
    vocab = T.build_vocab(docs, "text", 3)
    got = {r.id: r.ids for r in T.encode(docs, vocab, {"text": "ids"}, limit=2).collect()}
    assert got == {i: ids and ids[:2] for i, ids in brute_encode(3).items()}


def test_special_ids_are_optional(docs):
    vocab = T.build_vocab(docs, "text", 3)
    marked = {r.id: r.ids for r in T.encode(docs, vocab, {"text": "ids"}, add_special=True).collect()}
    assert marked == {i: None if ids is None else [1, *ids] for i, ids in brute_encode(3).items()}


def test_pad_token_is_added_once(spark, docs):
    assert T.add_pad_token(["a"]) == ("a", "<|pad|>") and T.add_pad_token(["<|pad|>", "a"]) == ("<|pad|>", "a")
    entries = T.build_vocab(docs, "text", 2).with_specials().collect()
    assert sorted(r.token_id for r in entries) == [0, 1, 2, 3, 4, 5]


def test_encoding_shuffles_no_text(docs):
    plan = T.encode(docs, T.build_vocab(docs, "text", 3), {"text": "ids"})
    tree = plan._jdf.queryExecution().optimizedPlan().toString()
    outer = tree.split("scalar-subquery")[0]
    assert "Join" not in tree and "Generate" not in outer


def test_supplied_tokenizer(docs):
    def make():
        return lambda text: [len(w) for w in text.split()]

    got = {r.id: r.ids for r in T.encode_with(docs, make, "text", "ids").collect()}
    assert got[0] == [3, 3, 3, 3, 3] and got[1] == [] and got[2] is None


def _first(spark, ids, column):
    return spark.createDataFrame([(ids,)], "ids array<int>").select(column).first()[0]


@pytest.mark.parametrize("n", [0, 3, 4, 5])
def test_cut_pad_mask(spark, n):
    ids = list(range(10, 10 + n))
    cut = A.truncate_right(F.col("ids"), 4)
    assert _first(spark, ids, cut) == ids[:4]
    assert _first(spark, ids, A.pad_right(cut, 4, 9)) == (ids + [9] * 4)[:4]
    assert _first(spark, ids, A.attention_mask(cut, 4)) == [1] * min(n, 4) + [0] * max(0, 4 - n)
    assert _first(spark, ids, A.keep_last(F.col("ids"), 4)) == ids[-4:]


@pytest.mark.parametrize("ids, out", [([], [2]), ([5], [5, 2]), ([5, 2], [5, 2]), ([5, 6, 7], [5, 6, 7])])
def test_eos_once_and_only_if_it_fits(spark, ids, out):
    assert _first(spark, ids, A.append_eos(F.col("ids"), 2, 3)) == out


def test_context(spark, docs):
    vocab = T.build_vocab(docs, "text", 100)
    pairs = spark.createDataFrame([("the cat", "dog"), (None, "the")], "s string, u string")
    ids = brute_vocab(100)
    whole = [1, 1788, 13, ids["the"], ids["cat"], 2, 1, 1404, 13, ids["dog"], 2, 1, 9225, 13]
    for n_ctx in (5, 13, 14, 15):
        row = T.encode_context(pairs, vocab, "s", "u", n_ctx, notice="cut").filter("s is not null").first()
        assert row.notice == ("cut" if n_ctx < 14 else None)
        assert (row.context, row.n_tokens, row.over_context) == (whole[-n_ctx:], 14, n_ctx < 14)


def test_limits():
    assert A.limit_or_model(None, 7) == A.limit_or_model("None", 7) == 7 and A.limit_or_model("5", 7) == 5


def test_length_profile(spark):
    df = spark.createDataFrame([(n,) for n in (1, 1, 2, 10)], "n long")
    row = T.length_profile(df, "n", [1, 10]).first()
    assert (row.n_rows, row.min_len, row.max_len, row.sum_len, row.p50, row.over_1, row.over_10) == (4, 1, 10, 14, 1.5, 2, 0)
