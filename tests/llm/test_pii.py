import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from talkloom.llm import pii, q_pii

DOCS = "doc_id long, text string, base string, terms int"
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def passes(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    return {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in hit.split(".")), "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]


def plain_spans(text):
    return [(kind, m.start(), m.end()) for kind, pattern in PLAIN.items() for m in re.finditer(pattern, text or "") if passes(kind, m[0])]


def spans_of(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
    rows = frame.select("i", pii.base_spans(F.coalesce("text", F.lit(""))).alias("s")).orderBy("i").collect()
    return [[(s["kind"], s["start"], s["end"]) for s in r["s"]] for r in rows]


def test_base_spans_equal_plain_matching(spark):
    rng = random.Random(3)
    bits = ["a", "Z", "9", "0", "1", ".", "@", "-", "+", "_", " ", "(", ")", "é", "🙂", "x@y.z", "255", "256", "1.2.3.4", "4111 1111 1111 1111", "+1 (017) 555-7713", "%", "00"]
    texts = ["".join(rng.choices(bits, k=rng.randrange(1, 40))) for _ in range(1500)]
    texts += [None, "", "a@b.c_x@y.z", "000255.1.1.1", "256.1.1.1.1", "4845168114407329", "4845168114407328", "1" * 20, "+12345678", "+" + "1" * 16]
    assert spans_of(spark, texts) == [plain_spans(t) for t in texts]


def test_long_runs_take_linear_time(spark):
    texts = ["a" * 300_000 + " x@y.zz " + "b" * 300_000, "1" * 400_000 + " 1.2.3.4", "@" + ".a" * 100_000, "1-" * 100_000 + "+"]
    got = spans_of(spark, texts)
    assert got[0] == [("email", 300_001, 300_007)] and got[1] == [("ip", 400_001, 400_008)] and got[2:] == [[], []]


def test_whole_query(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = q_pii.op6_pii(spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        want = ",".join(f"{k}:{a}:{b}" for k, a, b in plain_spans(texts[r["doc_id"]]))
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert r["spans"] == want or r["spans"].startswith(want)


def test_terms_that_give_an_entity_away(spark):
    rng = random.Random(0)
    filler = lambda: " ".join(rng.choice(["river", "stone", "window", "garden", "letter", "summer"]) for _ in range(12))
    docs = [(i, filler(), "b", 1) for i in range(300)]
    docs += [(1000 + i, f"{filler()} Walrusking alias stone boss@corp.example.com wrote {filler()}", "b", 1) for i in range(6)]
    docs += [(2000 + i, f"uniqueword near one@other.org {filler()}", "b", 1) for i in range(1)]
    found = {r["doc_id"]: r for r in pii.find(spark.createDataFrame(docs, DOCS)).collect()}
    assert len(found) == len(docs)
    said = lambda i: {found[i]["text"][t["start"] : t["end"]] for t in found[i]["terms"]}
    for i in range(6):
        assert {"Walrusking", "alias", "wrote"} <= said(1000 + i) and "stone" not in said(1000 + i)
    assert not said(2000) and not any(said(i) for i in range(300))
    clean = pii.find(spark.createDataFrame(docs, DOCS)).select("doc_id", pii.sanitised(F.col("text"), F.col("base"), F.col("terms")).alias("t")).filter("doc_id = 1000").first()["t"]
    assert "Walrusking" not in clean and "[EMAIL]" in clean and "stone" in clean


def test_edges(spark):
    assert pii.find(spark.createDataFrame([], DOCS)).count() == 0
    docs = [(None, None, None, None), (1, "", "x", 1), (1, "mail a@b.cd now", "x", 1), (1, "mail a@b.cd now", "x", 1)]
    got = pii.find(spark.createDataFrame(docs, DOCS)).collect()
    assert sorted(len(r["base"]) for r in got) == [0, 0, 1, 1]


@pytest.mark.parametrize("name", pii.PATTERNS)
def test_patterns_are_written_for_one_kind_each(name):
    assert name in PLAIN


def test_terms_count_and_go_in_whole_documents(spark):
    rng = random.Random(1)
    filler = lambda: " ".join(rng.choice(["river", "stone", "window", "garden", "letter", "summer"]) for _ in range(40))
    docs = [(i, filler(), "b", 1) for i in range(300)]
    docs += [(1000 + i, f"Walrusking {filler()} boss@corp.example.com {filler()} WALRUSKING, walruskings", "b", 1) for i in range(6)]
    docs += [(2000, f"a Walrusking without an address {filler()}", "b", 1)]
    found = {r["doc_id"]: [r["text"][t["start"] : t["end"]] for t in r["terms"]] for r in pii.find(spark.createDataFrame(docs, DOCS)).collect()}
    assert all(found[1000 + i] == ["Walrusking", "WALRUSKING", "walruskings"] for i in range(6))
    assert found[2000] == ["Walrusking"] and not any(found[i] for i in range(300))


def plain_disclosures(docs, support=pii.SUPPORT):
    """entity, term -> n_pair, n_term, n_entity of a corpus without copies, from the definition."""
    held, said = {}, {}
    for d, text in docs:
        spans = plain_spans(text)
        outside = text
        for kind, a, b in spans:
            value = text[a:b].lower()
            digits = re.sub("[^0-9]", "", value)
            pool = {"email": value.split("@")[-1], "ip": ".".join(value.split(".")[:3]), "card": digits[:6], "phone": digits[:-4]}[kind]
            held.setdefault(f"{kind}:{value}", set()).add(d)
            held.setdefault(f"pool:{kind}:{pool}", set()).add(d)
            outside = outside.replace(text[a:b], " ")
        for word in {w for w in re.findall(r"[^\W\d_]+", outside.lower()) if len(w) >= pii.MIN_CHARS}:
            said.setdefault(word, set()).add((d, bool(spans)))
    out = {}
    for e, of in held.items():
        for t, docs_of in said.items():
            pair, all_of = len({d for d, s in docs_of if d in of}), len(docs_of)
            if len(of) >= support and pair >= support and pair >= pii.SHARE * all_of:
                out[e, t] = (pair, all_of, len(of))
    return out


def wilson(hits, of, z):
    p = hits / of
    return (p + z * z / (2 * of) - z * (p * (1 - p) / of + z * z / (4 * of * of)) ** 0.5) / (1 + z * z / of)


def corpus(rng, n=260):
    common = ["river", "stone", "window", "garden", "letter", "summer", "bridge", "market", "winter", "forest"]
    docs = []
    for i in range(n):
        words = [rng.choice(common) for _ in range(30)] + [f"own{''.join(rng.choices('abcdefgh', k=6))}" for _ in range(6)]
        if i % 20 == 0:
            words += ["Falconer", f"agent{i}@hidden.example.org"]
        if i % 31 == 0:
            words += ["harbour", "10.20.30." + str(i % 250)]
        if i % 7 == 0:
            words.append("harbour" if i % 2 else "plain")
        rng.shuffle(words)
        docs.append((i, " ".join(words)))
    return docs


def test_counts_and_disclosure_equal_a_plain_count(spark):
    docs = corpus(random.Random(8))
    rows = spark.createDataFrame(docs, "doc_id long, text string").select(F.xxhash64("doc_id", "text").alias("_doc"), "text", pii.base_spans(F.col("text")).alias("base"))
    assert pii.copies(rows).count() == 0
    got = {(r["entity"], r["term"]): r for r in pii.disclosures(rows).collect()}
    want = plain_disclosures(docs)
    assert {k: (r["n_pair"], r["n_term"], r["n_entity"]) for k, r in got.items()} == want and want
    from math import log2

    for k, (pair, said, entity) in want.items():
        rare = len(docs) / entity
        assert got[k]["reveals"] == pytest.approx(log2(wilson(pair, said, pii.Z) * rare) / log2(rare))


def test_rare_values_are_pooled(spark):
    docs = corpus(random.Random(9))
    found = {r["doc_id"]: {r["text"][t["start"] : t["end"]] for t in r["terms"]} for r in pii.find(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert all(("Falconer" in said) == (d % 20 == 0) for d, said in found.items())


def test_revised_copies_are_counted_once(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    words = ["first", "second", "third", "fourth", "fifth"]
    many = docs.select((F.col("doc_id") * 5).alias("doc_id"), "text")
    for i, w in enumerate(words[1:], 1):
        many = many.union(docs.select(F.col("doc_id") * 5 + i, F.concat(F.lit(w + " "), "text", F.lit(" " + w))))
    rows = many.select(F.xxhash64("doc_id", "text").alias("_doc"), "text")
    assert pii.copies(rows).count() >= 0.95 * 4 * docs.count()
    touched = pii.find(many).filter(F.size("terms") > 0).count()
    assert touched <= 0.02 * many.count()


def test_what_stands_only_in_copies_counts(spark):
    """Near copies count once, but for all that any of them holds."""
    rng = random.Random(4)
    text = lambda n: " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(n))
    docs = [(i, text(20)) for i in range(300)]
    for i in range(8):
        body = text(400)
        docs += [(1000 + 10 * i + j, f"{body} {text(1)}") for j in range(6)]
        docs += [(1000 + 10 * i + 9, f"{body} Walrusking wrote from boss@corp.example.com")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    rows = frame.select("doc_id", F.xxhash64("doc_id", "text").alias("_doc"), "text", pii.base_spans(F.col("text")).alias("base"))
    gone = {r["_doc"]: r["original"] for r in pii.originals(rows).collect()}
    ids = {r["_doc"]: r["doc_id"] for r in rows.collect()}
    assert gone.keys() == {r["_doc"] for r in pii.copies(rows).collect()} and len(gone) == 48
    assert all(o not in gone and ids[o] // 10 == ids[d] // 10 for d, o in gone.items())
    got = {(r["entity"], r["term"]): (r["n_pair"], r["n_term"], r["n_entity"], r["n"]) for r in pii.disclosures(rows).collect()}
    assert got["email:boss@corp.example.com", "walrusking"] == (8, 8, 8, 308)
    found = {r["doc_id"]: {r["text"][t["start"] : t["end"]] for t in r["terms"]} for r in pii.find(frame).collect()}
    assert all(("Walrusking" in said) == (d >= 1000 and d % 10 == 9) for d, said in found.items())
