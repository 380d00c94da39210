import random
import re
from collections import defaultdict

from talkloom.llm import lines, q_lines

DOCS = "doc_id long, text string, n_chars long, _line string"


def tokens_of(line):
    return re.findall(r"[^\x20\x09-\x0D]+", line)


def masked(line):
    return ["*" if re.search("[0-9]", t) else t for t in tokens_of(line)]


def leaf_of(line):
    tokens = masked(line)
    return (len(tokens), *tokens[:2])


def plain_dedup(docs):
    """From the definition: leaves, tokens that two documents have at a place of a leaf, templates, and who has them."""
    at_place, held = defaultdict(set), defaultdict(set)
    split = [(d, None if text is None else text.split("\n")) for d, text in docs]
    lined = [(d, line) for d, parts in split for line in parts or [] if tokens_of(line)]
    for d, line in lined:
        leaf = leaf_of(line)
        for i, t in enumerate(masked(line)):
            at_place[leaf, i, t].add(d)

    def template(line):
        tokens, leaf = masked(line), leaf_of(line)
        kept = [t if t != "*" and len(at_place[leaf, i, t]) >= 2 else None for i, t in enumerate(tokens)]
        n = sum(t is not None for t in kept)
        return ("template", leaf, *kept), n, n >= 4 and n >= 0.6 * len(tokens)

    for d, line in lined:
        held["line", *tokens_of(line)].add(d)
        name, _, enough = template(line)
        if enough:
            held[name].add(d)
    short = max(10, -(-2 * len(docs) // 1000))

    def goes(d, line):
        n = len(tokens_of(line))
        if not n:
            return False
        same = held["line", *tokens_of(line)]
        if len(same) >= (2 if n >= 8 else 3 if n >= 4 else short) and min(same) < d:
            return True
        name, constant, enough = template(line)
        return enough and len(held[name]) >= (2 if constant >= 8 else 3) and min(held[name]) < d

    return sorted(((d, None if parts is None else "\n".join(x for x in parts if not goes(d, x))) for d, parts in split), key=str)


def check(spark, docs, **options):
    frame = spark.createDataFrame([(d, t, len(t or ""), "x") for d, t in docs], DOCS)
    got = lines.dedup(frame, **options).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=str) == plain_dedup(docs)
    assert all(r["n_chars"] == len(r["text"] or "") for r in got)


def deduped(spark, texts):
    frame = spark.createDataFrame([(i, t, len(t), "") for i, t in enumerate(texts)], DOCS)
    return [r["text"] for r in lines.dedup(frame).orderBy("doc_id").collect()]


def test_templates_with_variable_fields_are_dropped_but_for_the_first(spark):
    docs = [f"User {i * 7} logged in at {i}:00\nOwn words of document number {'abcdefghij'[i]} only here\nThe daily report for {'xyz'[i % 3]} was sent to all the people of the house today" for i in range(10)]
    got = deduped(spark, docs)
    assert got[0] == docs[0]
    assert all("logged in" not in t for t in got[1:])
    assert sum("daily report" in t for t in got) <= 3


def test_any_place_may_vary(spark):
    got = deduped(spark, [f"The daily report for {name} was sent today" for name in ("alice", "bob", "carol", "dave", "erin")])
    assert got == ["The daily report for alice was sent today", "", "", "", ""]
    got = deduped(spark, [f"Dear reader, your {a} has been moved to the {b} for now" for a, b in (("book", "attic"), ("chair", "cellar"), ("lamp", "yard"))])
    assert [bool(t) for t in got] == [True, False, False]


def test_rows_of_numbers_stay(spark):
    rows = ["0 0 0 0", "1 7 11 13", "2 14 22 26", "3 21 33 39"]
    assert deduped(spark, rows) == rows


def test_passage_of_two_documents_and_short_lines(spark):
    passage = " ".join(f"{w}word" for w in "abcdefghijklmnopqrstuvwxyz") + " " + " ".join(f"{w}other" for w in "abcdefghijklmnopqrstuvwxyz")
    assert deduped(spark, [f"one own line\n{passage}", f"{passage}\nanother line"]) == [f"one own line\n{passage}", "another line"]
    few = [f"Thank you.\nown text {'abcdefghijklmnop'[i]}" for i in range(9)]
    assert deduped(spark, few) == few
    many = deduped(spark, [f"Thank you.\nown text {'abcdefghijklmnop'[i]}" for i in range(10)])
    assert ["Thank" in t for t in many] == [True] + [False] * 9


def test_random_lines_in_many_shards(spark):
    rng = random.Random(5)
    pool = [" ".join(rng.choice(["a", "b", "c9", "dé", "e"]) for _ in range(rng.randrange(0, 14))) for _ in range(60)]
    pool += ["a b " + " ".join(rng.choice(["a", "b", f"v{rng.choice('xyzuvw')}"]) for _ in range(8)) for _ in range(60)]
    docs = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(0, 6)))) for i in range(200)]
    check(spark, docs)
    check(spark, docs, shard_bytes=700)


def test_edges(spark):
    assert lines.dedup(spark.createDataFrame([], DOCS)).count() == 0
    docs = [(1, None), (2, ""), (3, "\n\n"), (4, "one two three four\n" * 3), (5, "one two three four"), (6, "one two three four\nx"), (6, "one two three four\nx"), (7, "w " * 200_000)]
    check(spark, docs)


def test_query_on_the_table(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = sorted(((r["doc_id"], r["text"]) for r in q_lines.op5_lines(spark, sf_dir).collect()), key=str)
    assert got == plain_dedup(docs)
