import hashlib
import itertools

from pyspark.sql import functions as F

from talkloom.llm import chat, q_chat

TURNS = "conv_id long, turn long, role string, text string, piece int"


def test_round_trip_of_hard_texts(spark):
    parts = ["<|im_end|>", "<|im_start|>", "<\\|", "<n|", "\\", "<", "|", "\n", "assistant ok", "<\\\\n|", "é🙂", ""]
    texts = ["".join(p) for n in (1, 2, 3) for p in itertools.product(parts, repeat=n)]
    rows = [(i // 7, i, ["user", "assistant", "a\nb", "<n|", None, "<|x"][i % 6], t, 0) for i, t in enumerate(texts)]
    got = chat.format_conversations(spark.createDataFrame(rows, TURNS)).collect()
    assert all(r["round_trip"] for r in got)
    source = {}
    for c, _, role, text, _ in rows:
        source.setdefault(c, []).append((role or "", text))
    assert {r["conv_id"]: [tuple(t) for t in r["parsed"]] for r in got} == source


def test_plain_text_is_not_changed(spark):
    rows = [(1, 0, "user", "a < b | c", 0), (1, 1, "assistant", "x" * 200_000, 0)]
    got = chat.format_conversations(spark.createDataFrame(rows, TURNS)).first()
    assert got["formatted"] == f"<|im_start|>user\na < b | c<|im_end|>\n<|im_start|>assistant\n{'x' * 200_000}<|im_end|>\n"


def test_nulls_ties_and_empty_tables(spark):
    assert chat.format_conversations(spark.createDataFrame([], TURNS)).count() == 0
    rows = [(None, None, "user", None, 0), (None, 0, None, "b", 0), (5, 1, "user", "x", 0), (5, 1, "user", "x", 0)]
    got = {r["conv_id"]: [tuple(t) for t in r["parsed"]] for r in chat.format_conversations(spark.createDataFrame(rows, TURNS)).collect()}
    assert got == {None: [("user", ""), ("", "b")], 5: [("user", "x"), ("user", "x")]}


def test_query_reads_back_the_loss_text(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").orderBy("conv_id", "turn").collect()
    got = {r["conv_id"]: r for r in q_chat.op8_chat(spark, sf_dir).collect()}
    assert set(got) == {r["conv_id"] for r in turns} | {-1}
    for conv in list(got)[:20]:
        mine = [(r["role"], r["text"] or "") for r in turns if r["conv_id"] == conv] or [("user", q_chat._HARD), ("assistant", q_chat._HARD)]
        loss = "".join(t for role, t in mine if role == "assistant")
        assert got[conv]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest() and got[conv]["loss_chars"] == len(loss)
        assert got[conv]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in mine).encode()).hexdigest()
        assert got[conv]["round_trip"] and got[conv]["n_turns"] == len(mine)


def test_a_broken_text_does_not_parse_to_a_source(spark):
    frame = spark.createDataFrame([("<|im_start|>user\nhello",), ("<|im_start|>user\na<|im_end|>\nrest<|im_end|>\n",)], "t string")
    assert [r["t"][0]["text"] for r in frame.select(chat.parse(F.col("t")).alias("t")).collect()] == [None, None]
