"""Sources and sinks on small files written here."""

import json

import pytest
from pyspark.sql import types as T

from talkloom.plans import files
from talkloom.sinks import tables
from talkloom.sources import dialogues as D


def example(text, actions=("Open",), action="Open"):
    return {
        "prompt": {"History": ["system: 'be kind'"], "AvailableActions": list(actions), "UserInput": text},
        "answer": {"MessageText": f"it's {text}", "Content": {"Action": action}},
    }


def write(path, value):
    path.write_text(json.dumps(value, ensure_ascii=False, indent=2), encoding="utf-8")
    return str(path)


def test_both_shapes_of_dialogue_files(spark, tmp_path):
    by_key = {"system": "Sei höflich", "examples": {"z": example("né"), "a": example("two", ()), "m": example("漢")}}
    as_map = D.read_dialogues(spark, write(tmp_path / "map.json", by_key)).orderBy("pos").collect()
    assert [r.example_id for r in as_map] == ["z", "a", "m"]
    assert {r.system for r in as_map} == {"Sei höflich"}
    assert as_map[1].prompt.AvailableActions == [] and as_map[0].answer.MessageText == "it's né"
    in_order = {"examples": [example("x"), example("y")]}
    as_array = D.read_dialogues(spark, write(tmp_path / "array.json", in_order), "fallback").orderBy("pos").collect()
    assert [(r.example_id, r.system, r.prompt.UserInput) for r in as_array] == [("0", "fallback", "x"), ("1", "fallback", "y")]
    assert D.read_dialogues(spark, str(tmp_path)).count() == 5


def test_last_of_equal_ids_counts(spark, tmp_path):
    one, two, three = (json.dumps(example(t)) for t in ("1", "2", "3"))
    (tmp_path / "d.json").write_text(f'{{"examples":{{"a":{one},"b":{two},"a":{three}}}}}')
    rows = D.read_dialogues(spark, str(tmp_path / "d.json")).orderBy("pos").collect()
    assert [(r.pos, r.example_id, r.prompt.UserInput) for r in rows] == [(0, "a", "3"), (1, "b", "2")]


@pytest.mark.parametrize("value", [{"system": "s"}, {"examples": 3}, []])
def test_file_without_examples_is_an_error(spark, tmp_path, value):
    with pytest.raises(Exception, match="no examples in"):
        D.read_dialogues(spark, write(tmp_path / "bad.json", value)).collect()


def test_example_lines(spark, tmp_path):
    lines = [json.dumps({"example_id": str(i), "system": "s", **example(f"q{i}")}) for i in range(3)]
    (tmp_path / "e.jsonl").write_text("\n".join(lines))
    assert {r.prompt.UserInput for r in D.read_examples(spark, str(tmp_path / "e.jsonl")).collect()} == {"q0", "q1", "q2"}


def test_records_round_trip_as_splits(spark, tmp_path):
    rows = [("s", 'né "q" \n\\', "b"), (None, "漢\U0001f600", "c")]
    df = spark.createDataFrame(rows, "system string, user string, bot string")
    tables.write_jsonl(df, str(tmp_path / "train"))
    tables.write_jsonl(df.limit(1), str(tmp_path / "test"))
    tables.write_jsonl(df, str(tmp_path / "train"))
    raw = "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "train").glob("part-*"))
    assert "漢\U0001f600" in raw and '"system":null' in raw
    back = D.read_sft(spark, {"train": str(tmp_path / "train"), "test": str(tmp_path / "test")})
    assert {tuple(r)[:3] for r in back.filter("split = 'train'").collect()} == set(rows)
    assert back.filter("split = 'test'").count() == 1


@pytest.mark.parametrize("n", [0, 1, 2, 300])
def test_prompt_array(spark, tmp_path, n):
    """Rows with equal order and equal content, line breaks, quotes and nulls; the parts are one document."""
    rows = [(i // 3, f'a"[{i // 2},\n]', None if i % 2 else "é") for i in range(n)]
    df = spark.createDataFrame(rows, "n int, user string, bot string").repartition(5)
    path = str(tmp_path / "p")
    tables.write_prompt_array(df, path, ["n"], ["n", "user", "bot"])
    whole = "".join(p.read_text(encoding="utf-8") for p in sorted((tmp_path / "p").glob("part-*")))
    made = json.loads(whole)
    assert [r["n"] for r in made] == [r[0] for r in rows]
    key = lambda r: (r[0], r[1], r[2] or "")
    assert sorted([(r["n"], r["user"], r["bot"]) for r in made], key=key) == sorted(rows, key=key)
    back = D.read_prompt_parts(spark, path, schema=df.schema)
    assert sorted(map(tuple, back.collect()), key=key) == sorted(rows, key=key)
    (tmp_path / "one.json").write_text(whole, encoding="utf-8")
    assert D.read_prompts(spark, str(tmp_path / "one.json"), df.schema).count() == n


def test_parallel_text(spark, tmp_path):
    (tmp_path / "pairs.csv").write_text('translated|original\nyes sir|oui\n"a|b"|"c, d"\n', encoding="utf-8")
    pairs = D.read_pairs(spark, str(tmp_path / "pairs.csv"))
    assert {tuple(r) for r in pairs.collect()} == {("yes sir", "oui"), ("a|b", "c, d")}
    records = D.pairs_to_sft(pairs, ("x", "y"), "Rewrite it.").filter("bot = 'yes sir'").first()
    assert "[oui]" in records.user and records.system is None


def test_report(spark, tmp_path):
    rows = [("a", "p1", True), ("a", "p2", False), ("b", "p1", False)]
    df = spark.createDataFrame(rows, "suite string, prompt string, passed boolean")
    tables.write_report(df, str(tmp_path / "r"))
    summary = spark.read.parquet(str(tmp_path / "r" / "summary")).collect()
    assert {(r.suite, r.passed, r.total, r.accuracy) for r in summary} == {("a", 1, 2, 0.5), ("b", 0, 1, 0.0)}
    assert spark.read.parquet(str(tmp_path / "r" / "results")).count() == 3


def test_documents_as_lines_of_one_file(spark, tmp_path):
    one = example("u")
    lines = [json.dumps({"system": "s", "examples": {"b": one, "a": one}}), "", " ", json.dumps({"examples": [one, one]})]
    (tmp_path / "part.txt").write_text("\n".join(lines))
    got = D.read_dialogue_lines(spark, str(tmp_path), "none").collect()
    assert [(r.system, r.pos, r.example_id, r.prompt.UserInput) for r in got] == [("s", 0, "b", "u"), ("s", 1, "a", "u"), ("none", 0, "0", "u"), ("none", 1, "1", "u")]
    (tmp_path / "part.txt").write_text('{"system": "s"}')
    with pytest.raises(Exception, match="no examples in"):
        D.read_dialogue_lines(spark, str(tmp_path)).collect()


def test_fields_of_a_document(spark, tmp_path):
    write(tmp_path / "map.json", {"n": -7, "system": "s", "examples": {"a": example("u")}})
    write(tmp_path / "array.json", {"examples": [example("v")], "n": 8})
    write(tmp_path / "none.json", {"examples": [example("w")]})
    fields = T.StructType([T.StructField("n", T.LongType())])
    got = D.read_dialogues(spark, str(tmp_path), "x", fields).collect()
    assert {(r.n, r.system, r.example_id, r.prompt.UserInput) for r in got} == {(-7, "s", "a", "u"), (8, "x", "0", "v"), (None, "x", "0", "w")}


def test_documents_are_files_without_folders_of_their_own(spark, tmp_path, monkeypatch):
    turns = [(c - 20, t, role, f"{role} {c} {t}") for c in range(40) for t, role in enumerate(["system", "user", "assistant", "user", "assistant"])]
    turns += [(5000, t, ["user", "assistant"][t % 2], f"long {t}") for t in range(600)]
    spark.createDataFrame(turns, "conv_id long, turn int, role string, text string").repartition(3).write.parquet(str(tmp_path / "conversations.parquet"))
    monkeypatch.setattr(files.session, "shared_dir", lambda _: str(tmp_path / "out"))
    got = files.dialogues_roundtrip(spark, str(tmp_path))
    folders = [p for p in (tmp_path / "out").iterdir() if p.is_dir()]
    assert len(list((tmp_path / "out").rglob("part-*.txt"))) == 43 and len(folders) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = got.select("conv_id", "pos", "example_id", "user_input", "message_text").collect()
    want = {(c - 20, t // 2 - 1, f"{c - 20}-{t}" if c % 2 == 0 else str(t // 2 - 1), f"user {c} {t - 1}", f"assistant {c} {t}") for c in range(40) for t in (2, 4)}
    want |= {(5000, (t % 256) // 2, f"5000-{t}", f"long {t - 1}", f"long {t}") for t in range(1, 600, 2)}
    assert len(rows) == len(want) and set(map(tuple, rows)) == want
