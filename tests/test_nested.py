"""The reader of split documents against a JSON parser, with blocks of a few bytes."""

import json

import pytest

from talkloom.sources.nested import read_document


def example(text, action="Talk", history=()):
    return {"prompt": {"History": list(history), "AvailableActions": [], "UserInput": text}, "answer": {"MessageText": text + "!", "Content": {"Action": action}}}


HARD = ['plain', '"quoted"', "back\\", 'both\\"', "br{ck}[e]ts", "né\n\t日本", "", '", "examples": [{', "\\\\", "a:b,c"]
ARRAY = {"system": 'so "it" {is}', "examples": [example(t, history=HARD[:i]) for i, t in enumerate(HARD)]}
MAP = {"meta": {"a": {"b": "c"}, "d": "e"}, "n": [1, {"x": [{}]}], "examples": {f'k"{i}\\': example(t) for i, t in enumerate(HARD)}, "after": {"k": {"examples": 3}}}


def written(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")
    return str(folder)


@pytest.mark.parametrize(("block", "indent"), [(400, None), (1 << 20, 2)])
def test_equals_a_json_parser(spark, tmp_path, block, indent):
    folder = tmp_path / "docs"
    for name, doc in {"array": ARRAY, "map": MAP, "none": {"examples": []}}.items():
        written(folder, name, json.dumps(doc, indent=indent, ensure_ascii=indent is None))
    read = read_document(spark, str(folder), system="default", block_bytes=block).orderBy("file", "pos").collect()
    got = {}
    for r in read:
        name = r["file"].rsplit("/", 1)[1]
        row = r.asDict(recursive=True)
        got.setdefault(name, []).append((row["system"], row["pos"], row["example_id"], {"prompt": row["prompt"], "answer": row["answer"]}))
    assert got["array"] == [(ARRAY["system"], i, str(i), e) for i, e in enumerate(ARRAY["examples"])]
    assert got["map"] == [("default", i, k, e) for i, (k, e) in enumerate(MAP["examples"].items())]
    assert set(got) == {"array", "map"}


@pytest.mark.parametrize("doc", [{"system": "\\", "examples": [example('"')]}, {"examples": {"k": example("{")}}])
def test_blocks_of_a_few_bytes(spark, tmp_path, doc):
    folder = written(tmp_path / "docs", "d", json.dumps(doc))
    (row,) = read_document(spark, folder, block_bytes=5).collect()
    (want,) = doc["examples"].values() if "k" in doc["examples"] else doc["examples"]
    assert row["system"] == doc.get("system") and {k: row.asDict(recursive=True)[k] for k in ("prompt", "answer")} == want


def test_many_tasks_read_one_document(spark, tmp_path):
    many = {"examples": [example("x" * 100 + str(i)) for i in range(2000)]}
    folder = written(tmp_path / "one", "doc.json", json.dumps(many))
    read = read_document(spark, folder, block_bytes=1 << 15)
    assert [r["prompt"]["UserInput"] for r in read.orderBy("pos").collect()] == [e["prompt"]["UserInput"] for e in many["examples"]]
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 15))
    try:
        assert spark.read.text(folder, lineSep='"').rdd.getNumPartitions() >= 8
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_equal_ids_and_errors(spark, tmp_path):
    first, second = json.dumps(example("one")), json.dumps(example("two"))
    folder = written(tmp_path / "twice", "d", f'{{"examples": {{"a": {first}, "b": {first}, "a": {second}, "c": {first}}}}}')
    rows = read_document(spark, folder, block_bytes=50).orderBy("pos").collect()
    assert [(r["pos"], r["example_id"], r["prompt"]["UserInput"]) for r in rows] == [(0, "a", "two"), (1, "b", "one"), (2, "c", "one")]
    with pytest.raises(Exception, match="no examples in"):
        read_document(spark, written(tmp_path / "bad", "d", '{"system": "examples"}')).collect()
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") != "50"
