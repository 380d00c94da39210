"""Positions of rows in files, and lists of unequal length side by side."""

import json

import pytest

from talkloom.operators.alignment import align_by_position, number_rows


def lines(folder, files):
    folder.mkdir()
    for name, values in files.items():
        (folder / name).write_text("".join(json.dumps({"v": v}) + "\n" for v in values))
    return str(folder)


@pytest.mark.parametrize("block", [None, 200])
def test_order_of_files_and_blocks(spark, tmp_path, block):
    wanted = [f"{i}-{'x' * (i % 30)}" for i in range(900)]
    folder = lines(tmp_path / "in", {"c.json": wanted[700:], "a.json": wanted[:50], "b.json": wanted[50:700], "bb.json": []})
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block or before))
    try:
        got = number_rows(spark.read.schema("v string").json(folder)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r["v"] for r in sorted(got, key=lambda r: r["pos"])] == wanted
    assert sorted(r["pos"] for r in got) == list(range(900))


def test_unequal_lengths_are_reported(spark, tmp_path):
    left = number_rows(spark.read.schema("v string").json(lines(tmp_path / "l", {"a": ["p", None, "r"]})))
    right = number_rows(spark.read.schema("v string").json(lines(tmp_path / "r", {"a": ["x"], "b": ["y", "z", "w"]}))).withColumnRenamed("v", "a")
    got = sorted(tuple(r) for r in align_by_position(left, right).select("pos", "side", "v", "a").collect())
    assert got == [(0, "both", "p", "x"), (1, "both", None, "y"), (2, "both", "r", "z"), (3, "right only", None, "w")]
    turned = align_by_position(right, left).filter("side <> 'both'").collect()
    assert [(r["pos"], r["side"]) for r in turned] == [(3, "left only")]
    with pytest.raises(ValueError):
        align_by_position(left, left)
