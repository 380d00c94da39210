import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from talkloom.operators import resumable as R


def noting(folder, deadly=None):
    """A client that leaves a file for every prompt it was asked, and ends its worker at the deadly one."""

    def make():
        def ask(texts):
            import os

            for t in texts:
                if t == deadly:
                    os._exit(3)
                with open(f"{folder}/{uuid.uuid4().hex}", "w") as out:
                    out.write(t)
            if any(t.startswith("bad") for t in texts):
                raise ValueError("refused")
            return [f" got {t} " for t in texts]

        return ask

    return make


def asked(folder):
    return Counter(p.read_text() for p in folder.iterdir())


def test_a_killed_job_repeats_only_its_last_round(spark, tmp_path):
    notes, store = tmp_path / "notes", str(tmp_path / "store")
    notes.mkdir()
    df = spark.createDataFrame([(i, f"p{i % 40}") for i in range(200)], "i long, prompt string")
    rounds = 8
    keys = df.select("prompt", F.pmod(F.xxhash64(R.prompt_key(F.col("prompt"))), F.lit(rounds)).alias("r")).distinct().collect()
    in_round = {r["prompt"]: r["r"] for r in keys}
    last = max(p for p, r in in_round.items() if r == 5)
    with pytest.raises(Exception):  # noqa: B017
        R.generate_resumable(df, noting(notes, last), store, rounds=rounds, batch_size=1).collect()
    before = asked(notes)
    assert set(before) <= {p for p, r in in_round.items() if r <= 5} and {p for p, r in in_round.items() if r < 5} <= set(before)
    rows = R.generate_resumable(df, noting(notes), store, rounds=rounds, batch_size=1).collect()
    assert len(rows) == 200 and all(r["response"] == f"got {r['prompt']}" and r["error"] is None for r in rows)
    both = asked(notes)
    assert all(both[p] == 1 for p, r in in_round.items() if r != 5) and set(both) == set(in_round)
    R.generate_resumable(df, noting(notes), store, rounds=3).collect()
    assert asked(notes) == both


def test_failures_are_asked_again_and_parameters_part_prompts(spark, tmp_path):
    notes, store = tmp_path / "notes", str(tmp_path / "store")
    notes.mkdir()
    df = spark.createDataFrame([(1, "bad"), (2, "good"), (3, None), (4, "good")], "i long, prompt string")
    for run in (1, 2):
        rows = {r["i"]: r for r in R.generate_resumable(df, noting(notes), store, rounds=2, batch_size=1).collect()}
        assert rows[1]["response"] is None and rows[1]["error"] == "ValueError: refused" and rows[1]["run"] == run
        assert rows[2]["response"] == rows[4]["response"] == "got good" and rows[2]["run"] == 1
        assert (rows[3]["response"], rows[3]["error"], rows[3]["run"]) == (None, R.NO_PROMPT, None)
    assert asked(notes)["good"] == 1
    R.generate_resumable(df, noting(notes), store, params={"temperature": 1}, rounds=1, batch_size=1).collect()
    assert asked(notes)["good"] == 2
    assert R.generate_resumable(df.limit(0), noting(notes), store, rounds=1).count() == 0
    with pytest.raises(ValueError):
        R.generate_resumable(df.withColumn("run", F.lit(1)), noting(notes), store)
