from talkloom.operators.inference import generate


def test_one_failing_prompt_fails_alone(spark):
    def make():
        def client(texts):
            if "bad" in texts:
                raise ValueError("no")
            if "short" in texts:
                return []
            return [None if t == "none" else f" {t}! \n" for t in texts]

        return client

    df = spark.createDataFrame([(t, 1) for t in ["a", "bad", "none", "short", "b"]], "prompt string, kept int").coalesce(1)
    got = {r.prompt: (r.response, r.error) for r in generate(df, make, batch_size=4).collect()}
    assert got == {
        "a": ("a!", None), "b": ("b!", None), "bad": (None, "ValueError: no"),
        "none": (None, "no choice returned"), "short": (None, "RuntimeError: 0 replies for 1 prompts"),
    }


def test_client_is_made_once_per_task_and_called_in_batches(spark):
    def make():
        calls = []

        def client(texts):
            calls.append(len(texts))
            return [f"{len(calls)}:{len(texts)}"] * len(texts)

        return client

    df = spark.range(70).selectExpr("cast(id as string) as prompt").coalesce(1)
    replies = [r.response for r in generate(df, make, batch_size=32).collect()]
    assert replies == ["1:32"] * 32 + ["2:32"] * 32 + ["3:6"] * 6


def test_calls_keep_their_gap_and_are_dealt_out(spark):
    def make():
        import time

        return lambda texts: [f"{time.monotonic()}"] * len(texts)

    df = spark.range(4).selectExpr("cast(id as string) as prompt").coalesce(1)
    at = sorted(float(r.response) for r in generate(df, make, batch_size=1, gap_seconds=0.2).collect())
    assert all(b - a >= 0.19 for a, b in zip(at, at[1:], strict=False))
    spread = generate(df, make, tasks=3)
    assert spread.rdd.getNumPartitions() == 3 and spread.count() == 4
