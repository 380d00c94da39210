"""Model calls that a killed job does not repeat (M1): a store of responses by prompt and parameters."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkloom import session
from talkloom.operators.inference import Client, generate
from talkloom.operators.skew import join_unique

NO_PROMPT = "no prompt"
_STORE = "key string, run long, response string, error string"


def prompt_key(prompt: Column, params: dict | None = None) -> Column:
    """Digest of a prompt and of all that shapes its response."""
    head = json.dumps(params or {}, sort_keys=True, ensure_ascii=False)
    return F.sha2(F.concat(F.lit(head + "\n"), prompt), 256)


def stored(df_or_spark, store: str) -> DataFrame:
    """key, run, response, error: the last answer to each key, a good one before a failure."""
    rows = getattr(df_or_spark, "sparkSession", df_or_spark).read.schema(_STORE).parquet(store)
    last = F.max(F.struct(F.col("error").isNull().alias("good"), "run", "response", "error")).alias("last")
    return rows.groupBy("key").agg(last).select("key", "last.run", "last.response", "last.error")


def generate_resumable(
    df: DataFrame,
    make_client: Callable[[], Client],
    store: str,
    prompt: str = "prompt",
    params: dict | None = None,
    rounds: int = 16,
    **options,
) -> DataFrame:
    """Add `response`, `error` and `run`, the run of the job that asked; what `store` already answers is not asked.

    Equal prompts are asked once. Open prompts are dealt into `rounds` by their digest; each round is one job whose answers are committed
    to the store as a whole, so a killed job repeats at most the round it was in, and a lost task only itself. Failures are
    stored as well and asked again by the next run. Null prompts are not asked. `store` is a folder that all executors share;
    `options` go to `generate`. One job at a time may write to a store.
    """
    spark = df.sparkSession
    clash = {"response", "error", "run", "_key"} & set(df.columns)
    if clash:
        raise ValueError(f"columns already there: {sorted(clash)}")
    spark.createDataFrame([], _STORE).write.mode("append").parquet(store)
    known = stored(spark, store)
    run = (known.agg(F.max("run")).first()[0] or 0) + 1
    keyed = df.withColumn("_key", prompt_key(F.col(prompt), params))
    wanted = keyed.filter(F.col(prompt).isNotNull()).groupBy(F.col("_key").alias("key")).agg(F.min(prompt).alias("prompt"))
    open_ = session.materialize(wanted.join(known.filter(F.col("error").isNull()).select("key"), "key", "left_anti"))
    for number in range(rounds):
        part = open_.filter(F.pmod(F.xxhash64("key"), F.lit(rounds)) == number)
        asked = generate(part, make_client, "prompt", **options)
        asked.select("key", F.lit(run).cast("long").alias("run"), "response", "error").write.mode("append").parquet(store)
    answers = stored(spark, store).withColumnRenamed("key", "_key")
    joined = join_unique(keyed, answers, "_key", "left", counted=keyed.select("_key"))
    missing = F.when(F.col(prompt).isNull(), F.lit(NO_PROMPT)).otherwise(F.col("error"))
    return joined.select(*df.columns, "response", missing.alias("error"), "run")
