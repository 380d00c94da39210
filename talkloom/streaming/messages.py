"""Streams of chat messages: replies, busy flags and generated answers."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from talkloom.operators.admission import ANSWER, replies
from talkloom.operators.busy import busy_at_arrival
from talkloom.operators.inference import Client, generate


#: Everything available, then stop. A bot that runs on takes {"processingTime": "1 second"}.
ONCE = {"availableNow": True}


def write_replies(
    admitted: DataFrame, path: str, checkpoint: str, trigger: Mapping[str, bool | str] = ONCE
) -> StreamingQuery:
    """K4. Append one row per reply to a parquet table."""
    return (
        replies(admitted)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start(path)
    )


def busy_stream(
    requests: DataFrame,
    path: str,
    checkpoint: str,
    endpoint: str,
    user: str,
    start: str,
    finish: str,
    tie: str,
    trigger: Mapping[str, bool | str] = ONCE,
) -> StreamingQuery:
    """R3. busy_at_arrival on a stream whose micro-batches come in arrival order.

    The state after a batch is a table of the requests that may still run: per endpoint and user
    the latest finish, as far as it lies after the endpoint's latest arrival. A batch is flagged
    together with the state its predecessor left, by the same scan as in batch, so one endpoint
    with most of the traffic is no single task. Every batch overwrites its own folders, so a batch
    that is run again gives the same result.
    """
    spark = requests.sparkSession
    kept = [endpoint, user, start, finish, tie]

    def on_batch(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        before = _state_before(spark, checkpoint, number, batch.select(*kept))
        marked = batch.withColumn("_state", F.lit(False)).unionByName(
            before.withColumn("_state", F.lit(True)), allowMissingColumns=True
        )
        flagged = busy_at_arrival(marked, endpoint, user, start, finish, tie)
        result = flagged.filter(~F.col("_state")).drop("_state")
        result.write.mode("overwrite").parquet(f"{path}/batch={number}")

        all_rows = batch.select(*kept).unionByName(before)
        horizon = all_rows.groupBy(endpoint).agg(F.max(start).alias("_horizon"))
        latest = (
            all_rows.groupBy(endpoint, user)
            .agg(F.max_by(F.struct(start, finish, tie), F.col(finish)).alias("_last"))
            .select(endpoint, user, "_last.*")
        )
        running = latest.join(horizon, endpoint).filter(F.col(finish) > F.col("_horizon"))
        running.select(*kept).write.mode("overwrite").parquet(f"{checkpoint}/running/{number}")
        batch.unpersist()

    return (
        requests.writeStream.option("checkpointLocation", f"{checkpoint}/query")
        .trigger(**trigger)
        .foreachBatch(on_batch)
        .start()
    )


def _state_before(spark: SparkSession, checkpoint: str, number: int, like: DataFrame) -> DataFrame:
    if number == 0:
        return like.limit(0)
    return spark.read.schema(like.schema).parquet(f"{checkpoint}/running/{number - 1}")


def answer_stream(
    admitted: DataFrame,
    make_client: Callable[[], Client],
    path: str,
    checkpoint: str,
    batch_size: int = 32,
    trigger: Mapping[str, bool | str] = ONCE,
) -> StreamingQuery:
    """R4. Replies with the texts of the answers generated; each micro-batch has its own folder."""

    def on_batch(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        sent = replies(batch)
        to_answer = sent.filter(F.col("kind") == ANSWER)
        answered = generate(to_answer, make_client, "text", batch_size)
        texts = answered.withColumn("reply", F.col("response")).drop("response")
        notices = sent.filter(F.col("kind") != ANSWER).withColumn("error", F.lit(None).cast("string"))
        notices.unionByName(texts).write.mode("overwrite").parquet(f"{path}/batch={number}")
        batch.unpersist()

    return (
        admitted.writeStream.option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .foreachBatch(on_batch)
        .start()
    )
