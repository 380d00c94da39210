"""Length-grouped batches and the optimizer steps made of them."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkloom import constants as C

OFFSET_GROUP = 65_536
#: Batches that are sorted together, and swap rounds of the shuffle before.
MEGA_BATCHES = 50
SHUFFLE_ROUNDS = 24


def _div(number: Column, by: int) -> Column:
    """Whole-number division; ids beyond the exact range of a double stay exact."""
    return F.call_function("div", number, F.lit(by))


def hash_bucket(row_id: str, seed: int, buckets: int) -> Column:
    """A seeded shuffle of the rows into buckets of about equal size; `row_id` is unique."""
    return F.pmod(F.xxhash64(F.col(row_id), F.lit(seed)), F.lit(buckets))


def range_bucket(row_id: str, rows: int) -> Column:
    """Neighbouring integer ids share a bucket, at most `rows` of them."""
    return _div(F.col(row_id), rows)


def length_batches(
    df: DataFrame, row_id: str, length: str, bucket: Column, batch_size: int = C.MICRO_BATCH
) -> DataFrame:
    """T8. Number the rows of a bucket by length, longest first, and cut them into batches.

    Adds bucket, rank and batch. Buckets bound the sort: there is no order over all rows.
    """
    by_length = Window.partitionBy("bucket").orderBy(F.desc(length), row_id)
    ranked = df.withColumn("bucket", bucket.cast("bigint")).withColumn(
        "rank", F.row_number().over(by_length) - 1
    )
    return ranked.withColumn("batch", _div(F.col("rank"), batch_size))


def batch_summary(batches: DataFrame, length: str) -> DataFrame:
    """One row per batch with its size, the padded length, and the ids it holds unpadded."""
    return batches.groupBy("bucket", "batch").agg(
        F.count("*").alias("n_rows"), F.max(length).alias("max_len"), F.sum(length).alias("sum_len")
    )


def bucket_offsets(batches: DataFrame, batch_size: int = C.MICRO_BATCH, group: int = OFFSET_GROUP) -> DataFrame:
    """Batches in all earlier buckets, per bucket.

    They follow from the row counts, so the length-sorted rows are not needed again and only the
    ids are read. The running sum is taken in groups of `group` buckets and then over the groups:
    the only window without a key sees one row per `group` buckets.
    """
    rows = batches.groupBy("bucket").agg(F.count("*").alias("_rows"))
    counts = rows.select(
        "bucket",
        _div(F.col("_rows") + (batch_size - 1), batch_size).alias("_n"),
        _div(F.col("bucket"), group).alias("_group"),
    )
    inside = Window.partitionBy("_group").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    over_groups = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    groups = (
        counts.groupBy("_group")
        .agg(F.sum("_n").alias("_g"))
        .select("_group", F.coalesce(F.sum("_g").over(over_groups), F.lit(0)).alias("_before"))
    )
    return (
        counts.withColumn("_inside", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
        .join(groups, "_group")
        .select("bucket", (F.col("_inside") + F.col("_before")).alias("_offset"))
    )


def step_plan(
    batches: DataFrame,
    length: str,
    batch_size: int = C.MICRO_BATCH,
    accumulation: int = C.ACCUMULATION,
    log_every: int = C.LOG_EVERY,
    eval_every: int = C.EVAL_EVERY,
) -> DataFrame:
    """T9. One row per batch: its size, its global number, its optimizer step (from 1), and
    whether that step logs or evaluates. `batches` comes from length_batches.
    """
    summary = batch_summary(batches, length)
    numbered = summary.join(bucket_offsets(batches, batch_size), "bucket").withColumn(
        "batch_no", F.col("_offset") + F.col("batch")
    )
    return (
        numbered.withColumn("step", _div(F.col("batch_no"), accumulation) + 1)
        .withColumn("logs", F.col("step") % log_every == 0)
        .withColumn("evaluates", F.col("step") % eval_every == 0)
        .drop("_offset")
    )


def _round_keys(seed: int, rounds: int) -> list[int]:
    return [int(hashlib.md5(f"{seed}:{r}".encode()).hexdigest()[:12], 16) for r in range(rounds)]


def permuted(index: Column, n: int, seed: int, rounds: int = SHUFFLE_ROUNDS) -> Column:
    """A seeded permutation of 0 .. n-1, row by row and without a sort.

    Every round pairs x with (key - x) mod n and swaps the pair or not, by a digest that both of them share; that is one-to-one for any n.
    """
    keys = F.array(*[F.struct(F.lit(r).alias("r"), F.lit(k % n).cast("long").alias("k")) for r, k in enumerate(_round_keys(seed, rounds))])

    def swap(x: Column, key: Column) -> Column:
        other = F.pmod(key["k"] - x, F.lit(n).cast("long"))
        digest = F.md5(F.concat_ws(":", F.lit(str(seed)), key["r"].cast("string"), F.greatest(x, other).cast("string")).cast("binary"))
        return F.when(F.substring(digest, 1, 1) >= "8", other).otherwise(x)

    return F.aggregate(keys, index.cast("long"), swap)


def grouped_batches(
    df: DataFrame, index: str, length: str, n: int, seed: int = 42, batch_size: int = C.MICRO_BATCH, mega: int = MEGA_BATCHES
) -> DataFrame:
    """T8 as a trainer groups: a seeded shuffle cut into mega-batches of `mega` batches, each sorted by length, longest first.

    `index` holds different whole numbers from 0 to n - 1; numbers that no row has leave smaller mega-batches. Adds shuffled, mega_batch, rank and
    batch (a number over all rows). A window sees one mega-batch, so the shuffle is even and nothing is ordered over all rows.
    """
    size = mega * batch_size
    placed = df.withColumn("shuffled", permuted(F.col(index), n, seed)).withColumn("mega_batch", _div(F.col("shuffled"), size))
    by_length = Window.partitionBy("mega_batch").orderBy(F.desc(length), "shuffled")
    ranked = placed.withColumn("rank", (F.row_number().over(by_length) - 1).cast("long"))
    return ranked.withColumn("batch", F.col("mega_batch") * mega + _div(F.col("rank"), batch_size))
