"""Send times under a minimum gap between the requests of a client (M2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from talkloom import constants as C
from talkloom.operators import scans


def throttle_schedule(
    df: DataFrame,
    key: str,
    at: str,
    tie: str,
    gap_us: int = C.REQUEST_GAP_US,
    task_rows: int = scans.TASK_ROWS,
) -> DataFrame:
    """Add `send_us` and `delay_us`; `at` holds arrival microseconds, `tie` orders equal ones.

    send(i) = max(arrival(i), send(i-1) + gap) has the closed form
    max over j<=i of (arrival(j) - j*gap) + i*gap, a running maximum. A client that is too large
    for one task is scanned per slice: rows of later slices have their position moved by the rows
    before the slice, which moves arrival - position*gap down by the same number of gaps.
    """
    slices = scans.slice_hot_keys(df, [key], at, tie, task_rows)
    ordered = Window.partitionBy(*slices.group).orderBy(at, tie)
    local = slices.rows.withColumn("_n", (F.row_number().over(ordered) - 1).cast("bigint"))
    local = local.withColumn("_slack", F.col(at) - F.col("_n") * F.lit(gap_us))
    local = local.withColumn(
        "_peak", F.max("_slack").over(ordered.rowsBetween(Window.unboundedPreceding, 0))
    )
    if not slices.split:
        send = F.col("_peak") + F.col("_n") * F.lit(gap_us)
        return _with_send(local, at, send, "_n", "_slack", "_peak", "_slice")

    earlier = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_rows").over(earlier), F.lit(0))
    totals = (
        slices.cut(local)
        .groupBy(*slices.group)
        .agg(F.count("*").alias("_rows"), F.max("_slack").alias("_top"))
        .withColumn("_before", before)
        .withColumn("_earlier_peak", F.max(F.col("_top") - F.col("_before") * gap_us).over(earlier))
        .select(*slices.group, "_before", "_earlier_peak")
    )
    joined = scans.add_earlier(local, slices, totals)
    moved = F.coalesce("_before", F.lit(0))
    peak = F.greatest(F.col("_peak") - moved * gap_us, F.col("_earlier_peak"))
    send = peak + (F.col("_n") + moved) * gap_us
    return _with_send(joined, at, send, "_n", "_slack", "_peak", "_slice", "_before", "_earlier_peak")


def _with_send(df: DataFrame, at: str, send, *helpers: str) -> DataFrame:
    return (
        df.withColumn("send_us", send)
        .withColumn("delay_us", F.col("send_us") - F.col(at))
        .drop(*helpers)
    )
