"""Running values in order of time that survive a key holding most of the rows.

A window per key puts all rows of a key into one task. Keys with more rows than a task should take
are found by counting first; only their rows are cut into slices of about equal size, scanned per
(key, slice) and shifted by what the earlier slices of the key add up to. All other keys use one
plain window. The cuts come from quantiles of the order column, so a busy hour gets more slices, and
an instant that holds more than a slice is cut by the tie column.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkloom.operators import skew
from talkloom.operators.skew import TASK_ROWS

_HOT, _SLICE, _AT = "_hot", "_slice", "_at"
_UNCUT = -1


@dataclass(frozen=True)
class Slices:
    """Rows with a slice column; `split` says if any key was cut."""

    rows: DataFrame
    keys: list[str]
    split: bool

    @property
    def group(self) -> list[str]:
        return [*self.keys, _SLICE]

    def cut(self, rows: DataFrame) -> DataFrame:
        """Rows of cut keys. A window per group lets this filter through to its input."""
        return rows.filter(F.col(_SLICE) != _UNCUT)


def slice_hot_keys(
    df: DataFrame, keys: list[str], at: str, tie: str, task_rows: int = TASK_ROWS, counted: DataFrame | None = None
) -> Slices:
    """Add `_slice`: -1 for ordinary keys, the slice in order of (at, tie) for keys above `task_rows` rows.

    Runs one count per key, and quantile jobs only if that found any. `counted` has the keys, times
    and ties of `df` where `df` itself is costly to count. An instant is cut only by a number or a time.
    """
    source = df if counted is None else counted
    hot = skew.hot_keys(source, keys, task_rows)
    if hot is None:
        return Slices(df.withColumn(_SLICE, F.lit(_UNCUT).cast("bigint")), keys, split=False)
    marks = hot.select(*keys, F.lit(True).alias(_HOT))

    def mark(rows: DataFrame) -> DataFrame:
        return skew.left_join_null_safe(rows.withColumn(_AT, F.col(at).cast("double")), marks, keys)

    full = -(-hot.agg(F.sum("_rows")).first()[0] // task_rows)
    wanted = max(full, df.sparkSession.sparkContext.defaultParallelism)
    times = mark(source.select(*keys, at, tie)).filter(F.col(_HOT))
    cuts = _quantiles(times.agg(_quantile_column(F.col(_AT), wanted)).first()[0])
    borders = [float("-inf"), *sorted(set(cuts) or {0.0}), float("inf")]
    cutter = Bucketizer(splits=borders, inputCol=_AT, outputCol=_SLICE, handleInvalid="keep")
    sliced = cutter.transform(mark(df))
    # rows without a time come first, as in the window of an uncut key
    of_hot = F.when(F.col(_AT).isNull(), F.lit(0)).otherwise(F.col(_SLICE).cast("bigint") + 1)
    crowded = _crowded(times, cuts, tie, wanted)
    if crowded is not None:
        # a crowded instant is the first of its slice, and comes in parts before the rest of it
        sliced = skew.left_join_null_safe(sliced, crowded, [_AT])
        earlier = F.size(F.filter("_ties", lambda c: c <= F.col(tie).cast("double")))
        part = F.when(F.col("_ties").isNull(), F.lit(wanted)).otherwise(F.coalesce(earlier, F.lit(0)))
        of_hot = of_hot * (wanted + 1) + part
    number = F.when(F.col(_HOT), of_hot).otherwise(F.lit(_UNCUT)).cast("bigint")
    return Slices(sliced.withColumn(_SLICE, number).drop(_HOT, _AT, "_ties"), keys, split=True)


def _quantile_column(value: Column, wanted: int) -> Column:
    shares = [i / wanted for i in range(1, wanted)] or [0.5]
    return F.percentile_approx(value, shares, max(10_000, 4 * wanted))


def _quantiles(found: list[float] | None) -> list[float]:
    return [float(c) for c in found or []]


def _crowded(times: DataFrame, cuts: list[float], tie: str, wanted: int) -> DataFrame | None:
    """Instants that several cuts fall on, rows without a time among them, and the quantiles of their ties.

    Every slice of its own holds about 1/wanted of the rows of hot keys, and so at most `wanted` instants are crowded.
    """
    if not isinstance(times.schema[tie].dataType, (T.NumericType, T.TimestampType, T.TimestampNTZType)):
        return None
    several = sorted({c for c, n in Counter(cuts).items() if n > 1})
    chosen = times.filter(F.col(_AT).isNull() | F.col(_AT).isin(several))
    ties = chosen.groupBy(_AT).agg(_quantile_column(F.col(tie).cast("double"), wanted).alias("_ties"))
    rows = ties.select(_AT, F.array_distinct("_ties").alias("_ties")).collect()
    if not rows:
        return None
    return F.broadcast(times.sparkSession.createDataFrame(rows, ties.schema))


def add_earlier(local: DataFrame, slices: Slices, totals: DataFrame) -> DataFrame:
    """Join `totals` of the earlier slices, one row per (key, slice) of the cut keys, to the rows."""
    return skew.left_join_null_safe(local, totals, slices.group)


def ordinal(
    df: DataFrame, keys: list[str], at: str, tie: str, name: str, task_rows: int = TASK_ROWS
) -> DataFrame:
    """Dense position from 0 within each key, in order of (at, tie)."""
    slices = slice_hot_keys(df, keys, at, tie, task_rows)
    w = Window.partitionBy(*slices.group).orderBy(at, tie)
    local = slices.rows.withColumn(name, (F.row_number().over(w) - 1).cast("bigint"))
    if not slices.split:
        return local.drop(_SLICE)
    earlier = Window.partitionBy(*keys).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        slices.cut(slices.rows).groupBy(*slices.group).agg(F.count("*").alias("_n"))
        .select(*slices.group, F.sum("_n").over(earlier).alias("_before"))
    )
    return (
        add_earlier(local, slices, totals)
        .withColumn(name, F.col(name) + F.coalesce("_before", F.lit(0)))
        .drop("_before", _SLICE)
    )


def earlier_max(
    df: DataFrame,
    keys: list[str],
    at: str,
    tie: str,
    value: Column,
    name: str,
    task_rows: int = TASK_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Largest `value` among the earlier rows of the key, null for the first row."""
    slices = slice_hot_keys(df.withColumn("_value", value), keys, at, tie, task_rows, counted)
    before = (
        Window.partitionBy(*slices.group).orderBy(at, tie).rowsBetween(Window.unboundedPreceding, -1)
    )
    local = slices.rows.withColumn(name, F.max("_value").over(before))
    if not slices.split:
        return local.drop(_SLICE, "_value")
    earlier = Window.partitionBy(*keys).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        slices.cut(slices.rows).groupBy(*slices.group).agg(F.max("_value").alias("_max"))
        .select(*slices.group, F.max("_max").over(earlier).alias("_before"))
    )
    return (
        add_earlier(local, slices, totals)
        .withColumn(name, F.greatest(F.col(name), F.col("_before")))
        .drop("_before", "_value", _SLICE)
    )
