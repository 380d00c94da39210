"""Keys that hold more rows than one task should take, and joins that stay even with them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkloom import session

TASK_ROWS = 1_000_000
#: Hot keys, or bytes of their rows, up to which a table of them is broadcast.
FEW_KEYS = 16_384
FEW_BYTES = 64 << 20


def hot_keys(df: DataFrame, keys: list[str], task_rows: int, few: int = FEW_KEYS) -> DataFrame | None:
    """Every key above `task_rows` rows with its count `_rows`, None without any.

    Counts are combined before the shuffle. Up to `few` keys come as a local table marked for
    broadcast; more of them are written to the shared folder and joined as Spark sees fit.
    """
    counts = df.groupBy(*keys).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > task_rows)
    seen = counts.limit(few + 1).collect()
    if not seen:
        return None
    if len(seen) > few:
        return session.materialize(counts)
    return F.broadcast(df.sparkSession.createDataFrame(seen, counts.schema))


def left_join_null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left equi-join in which a null key meets a null key; key columns of the left are kept."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(renamed, same, "left").drop(*[f"_r_{k}" for k in keys])


def join_unique(
    left: DataFrame,
    right: DataFrame,
    on: str,
    how: str = "inner",
    task_rows: int = TASK_ROWS,
    counted: DataFrame | None = None,
    few: int = FEW_KEYS,
    few_bytes: int = FEW_BYTES,
) -> DataFrame:
    """Join many rows of `left` with the one row per key of `right`.

    Without a hot key this is the plain join. Otherwise the rows of `right` for hot keys are written
    once to the shared folder and measured: up to `few_bytes` they are broadcast, so that the rows of
    hot keys are not shuffled; beyond that the join of the two written sides is left to adaptive skew
    handling, which cannot split a join with an aggregate. The rest is joined as usual. The rows are
    the same in each case. `counted` is a table that is cheaper to count than `left` and has about
    its rows per key.
    """
    rows = left if counted is None else counted
    hot = hot_keys(rows.filter(F.col(on).isNotNull()), [on], task_rows, few)
    if hot is None:
        return left.join(right, on, how)
    keys = hot.select(on)
    matches = session.materialize(right.join(keys, on, "left_semi"))
    size = matches.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0
    of_hot = left.join(keys, on, "left_semi")
    of_hot = of_hot.join(F.broadcast(matches) if size <= few_bytes else matches, on, how)
    return of_hot.unionByName(left.join(keys, on, "left_anti").join(right, on, how))
