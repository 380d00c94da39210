"""Is somebody else's request running when mine arrives."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkloom.operators import scans


def busy_at_arrival(
    requests: DataFrame,
    endpoint: str,
    user: str,
    start: str,
    finish: str,
    tie: str,
    task_rows: int = scans.TASK_ROWS,
) -> DataFrame:
    """Add `busy`: requests of others run at my arrival and none of mine does.

    A request runs from its place in arrival order until just before `finish`. If none of mine
    runs, whatever runs belongs to others, so two running maxima of the finish times decide it:
    the latest finish before me at the endpoint, and the latest of my own. No pair of overlapping
    requests is ever formed, however many run at once.
    """
    with_any = scans.earlier_max(
        requests, [endpoint], start, tie, F.col(finish), "_any_until", task_rows
    )
    with_own = scans.earlier_max(
        with_any, [endpoint, user], start, tie, F.col(finish), "_own_until", task_rows, counted=requests
    )
    any_runs = F.coalesce(F.col("_any_until") > F.col(start), F.lit(False))
    own_runs = F.coalesce(F.col("_own_until") > F.col(start), F.lit(False))
    return with_own.withColumn("busy", any_runs & ~own_runs).drop("_any_until", "_own_until")
