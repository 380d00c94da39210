"""Rows of files in their order, and two lists put side by side by position."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from talkloom import session

#: Blocks up to which their table is broadcast.
FEW_BLOCKS = 100_000
BOTH, LEFT_ONLY, RIGHT_ONLY = "both", "left only", "right only"


def number_rows(table: DataFrame, pos: str = "pos") -> DataFrame:
    """Add the dense position of every row from 0, in the order of the files it was read from.

    Files count in order of their paths, blocks of a file in order of their starts, rows of a block as they are read. Rows are numbered where they are read and written down; the numbers of rows of earlier blocks are running sums over a table with a
    row for each block, so there is no order over all rows and no shuffle of them. Call it on a table as read, before any filter or join.
    """
    path, start = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    columns = table.columns
    read = session.materialize(table.select(*columns, path.alias("_path"), start.alias("_start"), F.monotonically_increasing_id().alias("_row")))
    # a block is read by one task, its rows one after another
    counts = read.groupBy("_path", "_start").agg(F.count("*").alias("_rows"), F.min("_row").alias("_first"))
    before = Window.orderBy("_path", "_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = session.materialize(counts.select("_path", "_start", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")))
    small = offsets.limit(FEW_BLOCKS + 1).count() <= FEW_BLOCKS
    placed = read.join(F.broadcast(offsets) if small else offsets, ["_path", "_start"])
    return placed.select(*columns, (F.col("_before") + F.col("_row") - F.col("_first")).alias(pos))


def align_by_position(left: DataFrame, right: DataFrame, pos: str = "pos", side: str = "side") -> DataFrame:
    """J1. Rows of two numbered lists side by side, by an equi-join on the position.

    `side` says if both lists have the position, or which one alone has it because it is longer; no row is dropped. Other columns
    need different names on the two sides.
    """
    clash = (set(left.columns) & set(right.columns)) - {pos}
    if clash:
        raise ValueError(f"both lists have {sorted(clash)}")
    marked = left.withColumn("_in_left", F.lit(True)).join(right.withColumn("_in_right", F.lit(True)), pos, "full")
    found = F.when(F.col("_in_right").isNull(), F.lit(LEFT_ONLY)).when(F.col("_in_left").isNull(), F.lit(RIGHT_ONLY)).otherwise(F.lit(BOTH))
    return marked.withColumn(side, found).drop("_in_left", "_in_right")
