"""Vectors of a table as arrays, and answers of the form query, rank, vector, score."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def usable(table: DataFrame, zero: bool) -> DataFrame:
    """vec_id and embedding (array<double>) of rows whose components are all finite numbers; zero vectors only if asked for."""
    x = F.col("embedding").cast("array<double>")
    rows = table.select(F.col("vec_id").cast("long"), x.alias("embedding")).filter("vec_id IS NOT NULL AND embedding IS NOT NULL")
    rows = rows.filter(F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))
    return rows if zero else rows.filter(F.exists("embedding", lambda v: v != 0))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of equal length as a matrix; shorter ones are filled up with zeros, which no inner product sees."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    width = int(sizes.max()) if len(sizes) else 0
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def widened(a: np.ndarray, width: int) -> np.ndarray:
    return a if a.shape[1] == width else np.pad(a, ((0, 0), (0, width - a.shape[1])))


def best(found: DataFrame, k: int) -> DataFrame:
    """The k highest scores of each query, ties to the smaller vec_id."""
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int"), "vec_id", "score")
