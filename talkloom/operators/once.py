"""Computed columns that stay computed once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_columns_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns through a generator of one row.

    A filter on a plain projection is pushed below it and repeats the expression it filters on,
    with all that expression is made of. Parsing and scoring are too large for that; a filter on
    a generated column stays above.
    """
    made = F.struct(*[column.alias(name) for name, column in columns.items()])
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(made)))
