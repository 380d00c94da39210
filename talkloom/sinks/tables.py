"""Writers of records, prompt lists and evaluation reports (K1-K3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkloom import session
from talkloom.operators.scoring import pass_rate


def write_jsonl(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """K1/K2. JSON Lines, replacing what was there; text stays unescaped, nulls stay visible."""
    writer = df.write.mode("overwrite").option("ignoreNullFields", "false")
    (writer.partitionBy(*partition_by) if partition_by else writer).json(path)


def write_prompt_array(df: DataFrame, path: str, order: Sequence[str], columns: Sequence[str]) -> None:
    """K2. A prompt list of any length as one JSON array, one element a line, in the given order.

    The parts in `path`, put together in the order of their names, are one JSON document; no row or
    task holds more than its own part. sources.dialogues.read_prompt_parts reads them in parallel.
    Rows that are equal in `order` come in any order. An empty table gives an empty array.
    """
    rows = df.select(
        F.struct(*order).alias("_at"),
        F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("_line"),
        F.monotonically_increasing_id().alias("_tie"),
    )
    numbered = session.materialize(rows)
    place = F.struct("_at", "_tie")
    first = numbered.agg(F.min(place).alias("_first")).select("_first")
    comma = F.when(place == first.scalar(), F.lit("")).otherwise(F.lit(","))
    elements = numbered.select(F.lit(1).alias("_kind"), "_at", "_tie", F.concat(comma, "_line").alias("value"))
    nothing = F.lit(None)
    brackets = df.sparkSession.createDataFrame([(0, "["), (2, "]")], "_kind int, value string").select(
        "_kind", nothing.cast(rows.schema["_at"].dataType).alias("_at"), nothing.cast("bigint").alias("_tie"), "value"
    )
    lines = elements.unionByName(brackets).orderBy("_kind", "_at", "_tie")
    lines.select("value").write.mode("overwrite").text(path)


def write_report(results: DataFrame, path: str, by: Sequence[str] = ("suite",)) -> None:
    """K3. Per-example results, one folder per suite, and a small summary table next to them.

    The summary is taken from the written results, so nothing is scored twice.
    """
    spark = results.sparkSession
    results.write.mode("overwrite").partitionBy(*by).parquet(f"{path}/results")
    written = spark.read.schema(results.schema).parquet(f"{path}/results")
    pass_rate(written, by).write.mode("overwrite").parquet(f"{path}/summary")
