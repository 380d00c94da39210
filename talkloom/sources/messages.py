"""Message stream source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from talkloom import schemas
from talkloom.operators.admission import new_for_us


def read_messages(
    spark: SparkSession, folder: str, schema: T.StructType = schemas.MESSAGE, files_per_batch: int | None = None
) -> DataFrame:
    """S5. Stream of the new messages addressed to us from a folder of parquet files."""
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return new_for_us(reader.parquet(folder))
