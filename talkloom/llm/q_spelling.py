"""Query op13_spelling. DuckDB has no crc32, so tests hold it against a brute-force version."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talkloom.llm import spelling

EVERY = 31


def slipped(doc_id: Column, word: Column) -> Column:
    """The word without one letter where the checksum h of document and word is divisible by EVERY; as it is without a doc_id."""
    h = F.crc32(F.concat(doc_id.cast("string"), F.lit(":"), word).cast("binary"))
    at = (h % F.length(word)).cast("int")
    shorter = F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))
    return F.when(h % EVERY == 0, shorter).otherwise(word)


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of at least seven letters that occurs twice, its near words, form and root."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return spelling.variants(spelling.counted(docs, slipped))


QUERIES = {"op13_spelling": (op13_spelling, None)}
