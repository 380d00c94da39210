"""Readers of dialogue files, record files and parallel text."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkloom import schemas, session
from talkloom.functions import prompts


def read_dialogues(spark: SparkSession, path: str, system: str | None = None, fields: T.StructType | None = None) -> DataFrame:
    """S1. Nested dialogue files, `examples` an object or an array, in source order.

    One file is one JSON document and is read by one task; for a large corpus keep one example per
    line and use read_examples. `system` stands in for a missing system text. A document that has
    examples in neither form is an error. Of examples with the same id the last one counts, in the
    place of the first. `fields` names what else of the top of a document comes as columns.
    """
    return _examples_of(session.prepare(spark).read.text(path, wholetext=True), system, fields)


def read_dialogue_lines(spark: SparkSession, path: str, system: str | None = None) -> DataFrame:
    """S1, one dialogue document a line and any number of them in a file: files are split like any text.

    Columns and rules are those of read_dialogues; `file` is the file that a document stands in. Empty lines are no documents.
    """
    lines = session.prepare(spark).read.text(path)
    return _examples_of(lines.filter(F.trim("value") != ""), system)


def _examples_of(documents: DataFrame, system: str | None, fields: T.StructType | None = None) -> DataFrame:
    more = [*fields] if fields else []
    raw = documents.select(
        F.col("_metadata.file_path").alias("file"),
        F.from_json("value", T.StructType([*schemas.DIALOG_MAP, *more])).alias("m"),
        F.from_json("value", T.StructType([*schemas.DIALOG_ARRAY, *more])).alias("a"),
        F.col("value"),
    )
    bad = F.raise_error(F.concat(F.lit("no examples in "), F.col("file")))
    entry = "array<struct<key:string,value:" + schemas.EXAMPLE.simpleString() + ">>"
    by_id = F.map_from_entries(F.map_entries("m.examples"))
    numbered = F.transform("a.examples", lambda e, i: F.struct(i.cast("string").alias("key"), e.alias("value")))
    entries = F.coalesce(F.map_entries(by_id).cast(entry), numbered.cast(entry), bad.cast(entry))
    text = F.coalesce("m.system", "a.system", F.lit(system).cast("string"))
    own = [F.coalesce(F.col("m")[f.name], F.col("a")[f.name]).alias(f.name) for f in more]
    return raw.select("file", *own, text.alias("system"), F.posexplode(entries).alias("pos", "e")).select(
        "file", *[f.name for f in more], "system", "pos", F.col("e.key").alias("example_id"), "e.value.prompt", "e.value.answer"
    )


def read_examples(spark: SparkSession, path: str) -> DataFrame:
    """S1 for large corpora: one example per JSON line."""
    return spark.read.schema(schemas.EXAMPLE_LINE).json(path)


def read_sft(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """S2/U1. Record files as named splits of one table."""
    parts = [
        spark.read.schema(schemas.SFT).json(path).withColumn("split", F.lit(name))
        for name, path in paths.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def read_prompts(spark: SparkSession, path: str, schema: T.StructType = schemas.SFT) -> DataFrame:
    """S3. A file that holds one JSON array of records."""
    return spark.read.schema(schema).json(path, multiLine=True)


def read_prompt_parts(spark: SparkSession, path: str, schema: T.StructType = schemas.SFT) -> DataFrame:
    """S3 for arrays of any length, as write_prompt_array writes them: one element a line, read in parallel."""
    lines = spark.read.text(path).select(F.regexp_replace("value", r"^,", "").alias("value"))
    elements = lines.filter(~F.col("value").isin("[", "]"))
    return elements.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("_row")).select("_row.*")


def read_pairs(spark: SparkSession, path: str, sep: str = "|") -> DataFrame:
    """S4. Delimited parallel text with a header line."""
    return spark.read.schema(schemas.PAIR).csv(path, sep=sep, header=True, quote='"', mode="FAILFAST")


def pairs_to_sft(pairs: DataFrame, shot: tuple[str, str], task: str, system: str | None = None) -> DataFrame:
    """P12. Records that ask to rewrite the original and answer with the translation."""
    return pairs.select(
        F.lit(system).cast("string").alias("system"),
        prompts.few_shot_prompt(*shot, F.col("original"), task).alias("user"),
        F.col("translated").alias("bot"),
    )
