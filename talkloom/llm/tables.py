"""Intermediate tables in the folder that all executors share, and sizes that decide how work is dealt out."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """A new name below spark.checkpoint.dir. Only a session on one machine may leave the setting empty."""
    root = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {_SETTING} to a folder that the driver and all executors share")
        root = tempfile.gettempdir()
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """Write a table once and read it back: no lineage to repeat, and nothing lost with an executor."""
    folder = shared_folder(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def shipped(df: DataFrame) -> DataFrame:
    """df, once the executors' Python has this package, whose functions are about to run on its rows."""
    context = df.sparkSession.sparkContext
    if not getattr(context, "_llm_shipped", False):
        package = Path(__file__).parents[1]
        archive = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for path in sorted(package.rglob("*.py")):
                out.write(path, path.relative_to(package.parent))
        context.addPyFile(str(archive))
        context._llm_shipped = True
    return df


def units(df: DataFrame, bytes_each: int, size) -> int:
    """How many shards of about bytes_each the column expression size (bytes of a row) makes; at least one."""
    total = df.agg(F.sum(size).alias("n")).first()["n"] or 0
    return max(1, -(-int(total) // bytes_each))


#: Rows up to which a written table is broadcast; each holds a few numbers and a name.
FEW_ROWS = 50_000


def few(table: DataFrame, rows: int = FEW_ROWS) -> DataFrame:
    """Ask for a broadcast of a written table only if a count shows that it is small; else Spark joins it as it sees fit."""
    return F.broadcast(table) if table.limit(rows + 1).count() <= rows else table


def free_names(*own: str) -> Callable:
    """For operators on a table: columns other than `own` bear numbered names while it works, so that its helper columns clash with none."""

    def wrap(work: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        @wraps(work)
        def run(table: DataFrame, *args, **options) -> DataFrame:
            numbered = {c: f"extra{i}" for i, c in enumerate(table.columns) if c not in own}
            out = work(table.withColumnsRenamed(numbered), *args, **options)
            return out.withColumnsRenamed({n: c for c, n in numbered.items()})

        return run

    return wrap
