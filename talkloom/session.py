"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_DUPLICATE_KEYS = "spark.sql.variant.allowDuplicateKeys"
_MAP_KEYS = "spark.sql.mapKeyDedupPolicy"
_CHECKPOINT_DIR = "spark.checkpoint.dir"


def prepare(spark: SparkSession) -> SparkSession:
    """Let parsed variants and maps keep the last of two equal keys, as JSON readers in Python do."""
    spark.conf.set(_DUPLICATE_KEYS, "true")
    spark.conf.set(_MAP_KEYS, "LAST_WIN")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """A new folder for intermediate tables, below the shared folder the cluster names.

    Only a session that names none (a test on one machine) gets a temporary folder.
    """
    root = spark.conf.get(_CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {_CHECKPOINT_DIR} to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="talkloom-")
    return f"{root.rstrip('/')}/talkloom-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write a table that several parts of a plan read, and read it back; lost executors lose nothing."""
    folder = shared_dir(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def shipped(df: DataFrame) -> DataFrame:
    """df, once the executors' Python has this package, whose functions are about to run on its rows."""
    context = df.sparkSession.sparkContext
    if not getattr(context, "_talkloom_shipped", False):
        package = Path(__file__).parent
        archive = Path(tempfile.mkdtemp()) / f"{package.name}-core.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for path in sorted(package.rglob("*.py")):
                out.write(path, path.relative_to(package.parent))
        context.addPyFile(str(archive))
        context._talkloom_shipped = True
    return df
