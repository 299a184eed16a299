"""Shared folder of the cluster, and tables staged in it."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; a folder of our own only where it is unset."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        named = "file://" + tempfile.mkdtemp(prefix="checkpoints-")
        spark.sparkContext.setCheckpointDir(named)
        named = spark.sparkContext.getCheckpointDir() or named
    return named


def fresh_folder(spark: SparkSession, name: str) -> str:
    return os.path.join(shared_folder(spark), "llm", f"{name}-{uuid.uuid4().hex}")


def staged(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Written to the shared folder and read back: a lost executor costs a read, not a recomputation."""
    spark = df.sparkSession
    path = fresh_folder(spark, name)
    df.write.partitionBy(*partition_by).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def discard(*frames: DataFrame) -> None:
    """Deletes the folders of staged tables that nothing will read any more."""
    for df in frames:
        drop_folder(df.sparkSession, df.staged_at)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder that ``fresh_folder`` named, on whatever file system it lies."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def ship_package(spark: SparkSession) -> None:
    """Sends this package's code to the executors, once for each context; tasks then import it."""
    context = spark.sparkContext
    if getattr(context, "_wintide_shipped", False):
        return
    root = Path(__file__).resolve().parents[2]
    archive = Path(tempfile.mkdtemp(prefix="wintide-")) / "wintide_llm.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for source in [root / "wintide" / "__init__.py", *Path(__file__).parent.glob("*.py")]:
            packed.write(source, source.relative_to(root))
    context.addPyFile(str(archive))
    context._wintide_shipped = True
