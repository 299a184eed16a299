"""Reading and writing named tables."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


class TableSet(Mapping[str, DataFrame]):
    """Lazily opened tables by logical name.

    ``root`` is a folder of ``<name>.parquet`` files or folders; without it names are catalog
    tables. ``names`` maps logical names to other table names or full paths, which lets one report
    read from several databases. ``overrides`` serves frames directly (intermediates, tests).
    ``schemas`` fixes the read schema (DDL text), so no inference runs and only those columns are
    read.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str | None = None,
        names: Mapping[str, str] | None = None,
        schemas: Mapping[str, str] | None = None,
        overrides: Mapping[str, DataFrame] | None = None,
    ) -> None:
        self._spark = spark
        self._root = root
        self._names = dict(names or {})
        self._schemas = dict(schemas or {})
        self._overrides = dict(overrides or {})

    def __getitem__(self, name: str) -> DataFrame:
        if name in self._overrides:
            return self._overrides[name]
        return read_table(
            self._spark, self._names.get(name, name), self._root, self._schemas.get(name)
        )

    def __iter__(self) -> Iterator[str]:
        return iter(dict.fromkeys([*self._overrides, *self._names, *self._schemas]))

    def __len__(self) -> int:
        return len(list(iter(self)))

    def replaced(self, **frames: DataFrame) -> TableSet:
        """Copy with some tables served from frames."""
        return TableSet(
            self._spark, self._root, self._names, self._schemas, {**self._overrides, **frames}
        )


def read_table(
    spark: SparkSession, name: str, root: str | None = None, schema: str | None = None
) -> DataFrame:
    """Parquet under ``root`` (or at a path-like name), else a catalog table."""
    if root is None and "/" not in name:
        return spark.table(name)
    path = name if "/" in name else f"{root}/{name}.parquet"
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def parse_schema(ddl: str) -> StructType:
    """StructType of a DDL text (needs a running session)."""
    return StructType.fromDDL(ddl)


def write_table(
    df: DataFrame,
    target: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    as_table: bool = False,
    bucket_by: tuple[int, Sequence[str]] | None = None,
    location: str | None = None,
) -> None:
    """Store a report, as files at a path or as a catalog table.

    ``bucket_by`` (catalog tables only) lays rows out by the report key, so the next report joins
    on it without a shuffle. Rows are dealt by the same hash before they are written, so that a task
    writes one bucket and not a file for each. ``location`` puts a table's files outside the
    warehouse. ``mode="overwrite_partitions"`` (files with ``partition_by``) replaces the partitions
    that ``df`` has rows for and leaves the others; nothing is replaced by an empty frame.
    """
    if mode == "overwrite_partitions" and (not partition_by or as_table):
        raise ValueError("partitions are overwritten in files laid out by partition_by")
    if bucket_by is not None:
        if not as_table:
            raise ValueError("bucketing needs a catalog table")
        count, columns = bucket_by
        df = df.repartition(count, *columns)
    writer = df.write.format("parquet")
    if mode == "overwrite_partitions":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by is not None:
        writer = writer.bucketBy(count, *columns).sortBy(*columns)
    if location is not None:
        writer = writer.option("path", location)
    if as_table:
        writer.saveAsTable(target)
    else:
        writer.save(target)


def attach_database(
    spark: SparkSession, database: str, paths: Mapping[str, str], location: str | None = None
) -> dict[str, str]:
    """A database whose tables are the given Parquet files or folders; returns logical -> full names.

    The result is what ``TableSet(names=...)`` takes, so that a report whose tables live in several
    databases finds each by its own name; several results are merged. Only the catalog is written:
    data stays where it is. A table that is already there is left as it is.
    """
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{place}")
    names = {}
    for table, path in paths.items():
        names[table] = f"{database}.{table}"
        if not spark.catalog.tableExists(names[table]):
            spark.catalog.createTable(names[table], path, "parquet")
    return names


def staging_folder(spark: SparkSession) -> str | None:
    """The shared folder the cluster names, else the context's own checkpoint folder, if any."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named or spark.sparkContext.getCheckpointDir()


def fresh_place(spark: SparkSession, name: str) -> str:
    """A path of its own under the shared checkpoint folder; raises where there is none."""
    folder = staging_folder(spark)
    if not folder:
        raise ValueError("staging needs a shared folder: set spark.checkpoint.dir")
    return os.path.join(folder, "staged", f"{name}-{uuid.uuid4().hex}")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate to the shared checkpoint folder and read it back.

    Cuts the lineage at a table every executor can reach, so lost executors cost a re-read and not
    a recomputation. Without a checkpoint folder there is nowhere to write, and it raises.
    """
    path = fresh_place(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
