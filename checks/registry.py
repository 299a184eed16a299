"""Registry of (Spark query, oracle SQL) pairs."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Query, str]] = {}

AS_OF = "2001-08-01"


class Tables:
    """Driver tables by attribute: ``t.orders``."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def comparable(df: DataFrame, maybe_null: Sequence[str]) -> DataFrame:
    """Values that reach Python alike from both engines: dates as ISO text, integer columns that
    hold NULLs as DOUBLE (pandas has no NULL integer)."""

    def shown(field: T.StructField) -> Column:
        if isinstance(field.dataType, T.DateType):
            return F.col(field.name).cast("string").alias(field.name)
        if field.name in maybe_null:
            return F.col(field.name).cast("double").alias(field.name)
        return F.col(field.name)

    return df.select(*[shown(f) for f in df.schema.fields])


def query(
    sql: str, maybe_null: Sequence[str] = ()
) -> Callable[[Callable[[Tables], DataFrame]], Query]:
    """Register ``fn(tables)`` under its own name with its oracle.

    ``maybe_null`` names the integer columns that can hold NULLs; both sides show them as DOUBLE.
    """
    if maybe_null:
        doubles = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in maybe_null)
        sql = f"SELECT * REPLACE ({doubles}) FROM ({sql}) shown"

    def register(fn: Callable[[Tables], DataFrame]) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return comparable(fn(Tables(spark, folder)), maybe_null)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        if fn.__name__ in REGISTRY:
            raise ValueError(f"query {fn.__name__!r} is registered twice")
        REGISTRY[fn.__name__] = (run, sql)
        return run

    return register


def as_of_date(text: str = AS_OF):
    return F.lit(text).cast("date")
