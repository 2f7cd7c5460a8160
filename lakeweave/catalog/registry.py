"""Registration of queries and the plain types their results use."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The given tables of one folder, read when named."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))


def plain(df: DataFrame) -> DataFrame:
    """Dates and times as text, decimals as double, integers as bigint, so that
    two engines give comparable values."""
    columns = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(field.dataType, T.TimestampType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(field.dataType, T.TimestampNTZType):
            # Formatting would pass through the session's zone and its spring gap.
            clock = column.cast("string")
            column = F.concat(F.substring(clock, 1, 19), F.lit("."), F.rpad(F.substring(clock, 21, 6), 6, "0"))
        elif isinstance(field.dataType, (T.DecimalType, T.FloatType)):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            column = column.cast("bigint")
        columns.append(column.alias(field.name))
    return df.select(columns)


def query(sql: str | None = None, name: str | None = None):
    """Register a function from ``Tables`` to a DataFrame under its own name."""

    def add(build: Callable[[Tables], DataFrame]):
        key = name or build.__name__
        if key in QUERIES:
            raise ValueError(f"{key} is registered twice")
        QUERIES[key] = lambda spark, folder: plain(build(Tables(spark, folder)))
        if sql is not None:
            ORACLES[key] = sql
        return build

    return add
