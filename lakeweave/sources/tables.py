"""Catalog tables, SQL text, local rows and the sink's high-water mark."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The six zones with their coordinates.
ZONES = (
    ("Manhattan", 40.7580, -73.9855),
    ("Queens", 40.6413, -73.7781),
    ("Brooklyn", 40.6782, -73.9442),
    ("Bronx", 40.8448, -73.8648),
    ("Staten Island", 40.5795, -74.1502),
    ("EWR", 40.6895, -74.1745),
)


def table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def suffixed_tables(spark: SparkSession, stem: str, suffixes: Iterable[str]) -> dict[str, DataFrame]:
    """One query per suffix; the name is bound as an identifier, never pasted in."""
    return {s: spark.sql("SELECT * FROM IDENTIFIER(:name)", {"name": f"{stem}{s}"})
            for s in suffixes}


def from_rows(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def zones(spark: SparkSession) -> DataFrame:
    return from_rows(spark, ZONES, "ZoneName string, lat double, lon double")


def high_watermark(df: DataFrame, column: str, default: Column) -> DataFrame:
    """One row, ``watermark``: the largest value, or the default for an empty table."""
    return df.agg(F.coalesce(F.max(column), default).alias("watermark"))


def latest_day(spark: SparkSession, name: str, day: str = "day") -> DataFrame:
    """The newest partition of a table partitioned by day, empty for an empty table.

    Its name comes from the list of partitions, so finding the last time of a
    large table reads one day of it.
    """
    parts = spark.sql("SHOW PARTITIONS IDENTIFIER(:name)", {"name": name})
    newest = parts.filter(~F.col("partition").contains("__HIVE_DEFAULT")).agg(F.max("partition")).first()[0]
    rows = spark.read.table(name)
    if newest is None:
        return rows.limit(0)
    return rows.filter(F.col(day) == F.lit(newest.split("=", 1)[1]).cast("date"))
