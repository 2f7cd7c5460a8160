"""Parquet folders and catalog tables: overwrite, append, create, insert-ignore."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeweave.functions.scalars import utc_day
from lakeweave.operators import dedupe, joins
from lakeweave.operators.shape import quoted
from lakeweave.plans.gold import to_contract


#: The table property that lists columns without nulls.
REQUIRED = "lakeweave.required"


def balanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Group rows by output partition before a partitioned write.

    Avoids one file per task and partition; AQE merges small partitions and
    splits a large one, so a hot partition value is still written by many tasks.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                  mode: str = "overwrite") -> None:
    balanced(df, partition_by).write.mode(mode).partitionBy(*partition_by).parquet(path)


def save_table(df: DataFrame, name: str, partition_by: Sequence[str] = (), fmt: str = "parquet",
               path: str | None = None) -> None:
    """Overwrite a table; the schema may change with it."""
    writer = (balanced(df, partition_by).write.format(fmt).mode("overwrite")
              .option("overwriteSchema", "true").partitionBy(*partition_by))
    (writer.option("path", path) if path else writer).saveAsTable(name)


def append_table(df: DataFrame, name: str, fmt: str = "parquet", path: str | None = None) -> None:
    """Append. A rerun adds the rows again; ``insert_ignore`` does not."""
    writer = df.write.format(fmt).mode("append")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def ensure_table(spark: SparkSession, name: str, schema: T.StructType, time: str,
                 day: str = "day", fmt: str = "parquet", path: str | None = None) -> None:
    """Create a table partitioned by the day of ``time``, unless it exists.

    Columns that the schema does not allow to be null are marked as such in the
    table's properties (Spark reads file tables as nullable); ``insert_ignore``
    refuses rows that lack them.
    """
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema)
    required = ",".join(f.name for f in schema if not f.nullable)
    location = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS IDENTIFIER(:name) ({columns}, {quoted(day)} DATE "
              f"COMMENT 'day of {time}') USING {fmt} PARTITIONED BY ({quoted(day)}){location} "
              f"TBLPROPERTIES ('{REQUIRED}' = '{required}')", {"name": name})


def required_columns(spark: SparkSession, name: str) -> list[str]:
    """Columns of a table made by ``ensure_table`` that must not be null."""
    shown = spark.sql("SHOW TBLPROPERTIES IDENTIFIER(:name)", {"name": name})
    row = shown.filter(F.col("key") == REQUIRED).first()
    return [c for c in row["value"].split(",") if c] if row else []


def without_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same rows; a null in one of the columns fails the job that writes them."""
    checked = {c: F.when(F.col(c).isNull(), F.raise_error(F.lit(f"{c} must not be null")).cast(df.schema[c].dataType))
               .otherwise(F.col(c)) for c in columns if c in df.columns}
    return df.withColumns(checked) if checked else df


def ensure_folder(spark: SparkSession, path: str, schema: T.StructType,
                  partition_by: Sequence[str] = ()) -> None:
    """Create an empty Parquet folder, unless it exists."""
    (spark.createDataFrame([], schema).write.mode("ignore")
     .partitionBy(*partition_by).parquet(path))


def new_rows(source: DataFrame, sink: DataFrame, keys: Sequence[str],
             time: str | None = None, day: str | None = None) -> DataFrame:
    """Rows of ``source`` that an insert ignoring existing keys would add.

    One row per new key. A null key never conflicts, so such rows all count as
    new and skip both shuffles. With ``time`` only the part of the sink inside
    the source's time range is read, with ``day`` only those partitions.
    """
    has_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    unique = dedupe.first_by_key(source.filter(~has_null), list(keys)).select(source.columns)
    if time is not None:
        bounds = source.agg(F.min(time).alias("lo"), F.max(time).alias("hi"))
        low, high = bounds.select("lo").scalar(), bounds.select("hi").scalar()
        sink = sink.filter((F.col(time) >= low) & (F.col(time) <= high))
        if day is not None:
            kind = source.schema[time].dataType
            sink = sink.filter((F.col(day) >= utc_day(low, kind)) & (F.col(day) <= utc_day(high, kind)))
    return joins.unseen(unique, sink, keys).unionByName(source.filter(has_null))


def insert_ignore(source: DataFrame, table: str, keys: Sequence[str], time: str,
                  day: str = "day") -> None:
    """Load into a table made by ``ensure_table``. Run twice it loads once."""
    sink = source.sparkSession.read.table(table)
    needed = required_columns(source.sparkSession, table)
    stored = utc_day(F.col(time), source.schema[time].dataType)
    fresh = new_rows(source, sink, keys, time, day).withColumn(day, stored)
    balanced(without_nulls(fresh, needed), [day]).select(sink.columns).write.mode("append").insertInto(table)


def save_gold(df: DataFrame, name: str, contract: T.StructType, fmt: str = "parquet",
              path: str | None = None) -> None:
    save_table(to_contract(df, contract), name, fmt=fmt, path=path)
