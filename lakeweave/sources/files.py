"""Parquet and CSV readers, including folders whose file schemas drift."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lakeweave.operators.shape import conform


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header. Without a schema Spark reads the file twice to infer one."""
    if schema is None:
        return spark.read.csv(path, header=True, inferSchema=True)
    return spark.read.schema(schema).csv(path, header=True)


def read_typed_csv(spark: SparkSession, path: str, schema: T.StructType,
                   quote: str | None = None) -> DataFrame:
    """CSV with a declared schema. ``quote=None`` switches quoting off, so quote
    marks stay part of the text; a value that does not fit its type is null."""
    return (spark.read.schema(schema)
            .option("header", True)
            .option("quote", quote or "")
            .option("mode", "PERMISSIVE")
            .csv(path))


def list_files(spark: SparkSession, folder: str, pattern: str = "*.parquet") -> list[str]:
    """Paths below ``folder``, listed by Spark so that any storage works.

    Only the path column is read, never the content.
    """
    listing = (spark.read.format("binaryFile")
               .option("pathGlobFilter", pattern)
               .load(folder).select("path"))
    return sorted(row.path for row in listing.collect())


def month_paths(base: str, year: int = 2025, months: Sequence[int] = tuple(range(1, 13)),
                template: str = "{base}/yellow_tripdata_{year}-{month:02d}.parquet") -> list[str]:
    return [template.format(base=base.rstrip("/"), year=year, month=int(m)) for m in months]


def read_drifting(spark: SparkSession, paths: Sequence[str], contract: T.StructType) -> DataFrame:
    """Read files whose schemas differ and conform each to ``contract``.

    Files of one footer schema share a scan, so the plan grows with the number
    of schema versions and not with the number of files. Merging schemas in the
    reader would not do: an ``int`` and a ``double`` version of a column clash.
    """
    if not paths:
        return spark.createDataFrame([], contract)
    with ThreadPoolExecutor(max_workers=16) as pool:
        footers = list(pool.map(lambda p: spark.read.parquet(p).schema, paths))
    versions: dict[str, tuple[T.StructType, list[str]]] = {}
    for path, footer in zip(paths, footers):
        versions.setdefault(footer.json(), (footer, []))[1].append(path)
    parts = [conform(spark.read.schema(footer).parquet(*members), contract)
             for footer, members in versions.values()]
    return reduce(DataFrame.unionByName, parts)


def read_months(spark: SparkSession, base: str, year: int, months: Sequence[int],
                contract: T.StructType, **template: str) -> DataFrame:
    return read_drifting(spark, month_paths(base, year, months, **template), contract)
