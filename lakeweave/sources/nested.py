"""Nested JSON pages and parallel arrays to flat rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeweave.functions.scalars import date_prefix


def read_pages(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON documents, one per file, with the file path kept as ``source_path``."""
    return (spark.read.schema(schema).option("multiLine", True).json(path)
            .withColumn("source_path", F.col("_metadata.file_path")))


def envelope_records(documents: DataFrame, text: str, record: T.StructType,
                     index: int = 1) -> DataFrame:
    """Records of documents shaped ``[meta, [record, ...]]``, one row each."""
    records = F.from_json(F.get_json_object(F.col(text), f"$[{index}]"), T.ArrayType(record))
    others = [c for c in documents.columns if c != text]
    return (documents.select(*others, F.explode(records).alias("record"))
            .select(*others, "record.*"))


def read_json_envelope(spark: SparkSession, path: str, record: T.StructType,
                       index: int = 1) -> DataFrame:
    return envelope_records(spark.read.text(path, wholetext=True), "value", record, index)


def flatten_locations(pages: DataFrame, parameter_ids: Sequence[int] = (2, 7, 10)) -> DataFrame:
    """One row per wanted sensor, with the fields of its location repeated."""
    location, sensor = F.col("location"), F.col("sensor")
    return (pages.select(F.explode("results").alias("location"))
            .select("location", F.explode("location.sensors").alias("sensor"))
            .filter(F.col("sensor.parameter.id").isin(list(parameter_ids)))
            .select(
                location["id"].alias("location_id"),
                location["name"].alias("location_name"),
                location["locality"].alias("locality"),
                location["timezone"].alias("timezone"),
                location["coordinates"]["latitude"].alias("latitude"),
                location["coordinates"]["longitude"].alias("longitude"),
                sensor["id"].alias("sensor_id"),
                sensor["parameter"]["id"].alias("parameter_id"),
                sensor["parameter"]["name"].alias("parameter_name"),
                sensor["parameter"]["units"].alias("parameter_units"),
                sensor["parameter"]["displayName"].alias("parameter_display"),
            ))


def flatten_readings(pages: DataFrame, key: str = "sensor_id") -> DataFrame:
    """One row per daily reading; a missing or empty time gives a null date."""
    reading = F.col("reading")
    return (pages.select(key, F.explode("results").alias("reading"))
            .select(key,
                    date_prefix(reading["period"]["datetimeFrom"]["utc"]).alias("date"),
                    reading["value"].alias("value")))


def explode_series(df: DataFrame, start: str, end: str, step: str, arrays: Sequence[str],
                   time: str = "date") -> DataFrame:
    """Parallel arrays with epoch bounds and a step in seconds to one row per step.

    ``end`` is exclusive. The time is kept as an instant; ``local_clock`` gives
    the wall-clock of a zone where a report needs it.
    """
    others = [c for c in df.columns if c not in {start, end, step, *arrays}]
    # An empty span has no last step, and a descending sequence would be wrong.
    epochs = F.when(F.col(end) > F.col(start),
                    F.sequence(F.col(start), F.col(end) - 1, F.col(step).cast("bigint")))
    zipped = F.arrays_zip(epochs.alias("epoch"), *[F.col(a) for a in arrays])
    return (df.select(*others, F.explode(zipped).alias("point"))
            .filter(F.col("point.epoch").isNotNull())
            .select(F.timestamp_seconds("point.epoch").alias(time), *others,
                    *[F.col(f"point.{a}").alias(a) for a in arrays]))


def expand(df: DataFrame, column: str, fields: Sequence[str],
           names: Sequence[str] | None = None, schema: T.StructType | None = None) -> DataFrame:
    """Struct fields as columns in place of ``column``.

    With ``schema`` the column is JSON text; a field absent from a document is null.
    """
    source: Column = F.col(column)
    if schema is not None:
        source = F.from_json(source, schema)
    kept = [c for c in df.columns if c != column]
    targets = names or fields
    return (df.select(*kept, source.alias("__expanded"))
            .select(*kept, *[F.col("__expanded")[f].alias(n) for f, n in zip(fields, targets)]))
