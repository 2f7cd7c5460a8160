"""Calendars, spines and forward fill."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeweave.operators.shape import quoted

# Copies of one row are carried as a count and written out again in two steps,
# so that no array holds more than this many entries.
COPIES_PER_CHUNK = 100_000


def day_sequence(first: Column, last: Column) -> Column:
    """Days from ``first`` to ``last``, both included; null when out of order."""
    return F.when(first <= last, F.sequence(first, last, F.expr("interval 1 day")))


def calendar(spark: SparkSession, first: str, last: str, name: str = "date") -> DataFrame:
    bounds = spark.range(1).select(F.lit(first).cast("date").alias("f"), F.lit(last).cast("date").alias("l"))
    return bounds.select(F.explode(day_sequence(F.col("f"), F.col("l"))).alias(name))


def calendar_of(df: DataFrame, column: str, name: str = "date") -> DataFrame:
    """Every day between the first and the last date of a column."""
    day = F.to_date(column)
    bounds = df.agg(F.min(day).alias("f"), F.max(day).alias("l"))
    return bounds.select(F.explode(day_sequence(F.col("f"), F.col("l"))).alias(name))


def spine(df: DataFrame, keys: Sequence[str], first: Column, last: Column,
          name: str = "date") -> DataFrame:
    """Every distinct key on every day.

    The days are generated next to each key, which gives the rows of a product
    of calendar and keys without a join.
    """
    return (df.select(*keys).distinct()
            .select(F.explode(day_sequence(first, last)).alias(name), *keys))


def forward_fill(df: DataFrame, keys: Sequence[str], date: str, value: str,
                 first: Column, last: Column) -> DataFrame:
    """Daily series per key, each gap filled with the last known value.

    Gives what a spine, a left join and ``last(ignore nulls)`` over the ordered
    key would give: days before the first value are left out, observations
    outside ``first``..``last`` vanish, and several observations of one day all
    stay (the largest is carried on, a null one takes the day's largest).

    Only one row per key and day is shuffled and windowed, so a window holds at
    most as many rows as the calendar has days, however many observations a key
    has. Non-null observations pass through without any shuffle, and the gaps
    are generated from the distance to the next observed day.
    """
    observed = (df.select(F.col(date).alias("__day"), *keys, F.col(value).alias("__value"))
                .filter((F.col("__day") >= first) & (F.col("__day") <= last)))
    for key in keys:  # a null key matches no spine row
        observed = observed.filter(F.col(key).isNotNull())
    daily = observed.groupBy(*keys, "__day").agg(
        F.max("__value").alias("__close"),
        F.count_if(F.col("__value").isNull()).alias("__gaps"))

    ordered = W.partitionBy(*keys).orderBy("__day")
    carried = F.last("__close", ignorenulls=True).over(
        ordered.rowsBetween(W.unboundedPreceding, W.currentRow))
    following = F.lead("__day").over(ordered)
    filled = (daily.select(*keys, "__day", "__gaps", carried.alias("__value"), following.alias("__next"))
              .filter(F.col("__value").isNotNull()))

    # Days until the next observed one, each once, and the day itself as often as
    # it has null observations. Those are equal rows, so they travel as a count.
    until = F.coalesce(F.date_sub("__next", 1), last)
    later = F.coalesce(day_sequence(F.date_add("__day", 1), until), F.array().cast("array<date>"))
    days = F.concat(
        F.transform(later, lambda d: F.struct(d.alias("day"), F.lit(1).cast("bigint").alias("copies"))),
        F.when(F.col("__gaps") > 0, F.array(F.struct(F.col("__day").alias("day"), F.col("__gaps").alias("copies"))))
        .otherwise(F.array().cast("array<struct<day:date,copies:bigint>>")))
    size = COPIES_PER_CHUNK
    rows = (filled.select(*keys, "__value", F.explode(days).alias("d"))
            .select(*keys, "__value", "d", F.explode(
                F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("d.copies") - 1) / size))).alias("chunk"))
            .select(*keys, "__value", "d.day", F.explode(
                F.sequence(F.lit(1).cast("bigint"), F.least(F.lit(size), F.col("d.copies") - F.col("chunk") * size)))))

    known = observed.filter(F.col("__value").isNotNull())
    return (known.select(F.col("__day").alias(date), *keys, F.col("__value").alias(value))
            .unionByName(rows.select(F.col("day").alias(date), *keys, F.col("__value").alias(value))))


def carry_forward(df: DataFrame, keys: Sequence[str], time: str, value: str, span_seconds: int = 3600) -> DataFrame:
    """The rows of ``df``, each missing value filled with the last known one of its key, at any grain of time.

    Rows of one time count as ordered by value, missing ones last. A value stays
    missing where none is known yet or the row has no time; a null key is a key
    like others.

    The times of a key are cut into ranges of ``span_seconds``. What is known at
    the end of each range, one row per key and range, is handed to the ranges
    behind it, so that one key is filled by many tasks. Rows that have a value
    pass through without a shuffle; each time of a key travels once.
    """
    names = [f"__k{i}" for i in range(len(keys))]
    epoch = F.lit("1970-01-01").cast(df.schema[time].dataType)
    slot = F.floor(F.timestamp_diff("SECOND", epoch, F.col(quoted(time))) / span_seconds)
    placed = [*[F.col(quoted(k)).alias(n) for k, n in zip(keys, names)], slot.alias("__slot"), F.col(quoted(time)).alias("__time")]
    known, timed = F.col(quoted(value)).isNotNull(), F.col(quoted(time)).isNotNull()
    kind = df.schema[value].dataType

    points = (df.filter(known & timed).select(*placed, F.col(quoted(value)).alias("__value"))
              .groupBy(*names, "__slot", "__time").agg(F.max("__value").alias("__value")))
    row = F.struct(*[F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(df.columns)])
    gaps = df.filter(~known & timed).select(*placed, F.lit(None).cast(kind).alias("__value"), row.alias("__row"))

    ends = points.groupBy(*names, "__slot").agg(F.max_by("__value", "__time").alias("__value"))
    asked = gaps.select(*names, "__slot", "__value").distinct()
    ranges = ends.unionByName(asked).groupBy(*names, "__slot").agg(F.max("__value").alias("__value"))
    before = F.last("__value", ignorenulls=True).over(
        W.partitionBy(*names).orderBy("__slot").rowsBetween(W.unboundedPreceding, -1))
    carried = (ranges.select(*names, "__slot", F.lit(None).cast(df.schema[time].dataType).alias("__time"), before.alias("__value"))
               .filter(F.col("__value").isNotNull()))

    lines = points.unionByName(carried).withColumn("__row", F.lit(None).cast(gaps.schema["__row"].dataType)).unionByName(gaps)
    # What is carried in has no time and comes first; a missing value comes after the known ones of its time.
    ordered = W.partitionBy(*names, "__slot").orderBy(F.asc_nulls_first("__time"), F.col("__row").isNotNull())
    last = F.last("__value", ignorenulls=True).over(ordered.rowsBetween(W.unboundedPreceding, W.currentRow))
    filled = lines.select("__row", last.alias("__value")).filter(F.col("__row").isNotNull())
    return df.filter(known | ~timed).unionByName(filled.select(*[
        (F.col("__value") if c == value else F.col("__row").getField(f"c{i}")).alias(c) for i, c in enumerate(df.columns)]))
