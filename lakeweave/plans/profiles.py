"""The checks a silver job makes on its own result, each in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeweave.operators import aggregates, dedupe, ordering


def taxi(df: DataFrame) -> DataFrame:
    """One row: rows, nulls per column, anomalies that should be 0, days covered."""
    return aggregates.profile(df, {
        "negative_totals": F.col("total_amount") <= 0,
        "negative_distances": F.col("trip_distance") <= 0,
        "negative_surcharges": F.col("congestion_surcharge") < 0,
        "zero_passengers": F.col("passenger_count") == 0,
    }, day="pickup_datetime")


def air(df: DataFrame) -> DataFrame:
    return aggregates.profile(df, {"negative_readings": F.col("value") < 0}, day="date")


def air_parameters(df: DataFrame) -> DataFrame:
    return dedupe.key_counts(df, ["parameter_name"])


def air_localities(df: DataFrame, n: int = 10) -> DataFrame:
    return ordering.top_groups(df, "locality", n)


def fx(df: DataFrame) -> DataFrame:
    """``duplicates`` is the number of days and pairs with more than one rate."""
    repeated = dedupe.repeated_keys(df, ["date", "base_currency", "target_currency"]).agg(F.count(F.lit(1)))
    return (aggregates.profile(df, {"impossible_rates": F.col("exchange_rate") <= 0}, day="date")
            .withColumn("duplicates", repeated.scalar()))


def gdp(df: DataFrame) -> DataFrame:
    return df.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in df.columns],
        F.min("year").alias("first_year"), F.max("year").alias("last_year"),
        F.count_if(F.col("gdp_usd") <= 0).alias("impossible_values"))


def gdp_summary(df: DataFrame) -> DataFrame:
    return aggregates.numeric_summary(df, "gdp_usd")
