"""Star schema builders. Formulas not fixed by the table definitions are arguments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeweave import contracts
from lakeweave.functions.predicates import between_days
from lakeweave.functions.scalars import day_name, minutes_between, month_name, weekend_flag
from lakeweave.operators.aggregates import group_totals


def to_contract(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Cast to the contract; a null in a required column or an overflow fails the job."""
    columns = []
    for field in contract:
        column = F.col(f"`{field.name}`").cast(field.dataType)
        if not field.nullable:
            column = F.coalesce(column, F.raise_error(F.lit(f"{field.name} must not be null")).cast(field.dataType))
        columns.append(column.alias(field.name))
    return df.select(columns)


def dim_date(days: DataFrame, column: str = "date") -> DataFrame:
    day = F.col(column)
    return to_contract(days.select(
        day.alias("DateKey"),
        F.year(day).alias("YearKey"),
        F.month(day).alias("MonthNumber"),
        month_name(day).alias("MonthName"),
        F.quarter(day).alias("Quarter"),
        day_name(day).alias("DayName"),
        weekend_flag(day).alias("IsWeekend"),
    ), contracts.DIM_DATE)


def dim_fx(silver_fx: DataFrame, base: str = "USD", quote: str = "EUR",
           invert_rate: bool = False) -> DataFrame:
    """One pair, as the key is the day alone. The rate is units of ``base`` per
    ``quote``; ``invert_rate`` turns it round."""
    rate = F.col("exchange_rate").cast("decimal(18,4)")
    if invert_rate:
        rate = F.when(rate != 0, F.lit(1) / rate)
    pair = (F.col("base_currency") == base) & (F.col("target_currency") == quote)
    return to_contract(silver_fx.filter(pair).select(
        F.col("date").alias("DateKey"), rate.alias("ExchangeRate")), contracts.DIM_FX)


def dim_gdp(silver_gdp: DataFrame, country: str | None = None) -> DataFrame:
    rows = silver_gdp if country is None else silver_gdp.filter(F.col("country_code") == country)
    return to_contract(rows.select(
        F.col("year").alias("YearKey"), F.col("gdp_usd").alias("GDP_Value")), contracts.DIM_GDP)


def dim_zone(silver_taxi: DataFrame, silver_air: DataFrame, taxi_zone: str = "pickup_zone",
             air_zone: str = "locality", taxi_label: str = "Taxi", air_label: str = "Weather") -> DataFrame:
    """One row per zone name; a name found in both sources carries the taxi label."""
    def names(df: DataFrame, column: str, rank: int) -> DataFrame:
        zone = F.col(column)
        return df.filter(zone.isNotNull()).select(zone.alias("StandardZone"), F.lit(rank).alias("r")).distinct()

    labels = F.when(F.col("r") == 0, taxi_label).otherwise(air_label)
    merged = names(silver_taxi, taxi_zone, 0).unionByName(names(silver_air, air_zone, 1))
    return to_contract(merged.groupBy("StandardZone").agg(F.min("r").alias("r"))
                       .select("StandardZone", labels.alias("SourceType")), contracts.DIM_ZONE)


def exact_mean(number: Column) -> Column:
    """Mean of decimals: the same whatever order tasks finish in."""
    return F.avg(number.cast("decimal(18,6)"))


def fact_taxi_daily(silver_taxi: DataFrame, fare: str = "total_amount",
                    minutes: Column | None = None) -> DataFrame:
    """Trips per day, hour and zone. Silver has no fare column, so the mean fare
    is that of ``total_amount`` unless another column is named."""
    duration = minutes if minutes is not None else minutes_between(
        F.col("pickup_datetime"), F.col("dropoff_datetime"))
    grouped = silver_taxi.groupBy(
        F.to_date("pickup_datetime").alias("DateKey"),
        F.col("pickup_hour").alias("HourOfDay"), "pickup_zone")
    return to_contract(grouped.agg(
        F.count(F.lit(1)).alias("TotalTrips"),
        F.sum("total_amount").alias("TotalRevenue"),
        exact_mean(F.col(fare)).alias("AvgFare"),
        exact_mean(F.col("trip_distance")).alias("AvgTripDistance"),
        exact_mean(duration).alias("AvgTripDuration"),
    ), contracts.FACT_TAXI_DAILY)


def hourly_totals(silver_taxi: DataFrame, first: str, last: str) -> DataFrame:
    """Trips and revenue per day, hour and zone, from ``first`` to midnight of ``last``."""
    time = F.col("pickup_datetime")
    kept = silver_taxi.filter(between_days(time, first, last) & time.isNotNull() & F.col("pickup_zone").isNotNull())
    keyed = kept.select(F.to_date(time).alias("DateKey"), F.col("pickup_hour").alias("HourOfDay"),
                        "pickup_zone", "total_amount")
    return group_totals(keyed, ["DateKey", "HourOfDay", "pickup_zone"], F.col("total_amount"))


def fact_air_daily(silver_air: DataFrame) -> DataFrame:
    grouped = silver_air.groupBy(
        F.col("date").alias("DateKey"), "timezone", "locality", "location_name",
        F.col("parameter_name").alias("Pollutant"))
    return to_contract(grouped.agg(
        exact_mean(F.col("value")).alias("AvgValue"),
        F.count(F.lit(1)).alias("ReadingCount"),
    ), contracts.FACT_AIR_DAILY)

