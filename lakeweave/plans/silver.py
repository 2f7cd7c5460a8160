"""Bronze to silver jobs. Each is one lazy plan from scan to result."""

from __future__ import annotations

from collections.abc import Iterable
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeweave.contracts import SILVER_WEATHER
from lakeweave.functions.predicates import all_positive, between_days, non_negative, years_in
from lakeweave.functions.scalars import date_key, nan_to_null, strip_text
from lakeweave.operators import dedupe, joins, series
from lakeweave.operators.shape import project, union_all

# The years and bounds the published jobs keep.
YEARS = (2021, 2022, 2023, 2024)
FX_CALENDAR = ("1999-01-04", "2026-04-30")
WEATHER_RANGE = ("2023-01-01", "2026-05-10")
GDP_EXCLUDED_YEAR = 2025


def taxi(trips: DataFrame, zone_lookup: DataFrame, years: Iterable[int] = YEARS,
         time_type: str = "timestamp_ltz") -> DataFrame:
    """Clean trips with the borough and zone of the pick-up.

    Filters come before the imputation so that they reach the scan, copies are
    removed before the derived columns and the lookup are added so that the one
    shuffle carries nothing it could compute later. Trips that differ only in a
    column not kept here, such as the drop-off zone, count as copies.
    """
    typed = project(trips, {
        "pickup_datetime": ("tpep_pickup_datetime", time_type),
        "dropoff_datetime": ("tpep_dropoff_datetime", time_type),
        "passenger_count": ("passenger_count", "int"),
        "trip_distance": ("trip_distance", "double"),
        "pickup_location_id": "pulocationid",
        "fare_amount": ("fare_amount", "decimal(10,2)"),
        "total_amount": ("total_amount", "decimal(10,2)"),
        "congestion_surcharge": ("congestion_surcharge", "decimal(10,2)"),
    })
    wanted = years_in(F.col("pickup_datetime"), years) & years_in(F.col("dropoff_datetime"), years)
    kept = typed.filter(
        all_positive(F.col("fare_amount"), F.col("total_amount"), F.col("trip_distance")) & wanted)
    zero = F.lit(Decimal("0.00")).cast("decimal(10,2)")
    passengers = F.coalesce(F.col("passenger_count"), F.lit(1))
    surcharge = F.coalesce(F.col("congestion_surcharge"), zero)
    imputed = kept.withColumns({
        "passenger_count": F.when(passengers == 0, 1).otherwise(passengers),
        "congestion_surcharge": F.when(surcharge < 0, zero).otherwise(surcharge),
    })
    pickup = F.col("pickup_datetime")
    parts = dedupe.exact(imputed).withColumns({
        "pickup_year": F.year(pickup),
        "pickup_hour": F.hour(pickup),
        "pickup_day": F.dayofweek(pickup),
        "pickup_month": F.month(pickup),
    })
    return joins.lookup(parts, zone_lookup, "pickup_location_id", "LocationID",
                        {"Borough": "pickup_borough", "Zone": "pickup_zone"},
                        drop=("pickup_location_id", "fare_amount"))


def air(tables: Iterable[DataFrame], years: Iterable[int] = YEARS,
        across_tables: bool = False) -> DataFrame:
    """Daily readings of several yearly tables.

    A copy inside one table goes; a reading found in two tables stays twice
    unless ``across_tables`` is set. The tables are tagged and share one shuffle.
    """
    years = list(years)
    tag = "__table"
    cleaned = []
    for number, df in enumerate(tables):
        typed = project(df, {
            "date": ("date", "date"),
            "location_name": "location_name",
            "locality": "locality",
            "timezone": "timezone",
            "parameter_name": "parameter_name",
            "value": ("value", "double"),
            "parameter_units": "parameter_units",
            "latitude": "latitude",
            "longitude": "longitude",
        })
        kept = (typed.filter(non_negative(F.col("value")) & years_in(F.col("date"), years))
                .withColumn("timezone", strip_text(F.col("timezone"))))
        cleaned.append(kept if across_tables else kept.withColumn(tag, F.lit(number)))
    distinct = dedupe.exact(union_all(*cleaned))
    return distinct.drop(tag).withColumns({
        "locality": F.coalesce(F.col("locality"), F.lit("Unknown")),
        "year": F.year("date"),
        "month": F.month("date"),
        "dayofweek": F.dayofweek("date"),
    })


def fx(rates: DataFrame, first: str = FX_CALENDAR[0], last: str = FX_CALENDAR[1]) -> DataFrame:
    """Daily rate per currency pair, carried over days without a quotation."""
    typed = project(rates, {
        "date": ("TIME_PERIOD", "date"),
        "base_currency": "CURRENCY",
        "target_currency": "CURRENCY_DENOM",
        "exchange_rate": ("OBS_VALUE", "decimal(10,4)"),
    })
    return series.forward_fill(typed, ["base_currency", "target_currency"], "date", "exchange_rate",
                               F.lit(first).cast("date"), F.lit(last).cast("date"))


def gdp(records: DataFrame, excluded_year: int = GDP_EXCLUDED_YEAR) -> DataFrame:
    typed = project(records, {
        "year": ("date", "int"),
        "country_code": "countryiso3code",
        "gdp_usd": ("value", "bigint"),
    })
    return dedupe.exact(typed.filter(F.col("year") != excluded_year))


def weather(readings: DataFrame, first: str = WEATHER_RANGE[0], last: str = WEATHER_RANGE[1],
            end_inclusive_day: bool = False, time_type: str = "timestamp") -> DataFrame:
    """Hourly weather, one row per instant and zone.

    NaN counts as missing. Of several rows for one key the smallest is kept, so
    a rerun gives the same table.
    """
    def measure(name: str) -> Column:
        return F.round(nan_to_null(F.col(name).try_cast("double")), 2)

    typed = readings.select(
        F.col("date").try_cast(time_type).alias("weather_timestamp"),
        F.col("ZoneName").cast("string").alias("zone_name"),
        measure("temperature_2m").alias("temperature_c"),
        measure("relative_humidity_2m").alias("humidity_%"),
        measure("precipitation").alias("precipitation_mm"),
        measure("rain").alias("rain_mm"),
        measure("snowfall").alias("snowfall_cm"),
        measure("wind_speed_10m").alias("wind_speed_kmh"),
        F.col("wind_direction_10m").try_cast("int").alias("wind_direction_deg"),
    )
    kept = typed.filter(between_days(F.col("weather_timestamp"), first, last, end_inclusive_day))
    unique = dedupe.first_by_key(kept, ["weather_timestamp", "zone_name"])
    time = F.col("weather_timestamp")
    return unique.withColumns({
        "DateKey": date_key(time),
        "hour_of_day": F.hour(time),
        "year": F.year(time),
        "month": F.month(time),
        "day_of_week": F.dayofweek(time),
    }).select([F.col(f"`{f.name}`") for f in SILVER_WEATHER])


def gdp_bronze(envelope: DataFrame) -> DataFrame:
    """Flatten GDP records, as read by ``read_json_envelope``, to the bronze table."""
    return envelope.select(
        F.col("indicator.id").alias("indicator_id"),
        F.col("indicator.value").alias("indicator_value"),
        F.col("country.id").alias("country_id"),
        F.col("country.value").alias("country_value"),
        "countryiso3code",
        F.col("date").try_cast("bigint").alias("date"),
        F.col("value").try_cast("decimal(38,0)").try_cast("bigint").alias("value"),
        F.col("decimal").try_cast("double").alias("decimal"),
    )


def air_bronze(locations: DataFrame, readings: DataFrame) -> DataFrame:
    """Readings with the metadata of their sensor; both as flattened pages."""
    joined = joins.attach(readings, locations, "sensor_id")
    return joined.select("location_id", "location_name", "locality", "timezone", "latitude",
                         "longitude", "sensor_id", "parameter_id", "parameter_name",
                         "parameter_units", "parameter_display", "date", "value")
