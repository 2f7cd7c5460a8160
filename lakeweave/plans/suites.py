"""The five quality suites of the silver tables and their statistics.

Fixed values: check names, bounds and detail texts are those of the published
reports; statistics keep their names without the pictograms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeweave.functions.scalars import nan_to_null
from lakeweave.functions.text import currency, span, thousands, with_unit
from lakeweave.operators.checks import (
    BalanceCheck, GroupStat, RowCountCheck, Stat, Suite, UniqueCheck, between, dates_between, not_null,
)

RATE_BOUNDS = (0.2, 3.0)
FIRST_GDP_YEAR = 1900
WEATHER_ROWS = 100_000
ZONE_TOLERANCE = 24
WEATHER_DAYS = ("2023-01-01", "2026-12-31")


def _records(name: str, suffix: str = "") -> Stat:
    return Stat(name, (), lambda: F.concat(thousands(F.count(F.lit(1))), F.lit(suffix)))


def _distinct(name: str, column: str) -> Stat:
    return Stat(name, (column,), lambda: thousands(F.count_distinct(column)))


def _days(column: str, name: str = "Processing Window", sep: str = " to ") -> Stat:
    """First to last day; text that is no date, without any day, is reported as such."""
    day = F.col(column).try_cast("date")
    return Stat(name, (column,), lambda: F.when(
        (F.count(column) > 0) & (F.count(day) == 0), F.lit("Invalid Date Format")
    ).otherwise(span(F.min(day), F.max(day), sep)))


def _number(column: str) -> Column:
    """A measured value; NaN counts as missing."""
    return nan_to_null(F.col(column))


def taxi_suite() -> Suite:
    examples = " Examples: [{examples}]"
    return Suite(
        "Taxi Data Quality",
        null_detail="Found {n} null rows",
        checks=(
            between("Positive Total Amount", "total_amount",
                    "Found {n} zero or negative values (<= 0)." + examples, low=0, strict_low=True),
            between("Positive Trip Distance", "trip_distance",
                    "Found {n} zero or negative distance metrics (<= 0)." + examples, low=0, strict_low=True),
            between("Passenger Imputation Check", "passenger_count",
                    "Found {n} trips violating min limit of 1 passenger", low=1),
        ),
        stats=(
            _records("Total Records"),
            _distinct("Unique Zones", "pickup_zone"),
            _days("pickup_datetime"),
            Stat("Total Revenue", ("total_amount",), lambda: currency(F.sum("total_amount"))),
        ),
        nulls_place=2,
    )


def air_suite() -> Suite:
    return Suite(
        "Air Quality Data Quality",
        null_detail="Found {n} null metrics",
        checks=(
            between("Non-Negative Concentration Value", "value",
                    "Found {n} negative pollutant readings (< 0). Examples: [{examples}]", low=0),
        ),
        stats=(
            _records("Total Readings"),
            _distinct("Unique Localities", "locality"),
            GroupStat("Parameters Checked", "parameter_name"),
            GroupStat("Max Value by Parameter", "parameter_name", "value"),
            _days("date"),
        ),
        nulls_place=4,
    )


def fx_suite() -> Suite:
    low, high = RATE_BOUNDS
    return Suite(
        "FX Rate Data Quality",
        null_detail="Found {n} broken fields",
        checks=(
            between(f"Market Rationality Boundary ({low} - {high})", "exchange_rate",
                    "{n} pricing metrics outside bounds", low=F.lit(str(low)).cast("decimal(10,4)"),
                    high=F.lit(str(high)).cast("decimal(10,4)")),
        ),
        stats=(
            _records("Total Trading Days"),
            _days("date"),
            Stat("Max Historical Rate", ("exchange_rate",), lambda: with_unit(F.max("exchange_rate"), 4, "")),
        ),
        nulls_place=1,
    )


def gdp_suite(as_of_year: int | None = None) -> Suite:
    """``as_of_year`` is the last valid year; by default that of the run."""
    latest = F.year(F.current_date()) if as_of_year is None else F.lit(as_of_year)
    return Suite(
        "US GDP Data Quality",
        null_detail="Found {n} empty fields",
        checks=(
            between("Valid Operational History Years", "year",
                    "Found {n} invalid historical dates", low=FIRST_GDP_YEAR, high=latest),
            between("Positive Absolute Value GDP", "gdp_usd",
                    "Found {n} rows experiencing asset collapses <= 0", low=1),
        ),
        stats=(
            Stat("Historical Profiles", (), lambda: F.concat(
                F.count(F.lit(1)).cast("string"), F.lit(" Years Monitored"))),
            Stat("Processing Window", ("year",), lambda: span(F.min("year"), F.max("year"))),
            Stat("Peak US Valuation", ("gdp_usd",), lambda: currency(F.max("gdp_usd"))),
        ),
        nulls_place=1,
    )


def weather_suite(min_rows: int = WEATHER_ROWS, tolerance: int = ZONE_TOLERANCE) -> Suite:
    measured = ("weather_timestamp", "zone_name", "temperature_c", "humidity_%", "precipitation_mm",
                "wind_speed_kmh", "rain_mm", "snowfall_cm", "wind_direction_deg")
    first, last = WEATHER_DAYS
    return Suite(
        "Weather Data Quality",
        total_nulls="Total Nulls",
        checks=(
            *[not_null(c, "Found {n} null values") for c in measured],
            between("Temperature Range (-30°C to 45°C)", "temperature_c",
                    "{n} values outside realistic NYC range", low=-30, high=45),
            between("Humidity Range (0–100%)", "humidity_%", "{n} values outside 0–100 range", low=0, high=100),
            between("Precipitation Non-Negative", "precipitation_mm", "{n} negative precipitation values", low=0),
            between("Rain Non-Negative", "rain_mm", "{n} negative rain values", low=0),
            between("Snowfall Non-Negative", "snowfall_cm", "{n} negative snowfall values", low=0),
            between("Wind Speed Non-Negative", "wind_speed_kmh", "{n} negative wind speed values", low=0),
            between("Wind Direction Range (0–360°)", "wind_direction_deg",
                    "{n} values outside 0–360 range", low=0, high=360),
            dates_between(f"Date Range ({first} to {last})", "weather_timestamp", first, last,
                          "{n} records outside expected date boundaries"),
            UniqueCheck("No Duplicate (timestamp, zone) pairs", ("weather_timestamp", "zone_name"),
                        "{n} duplicate rows found"),
            RowCountCheck(f"Row Count ≥ {min_rows:,}", min_rows,
                          "Only {n} rows found — possible missing data"),
            BalanceCheck("Hourly Completeness per Zone", "zone_name", tolerance,
                         "Row imbalance across zones: {n} hours. Counts: {counts}"),
        ),
        stats=(
            _records("Total Rows"),
            Stat("Unique Zones", ("zone_name",), lambda: F.count_distinct("zone_name").cast("string")),
            Stat("Temp Range", ("temperature_c",), lambda: F.concat(
                with_unit(F.min(_number("temperature_c")), 1, "°C"), F.lit(" to "), with_unit(F.max(_number("temperature_c")), 1, "°C"))),
            Stat("Avg Humidity", ("humidity_%",), lambda: with_unit(F.avg(_number("`humidity_%`")), 1, "%")),
            Stat("Max Precip", ("precipitation_mm",), lambda: with_unit(F.max(_number("precipitation_mm")), 2, " mm")),
            Stat("Max Snowfall", ("snowfall_cm",), lambda: with_unit(F.max(_number("snowfall_cm")), 2, " cm")),
            Stat("Max Wind", ("wind_speed_kmh",), lambda: with_unit(F.max(_number("wind_speed_kmh")), 1, " km/h")),
            _days("weather_timestamp", "Date Range", " → "),
        ),
        nulls_place=1,
    )


SUITES = {"taxi": taxi_suite, "air": air_suite, "fx": fx_suite, "gdp": gdp_suite, "weather": weather_suite}


def check_table(df: DataFrame, suite: str, **options) -> DataFrame:
    """Evaluate the named suite over a whole table."""
    return SUITES[suite](**options).evaluate(df)
