"""The whole way from landed files to measures, one function per step.

Each step reads stored tables and stores one or more, so a lost step is run
again on its own. Row counts come from the footers of what was written.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from lakeweave import contracts
from lakeweave.operators import checks, series
from lakeweave.plans import gold, silver, suites
from lakeweave.plans.model import Model, star_model
from lakeweave.sinks import export, tables as sinks
from lakeweave.sources import files, nested
from lakeweave.sources.tables import suffixed_tables
from lakeweave.streaming import sync

GOLD = {
    "DimDate": contracts.DIM_DATE, "DimFX": contracts.DIM_FX, "DimGDP": contracts.DIM_GDP,
    "DimZone": contracts.DIM_ZONE, "FactTaxiDaily": contracts.FACT_TAXI_DAILY,
    "FactAirQualityDaily": contracts.FACT_AIR_DAILY,
}


@dataclass(frozen=True)
class Names:
    """Table names; ``prefix`` may hold a schema, such as ``lake.``."""

    taxi: str = "taxi_silver"
    air: str = "air_silver"
    fx: str = "fx_silver"
    gdp: str = "gdp_silver"
    weather: str = "weather_silver"
    metrics: str = "weather_metrics"
    gold_prefix: str = "gold_"

    def silver(self) -> dict[str, str]:
        return {"taxi": self.taxi, "air": self.air, "fx": self.fx, "gdp": self.gdp, "weather": self.weather}

    def gold(self, table: str) -> str:
        return f"{self.gold_prefix}{table}"


def store(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> int:
    """Overwrite a table and return its row count; counting reads no column."""
    sinks.save_table(df, name, partition_by)
    return df.sparkSession.read.table(name).count()


def merge_taxi_files(spark: SparkSession, folder: str, target: str) -> int:
    """Monthly files of any schema version to one conforming Parquet folder."""
    merged = files.read_drifting(spark, files.list_files(spark, folder), contracts.BRONZE_TAXI)
    sinks.write_parquet(merged, target)
    return files.read_parquet(spark, target, contracts.BRONZE_TAXI).count()


def taxi(spark: SparkSession, merged: str, lookup_csv: str, names: Names = Names(),
         years: Iterable[int] = silver.YEARS) -> int:
    trips = files.read_parquet(spark, merged, contracts.BRONZE_TAXI)
    lookup = files.read_csv(spark, lookup_csv, contracts.ZONE_LOOKUP)
    return store(silver.taxi(trips, lookup, years), names.taxi)


def air_pages(spark: SparkSession, locations: str, days: DataFrame, table: str) -> int:
    """Landed location pages and reading pages (with their ``sensor_id``) to a bronze table."""
    pages = nested.read_pages(spark, locations, contracts.LOCATION_PAGE)
    return store(silver.air_bronze(nested.flatten_locations(pages), nested.flatten_readings(days)), table)


def air(spark: SparkSession, stem: str, suffixes: Sequence[str] = ("21", "22", "23", "24"),
        names: Names = Names(), years: Iterable[int] = silver.YEARS) -> int:
    return store(silver.air(suffixed_tables(spark, stem, suffixes).values(), years), names.air)


def fx_file(spark: SparkSession, path: str, table: str) -> int:
    """The exchange-rate CSV to its bronze table."""
    return store(files.read_typed_csv(spark, path, contracts.FX_FILE).drop(*contracts.FX_DROPPED), table)


def fx(spark: SparkSession, bronze: str, names: Names = Names(),
       first: str = silver.FX_CALENDAR[0], last: str = silver.FX_CALENDAR[1]) -> int:
    return store(silver.fx(spark.read.table(bronze), first, last), names.fx)


def gdp_file(spark: SparkSession, path: str, table: str) -> int:
    """The GDP document to its bronze table."""
    return store(silver.gdp_bronze(nested.read_json_envelope(spark, path, contracts.GDP_RECORD)), table)


def gdp(spark: SparkSession, bronze: str, names: Names = Names(),
        excluded_year: int = silver.GDP_EXCLUDED_YEAR) -> int:
    return store(silver.gdp(spark.read.table(bronze), excluded_year), names.gdp)


def weather(spark: SparkSession, bronze: str, names: Names = Names(), **bounds) -> int:
    return store(silver.weather(spark.read.table(bronze), **bounds), names.weather, ["year"])


def star(spark: SparkSession, names: Names = Names(), calendar: tuple[str, str] = silver.FX_CALENDAR,
         invert_rate: bool = False) -> None:
    """All gold tables from the silver ones."""
    read = {key: spark.read.table(name) for key, name in names.silver().items() if key != "weather"}
    built = {
        "DimDate": gold.dim_date(series.calendar(spark, *calendar)),
        "DimFX": gold.dim_fx(read["fx"], invert_rate=invert_rate),
        "DimGDP": gold.dim_gdp(read["gdp"]),
        "DimZone": gold.dim_zone(read["taxi"], read["air"]),
        "FactTaxiDaily": gold.fact_taxi_daily(read["taxi"]),
        "FactAirQualityDaily": gold.fact_air_daily(read["air"]),
    }
    for table, df in built.items():
        sinks.save_gold(df, names.gold(table), GOLD[table])


def load_model(spark: SparkSession, names: Names = Names()) -> Model:
    return star_model({table: spark.read.table(names.gold(table)) for table in GOLD})


def quality(spark: SparkSession, names: Names = Names(), only: Sequence[str] | None = None,
            options: Mapping[str, dict] | None = None) -> DataFrame:
    """Report lines of the suites over whole silver tables."""
    chosen = {k: v for k, v in names.silver().items() if only is None or k in only}
    rows = [suites.check_table(spark.read.table(table), key, **(options or {}).get(key, {}))
            for key, table in chosen.items()]
    return checks.report(reduce(DataFrame.unionByName, rows))


def export_hourly(spark: SparkSession, path: str, first: str, last: str, names: Names = Names(),
                  limit: int = 100) -> None:
    totals = gold.hourly_totals(spark.read.table(names.taxi), first, last)
    export.export_json(totals, path, ["DateKey", "HourOfDay", "pickup_zone"], limit)


def sync_weather(spark: SparkSession, names: Names = Names(), **options) -> int:
    """Weather to the metrics table, a day at a time; returns the number of chunks."""
    sinks.ensure_table(spark, names.metrics, contracts.WEATHER_METRICS, "time")
    return sync.sync_all(spark.read.table(names.weather), names.metrics, ["time", "zone"], "weather_timestamp",
                         prepare=sync.to_metrics, sink_time="time", year="year", **options)
