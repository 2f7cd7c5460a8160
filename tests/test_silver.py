import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakeweave import contracts
from lakeweave.operators import shape
from lakeweave.plans import gold, silver
from lakeweave.sources import nested

T0 = dt.datetime(2023, 5, 6, 13, 15)


def trip(**changes):
    row = dict(tpep_pickup_datetime=T0, tpep_dropoff_datetime=T0 + dt.timedelta(minutes=12), passenger_count=2.0,
               trip_distance=1.5, pulocationid=7, dolocationid=9, fare_amount=10.0, total_amount=12.5,
               congestion_surcharge=2.5)
    row.update(changes)
    return row


def bronze(spark, *trips):
    names = contracts.BRONZE_TAXI.names
    data = [tuple(t.get(n) for n in names) for t in trips]
    return spark.createDataFrame(data, contracts.BRONZE_TAXI)


@pytest.fixture
def zones(spark):
    return spark.createDataFrame([(7, "Queens", "Astoria", "Boro Zone")], contracts.ZONE_LOOKUP)


def test_taxi_row_and_schema(spark, zones):
    df = silver.taxi(bronze(spark, trip()), zones)
    assert df.schema.names == contracts.SILVER_TAXI.names
    assert [f.dataType for f in df.schema] == [f.dataType for f in contracts.SILVER_TAXI]
    row = df.first()
    assert (row.pickup_year, row.pickup_hour, row.pickup_day, row.pickup_month) == (2023, 13, 7, 5)
    assert (row.pickup_borough, row.pickup_zone, row.total_amount) == ("Queens", "Astoria", Decimal("12.50"))


def test_taxi_imputation(spark, zones):
    df = silver.taxi(bronze(spark, trip(passenger_count=None, congestion_surcharge=None, total_amount=1.0),
                            trip(passenger_count=0.0, congestion_surcharge=-2.5, total_amount=2.0)), zones)
    assert {(r.passenger_count, r.congestion_surcharge) for r in df.collect()} == {(1, Decimal("0.00"))}


@pytest.mark.parametrize("change", [
    {"fare_amount": 0.0}, {"fare_amount": -1.0}, {"fare_amount": None}, {"trip_distance": 0.0}, {"total_amount": -3.0},
    {"tpep_pickup_datetime": dt.datetime(2020, 12, 31, 23, 59)}, {"tpep_dropoff_datetime": dt.datetime(2025, 1, 1)},
    {"tpep_pickup_datetime": None},
])
def test_taxi_drops(spark, zones, change):
    assert silver.taxi(bronze(spark, trip(**change)), zones).count() == 0


def test_taxi_copies_merge_even_with_another_drop_off(spark, zones):
    df = silver.taxi(bronze(spark, trip(), trip(), trip(dolocationid=1), trip(pulocationid=99)), zones)
    assert sorted((r.pickup_zone or "?") for r in df.collect()) == ["?", "Astoria"]


def test_taxi_keeps_trips_that_differ_in_a_dropped_fare(spark, zones):
    df = silver.taxi(bronze(spark, trip(), trip(fare_amount=11.0)), zones)
    assert df.count() == 2 and "fare_amount" not in df.columns


def air_row(value=1.0, date="2022-02-03", locality="Bronx", zone="America/New_York"):
    return (1, "Station", locality, zone, 40.0, -74.0, 11, 2, "pm25", "µg/m³", "PM2.5", date, value)


def test_air(spark):
    nan = float("nan")
    first = spark.createDataFrame([air_row(), air_row(), air_row(-1.0), air_row(None), air_row(nan), air_row(2.0, locality=None),
                                   air_row(3.0, date="2019-01-01"), air_row(zone="AmericaNew_York")], contracts.BRONZE_AIR)
    second = spark.createDataFrame([air_row()], contracts.BRONZE_AIR)
    df = silver.air([first, second])
    assert df.schema.names == contracts.SILVER_AIR.names
    assert [f.dataType for f in df.schema] == [f.dataType for f in contracts.SILVER_AIR]
    got = sorted((r.value, r.locality, r.timezone) for r in df.collect())
    assert got == [(1.0, "Bronx", "AmericaNew_York"), (1.0, "Bronx", "AmericaNew_York"), (2.0, "Unknown", "AmericaNew_York")]
    assert silver.air([first, second], across_tables=True).count() == 2


def test_fx(spark, rows):
    data = [("2020-01-03", "USD", "EUR", 1.1), ("2020-01-06", "USD", "EUR", 1.2), ("2020-01-04", "GBP", "EUR", None),
            ("2020-01-05", "GBP", "EUR", 0.85), ("1998-01-01", "USD", "EUR", 9.0)]
    rates = spark.createDataFrame(data, "TIME_PERIOD string, CURRENCY string, CURRENCY_DENOM string, OBS_VALUE double")
    df = silver.fx(rates, "2020-01-01", "2020-01-07")
    assert [f.dataType for f in df.schema] == [f.dataType for f in contracts.SILVER_FX]
    assert [(r[0].day, r[1], str(r[3])) for r in rows(df)] == [
        (3, "USD", "1.1000"), (4, "USD", "1.1000"), (5, "GBP", "0.8500"), (5, "USD", "1.1000"), (6, "GBP", "0.8500"),
        (6, "USD", "1.2000"), (7, "GBP", "0.8500"), (7, "USD", "1.2000")]


def test_gdp(spark, rows):
    data = [("2024", "USA", "100"), ("2024", "USA", "100"), ("2025", "USA", "1"), (None, "USA", "1"), ("1960", "USA", None)]
    df = silver.gdp(spark.createDataFrame(data, "date string, countryiso3code string, value string"))
    assert [f.dataType for f in df.schema] == [f.dataType for f in contracts.SILVER_GDP]
    assert rows(df) == [(1960, "USA", None), (2024, "USA", 100)]


def test_gdp_envelope(spark, rows, tmp_path):
    (tmp_path / "gdp.json").write_text(
        '[{"page": 1}, [{"indicator": {"id": "I", "value": "GDP"}, "country": {"id": "US", "value": "United States"}, '
        '"countryiso3code": "USA", "date": "2024", "value": 29184890000000, "unit": "", "obs_status": "", "decimal": 0}, '
        '{"indicator": {"id": "I"}, "countryiso3code": "USA", "date": "2025", "value": null}]]')
    from lakeweave.sources.nested import read_json_envelope
    df = silver.gdp_bronze(read_json_envelope(spark, str(tmp_path), contracts.GDP_RECORD))
    assert df.schema.names == contracts.BRONZE_GDP.names
    assert rows(df) == [("I", "GDP", "US", "United States", "USA", 2024, 29184890000000, 0.0),
                        ("I", None, None, None, "USA", 2025, None, None)]


def test_weather(spark):
    nan = float("nan")
    at = dt.datetime(2024, 3, 1, 5)
    data = [(at, "Bronx", 3.456, 50.0, 0.0, 5.0, 0.0, 0.0, nan), (at, "Bronx", 1.0, 50.0, 0.0, 5.0, 0.0, 0.0, 10.0),
            (dt.datetime(2026, 5, 10), "Bronx", 1.0, nan, 0.0, 5.0, 0.0, 0.0, 359.9),
            (dt.datetime(2026, 5, 10, 1), "Bronx", 1.0, 1.0, 0.0, 5.0, 0.0, 0.0, 1.0)]
    df = silver.weather(spark.createDataFrame(data, contracts.BRONZE_WEATHER))
    assert df.schema.names == contracts.SILVER_WEATHER.names
    assert [f.dataType for f in df.schema] == [f.dataType for f in contracts.SILVER_WEATHER]
    first, last = df.orderBy("weather_timestamp").collect()
    assert (first.temperature_c, first.wind_direction_deg, first.DateKey, first.hour_of_day) == (1.0, 10, 20240301, 5)
    assert (last["humidity_%"], last.wind_direction_deg) == (None, 359)


def test_location_and_reading_pages(spark, rows, tmp_path):
    (tmp_path / "loc.json").write_text(
        '{"results": [{"id": 1, "name": "A", "locality": null, "timezone": "America/New_York", "coordinates": null, "sensors": ['
        '{"id": 5, "parameter": {"id": 2, "name": "pm25", "units": "u"}}, {"id": 6, "parameter": {"id": 99, "name": "x", "units": "u"}}]},'
        '{"id": 2, "name": "B", "coordinates": {"latitude": 1.5, "longitude": 2.5}, "sensors": []}]}')
    locations = nested.flatten_locations(nested.read_pages(spark, str(tmp_path), contracts.LOCATION_PAGE))
    assert rows(locations, "location_id", "sensor_id", "latitude", "parameter_name") == [(1, 5, None, "pm25")]
    pages = spark.createDataFrame(
        [(5, [(1.0, (("2022-01-02T00:00:00Z",),)), (2.0, (("",),)), (3.0, None)]), (6, [(9.0, None)])],
        "sensor_id bigint, results array<struct<value double, period struct<datetimeFrom struct<utc string>>>>")
    got = silver.air_bronze(locations, nested.flatten_readings(pages))
    assert got.schema.names == contracts.BRONZE_AIR.names
    assert rows(got, "date", "value", "location_name") == [("2022-01-02", 1.0, "A"), (None, 2.0, "A"), (None, 3.0, "A")]


def test_gold_types_and_trip_total(spark, zones):
    trips = silver.taxi(bronze(spark, trip(), trip(total_amount=7.5, tpep_dropoff_datetime=T0 + dt.timedelta(minutes=13)),
                               trip(pulocationid=1)), zones)
    fact = gold.fact_taxi_daily(trips)
    assert [(f.name, f.dataType) for f in fact.schema] == [(f.name, f.dataType) for f in contracts.FACT_TAXI_DAILY]
    assert fact.agg(F.sum("TotalTrips")).first()[0] == trips.count()
    row = fact.filter("pickup_zone = 'Astoria'").first()
    assert (row.TotalTrips, row.TotalRevenue, row.AvgFare, row.AvgTripDuration) == (
        2, Decimal("20.00"), Decimal("10.00"), Decimal("12.50"))


def test_contract_rejects_nulls_and_overflow(spark):
    with pytest.raises(Exception, match="SourceType must not be null"):
        gold.to_contract(spark.createDataFrame([("a", None)], "StandardZone string, SourceType string"),
                         contracts.DIM_ZONE).collect()
    with pytest.raises(Exception):
        gold.to_contract(spark.createDataFrame([(1, 10.0 ** 20)], "YearKey int, GDP_Value double"), contracts.DIM_GDP).collect()


def test_dim_date_and_zone(spark, rows):
    days = spark.sql("SELECT explode(array(date'2024-03-02', date'2024-03-04')) AS date")
    assert rows(gold.dim_date(days))[0][1:] == (2024, 3, "March", 1, "Saturday", 1)
    taxi = spark.createDataFrame([("A",), ("B",), (None,)], "pickup_zone string")
    air = spark.createDataFrame([("B",), ("C",), ("C",)], "locality string")
    assert rows(gold.dim_zone(taxi, air)) == [("A", "Taxi"), ("B", "Taxi"), ("C", "Weather")]


def test_dim_fx_inverted(spark):
    fx = spark.createDataFrame([(dt.date(2024, 1, 1), "USD", "EUR", Decimal("1.2500")), (dt.date(2024, 1, 1), "GBP", "EUR", Decimal("2"))],
                               contracts.SILVER_FX)
    assert gold.dim_fx(fx).first().ExchangeRate == Decimal("1.2500")
    assert gold.dim_fx(fx, invert_rate=True).first().ExchangeRate == Decimal("0.8000")


def test_drifting_files(spark, tmp_path):
    from lakeweave.sources import files
    a = spark.createDataFrame([(1, T0, 2)], "VendorID bigint, tpep_pickup_datetime timestamp, passenger_count bigint")
    b = spark.createDataFrame([(2, 1.5, 0.5)], "vendorid int, passenger_count double, Airport_fee double")
    for number, df in enumerate((a, b, a), start=1):
        df.coalesce(1).write.parquet(f"{tmp_path}/part{number}.parquet")
    paths = [p for p in files.list_files(spark, str(tmp_path) + "/*")]
    df = files.read_drifting(spark, [f"{tmp_path}/part{n}.parquet" for n in (1, 2, 3)], contracts.BRONZE_TAXI)
    assert len(paths) == 3 and df.count() == 3
    assert df.schema.names == contracts.BRONZE_TAXI.names
    assert sorted(r.passenger_count for r in df.collect()) == [1.5, 2.0, 2.0]
    assert files.read_drifting(spark, [], contracts.BRONZE_TAXI).count() == 0


def test_unquoted_csv_keeps_quotes(spark, rows, tmp_path):
    from lakeweave.sources import files
    (tmp_path / "x.csv").write_text('a,b\n1,"q"\noops,z\n')
    df = files.read_typed_csv(spark, str(tmp_path / "x.csv"), contracts.schema("a int\nb string"))
    assert rows(df) == [(1, '"q"'), (None, "z")]
    assert shape.rename(df, {"a": "c"}).columns == ["c", "b"]
