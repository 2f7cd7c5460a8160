"""From landed files to measures, with the jobs a user runs."""

import datetime as dt
import json
from decimal import Decimal

import pytest

from lakeweave import contracts
from lakeweave.plans import jobs

NAMES = jobs.Names(*[f"e2e_{n}" for n in ("taxi", "air", "fx", "gdp", "weather", "metrics")], gold_prefix="e2e_gold_")
T0 = dt.datetime(2023, 9, 2, 10)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    months = root / "trips"
    old = spark.createDataFrame(
        [(T0, T0 + dt.timedelta(minutes=10), 0, 2.0, 1, 5.0, 10.0, None), (T0, T0 + dt.timedelta(minutes=10), 0, 2.0, 1, 5.0, 10.0, None)],
        "tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, passenger_count bigint, trip_distance double, "
        "PULocationID bigint, fare_amount double, total_amount double, congestion_surcharge double")
    new = spark.createDataFrame(
        [(T0 + dt.timedelta(days=2), T0 + dt.timedelta(days=2, minutes=20), 3.0, 4.0, 2, 5.0, 20.0, 2.5, 1.25)],
        "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, passenger_count double, trip_distance double, "
        "PULocationID int, fare_amount double, total_amount double, congestion_surcharge double, Airport_fee double")
    old.coalesce(1).write.mode("append").parquet(str(months))
    new.coalesce(1).write.mode("append").parquet(str(months))
    (root / "zones.csv").write_text('"LocationID","Borough","Zone","service_zone"\n1,"Queens","Astoria","Boro"\n2,"Bronx","Norwood","Boro"\n')
    assert jobs.merge_taxi_files(spark, str(months), str(root / "merged")) == 3
    assert jobs.taxi(spark, str(root / "merged"), str(root / "zones.csv"), NAMES) == 2

    (root / "loc").mkdir()
    (root / "loc" / "p1.json").write_text(json.dumps({"results": [{
        "id": 1, "name": "S1", "locality": "Astoria", "timezone": "America/New_York", "coordinates": {"latitude": 1.0, "longitude": 2.0},
        "sensors": [{"id": 5, "parameter": {"id": 10, "name": "no2", "units": "ppm"}},
                    {"id": 6, "parameter": {"id": 7, "name": "o3", "units": "ppm"}}]}]}))
    days = spark.createDataFrame(
        [(5, [(0.5, (("2023-09-02T00:00:00Z",),)), (-1.0, (("2023-09-03T00:00:00Z",),))]), (6, [(0.25, (("2023-09-02T00:00:00Z",),))])],
        "sensor_id bigint, results array<struct<value double, period struct<datetimeFrom struct<utc string>>>>")
    assert jobs.air_pages(spark, str(root / "loc"), days, "e2e_bronze_air_23") == 3
    assert jobs.air(spark, "e2e_bronze_air_", ["23"], NAMES) == 2

    header = ",".join(contracts.FX_FILE.names)
    def line(day, value):
        given = {"CURRENCY": "USD", "CURRENCY_DENOM": "EUR", "TIME_PERIOD": day, "OBS_VALUE": value, "TITLE": '"US dollar"'}
        return ",".join(given.get(n, "") for n in contracts.FX_FILE.names)
    (root / "fx.csv").write_text("\n".join([header, line("2023-09-01", "2.0"), line("2023-09-04", "3.0")]) + "\n")
    assert jobs.fx_file(spark, str(root / "fx.csv"), "e2e_bronze_fx") == 2
    assert jobs.fx(spark, "e2e_bronze_fx", NAMES, "2023-08-30", "2023-09-05") == 5

    (root / "gdp").mkdir()
    (root / "gdp" / "g.json").write_text(json.dumps([{"page": 1}, [
        {"indicator": {"id": "i", "value": "v"}, "country": {"id": "US", "value": "U"}, "countryiso3code": "USA", "date": d, "value": v}
        for d, v in (("2023", 27), ("2025", 30))]]))
    assert jobs.gdp_file(spark, str(root / "gdp"), "e2e_bronze_gdp") == 2
    assert jobs.gdp(spark, "e2e_bronze_gdp", NAMES) == 1

    hours = [(T0 + dt.timedelta(hours=h), z, 1.0, 50.0, 0.0, 5.0, 0.0, 0.0, 90.0) for h in range(30) for z in ("Bronx", "EWR")]
    spark.createDataFrame(hours, contracts.BRONZE_WEATHER).write.saveAsTable("e2e_bronze_weather")
    assert jobs.weather(spark, "e2e_bronze_weather", NAMES) == 60
    jobs.star(spark, NAMES, ("2023-01-01", "2023-12-31"))
    return root


def test_measures(spark, lake, rows):
    model = jobs.load_model(spark, NAMES)
    assert rows(model.evaluate(["Total Revenue EUR", "Avg NO2 Level", "Avg O3 Level"], ["DimZone.StandardZone"])) == [
        ("Astoria", Decimal("20.000000"), Decimal("0.500000"), Decimal("0.250000")),
        ("Norwood", Decimal("60.000000"), None, None)]
    assert model.evaluate("Total Revenue EUR", filters={"DimGDP.GDP_Value": lambda c: c > 20}).first()[0] == Decimal("80")


def test_gold_contracts(spark, lake):
    for table, contract in jobs.GOLD.items():
        stored = spark.table(NAMES.gold(table)).schema
        assert [(f.name, f.dataType) for f in stored] == [(f.name, f.dataType) for f in contract]


def test_reports(spark, lake):
    lines = jobs.quality(spark, NAMES, options={"weather": {"min_rows": 50}, "gdp": {"as_of_year": 2026}}).collect()
    summary = {(r.suite, r["name"]): r.value for r in lines if r.section == "summary"}
    assert summary[("Taxi Data Quality", "Success Rate")] == "100.0%"
    assert summary[("Weather Data Quality", "Failed")] == "0"
    assert len({s for s, _ in summary}) == 5


def test_export(spark, lake, tmp_path):
    jobs.export_hourly(spark, str(tmp_path / "x"), "2023-09-01", "2023-09-30", NAMES)
    data = json.loads(spark.read.text(str(tmp_path / "x")).first()[0])
    assert data == [{"DateKey": "2023-09-02", "HourOfDay": 10, "pickup_zone": "Astoria", "totaltrips": 1, "totalrevenue": 10.0},
                    {"DateKey": "2023-09-04", "HourOfDay": 10, "pickup_zone": "Norwood", "totaltrips": 1, "totalrevenue": 20.0}]


def test_sync(spark, lake):
    assert jobs.sync_weather(spark, NAMES) == 3  # the jump to the first reading, a day, the rest
    assert spark.table(NAMES.metrics).count() == 60
    assert jobs.sync_weather(spark, NAMES) == 0


def test_sizing_grows_with_the_input():
    from lakeweave.session import sizing
    small, large = sizing(10 ** 9, 8), sizing(100 * 10 ** 12, 4000)
    assert small["spark.sql.shuffle.partitions"] == "16"
    assert large["spark.sql.shuffle.partitions"] == "93133"
    assert sizing(100 * 10 ** 12, 4000, partition_bytes=10 ** 9)["spark.sql.shuffle.partitions"] == "25000"
    assert sizing(10 ** 9, 8, split_bytes=512)["spark.sql.files.maxPartitionBytes"] == "512b"


def test_scratch_on_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    import pytest

    from lakeweave.session import scratch_root

    def made(master, **conf):
        named = {k.replace("__", "."): v for k, v in conf.items()}
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, default=None: named.get(k, default)),
                               sparkContext=SimpleNamespace(master=master, applicationId="app"))

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(made("spark://host:7077", spark__sql__warehouse__dir="file:/home/x/warehouse"))
    assert scratch_root(made("spark://host:7077", spark__sql__warehouse__dir="hdfs://n/w")) == "hdfs://n/w/scratch-app"
    assert scratch_root(made("yarn", spark__checkpoint__dir="file:///shared", spark__sql__warehouse__dir="/w")) == "file:///shared/scratch-app"
    assert scratch_root(made("local[8]", spark__sql__warehouse__dir="/w")) == "/w/scratch-app"
