import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakeweave import contracts
from lakeweave.plans import gold, model

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
SUNK = dt.date(2030, 1, 1)


@pytest.fixture(scope="module")
def star(spark):
    def taxi(day, zone, revenue):
        return (day, 1, zone, 2, Decimal(revenue), Decimal(1), Decimal(1), Decimal(1))

    def air(day, zone, pollutant, value):
        return (day, "NY", zone, "S", pollutant, Decimal(value), 3)

    days = spark.createDataFrame([(D1,), (D2,)], "date date")
    return model.star_model({
        "FactTaxiDaily": spark.createDataFrame([taxi(D1, "A", 10), taxi(D2, "A", 20), taxi(D2, "B", 40), taxi(SUNK, "Z", 7)],
                                               contracts.FACT_TAXI_DAILY),
        "FactAirQualityDaily": spark.createDataFrame([air(D1, "A", "no2", "1"), air(D2, "A", "no2", "3"), air(D2, "B", "o3", "8")],
                                                     contracts.FACT_AIR_DAILY),
        "DimDate": gold.dim_date(days),
        "DimFX": spark.createDataFrame([(D1, Decimal("0.5"))], contracts.DIM_FX),
        "DimGDP": spark.createDataFrame([(2024, Decimal(99))], contracts.DIM_GDP),
        "DimZone": spark.createDataFrame([("A", "Taxi"), ("B", "Taxi"), ("C", "Weather")], contracts.DIM_ZONE),
    })


def test_missing_rate_is_skipped(star, rows):
    assert star.evaluate("Total Revenue EUR").first()[0] == Decimal("5.0")
    assert rows(star.evaluate("Total Revenue EUR", ["FactTaxiDaily.pickup_zone"])) == [("A", Decimal("5.0"))]
    blank = star.evaluate("Total Revenue EUR", ["FactTaxiDaily.pickup_zone"], keep_blank=True)
    assert rows(blank) == [("A", Decimal("5.0")), ("B", None), ("Z", None)]


def test_override_ignores_group_and_filter(star, rows):
    by = ["FactAirQualityDaily.Pollutant"]
    assert rows(star.evaluate("Avg NO2 Level", by)) == [("no2", Decimal("2.0")), ("o3", Decimal("2.0"))]
    only_o3 = {"FactAirQualityDaily.Pollutant": lambda c: c == "o3"}
    assert star.evaluate("Avg NO2 Level", filters=only_o3).first()[0] == Decimal("2.0")
    assert rows(star.evaluate("Avg NO2 Level", by, only_o3)) == [("o3", Decimal("2.0"))]


def test_filters_flow_from_one_to_many_only(star):
    second = {"DimDate.DateKey": lambda c: c == F.lit(D2)}
    assert star.evaluate("Avg NO2 Level", filters=second).first()[0] == Decimal("3.0")
    other_fact = {"FactTaxiDaily.pickup_zone": lambda c: c == "B"}
    assert star.evaluate("Avg NO2 Level", filters=other_fact).first()[0] == Decimal("2.0")


def test_two_facts_side_by_side(star, rows):
    got = star.evaluate(["Total Revenue EUR", "Avg NO2 Level", "Avg O3 Level"], ["DimDate.DateKey"])
    assert got.columns == ["DateKey", "Total Revenue EUR", "Avg NO2 Level", "Avg O3 Level"]
    assert rows(got) == [(D1, Decimal("5.0"), Decimal("1.0"), None), (D2, None, Decimal("3.0"), Decimal("8.0"))]


def test_snowflake_path_and_unknown_member(star, rows):
    wide = star.wide("FactTaxiDaily", ["FactTaxiDaily.TotalRevenue", "DimGDP.GDP_Value"])
    assert wide.count() == 4
    assert wide.filter("`DimGDP.GDP_Value` IS NULL").count() == 1
    assert len(star.path("FactTaxiDaily", "DimGDP")) == 2
    with pytest.raises(ValueError):
        star.path("DimDate", "FactTaxiDaily")


def test_default_summarisation(star, rows):
    got = star.summarise("FactTaxiDaily", ["DimDate.YearKey"])
    assert rows(got, "YearKey", "TotalTrips", "TotalRevenue") == [(2024, 6, Decimal("70.00")), (None, 2, Decimal("7.00"))]
    with pytest.raises(ValueError):
        star.summarise("DimZone")


def test_views(star, spark):
    star.create_views("gold_")
    assert spark.table("gold_DimZone").count() == 3


def test_rows_do_not_multiply(star, spark):
    doubled = model.star_model({**star.tables, "DimFX": star.table("DimFX").union(star.table("DimFX"))})
    with pytest.raises(Exception, match="DimFX: key occurs more than once"):
        doubled.evaluate("Total Revenue EUR").collect()


def test_formats(star):
    got = model.formatted(star.evaluate(["Total Revenue EUR", "Avg NO2 Level", "Avg PM2.5 Level"])).first()
    assert tuple(got) == ("€ 5.00", "2.0000 ppm", None)
    assert model.formatted(star.table("DimGDP")).first().GDP_Value == "$99.00"


def test_fact_is_grouped_before_it_meets_a_dimension(star, rows):
    from dataclasses import replace
    whole = replace(star, measures={n: replace(m, split=None) for n, m in star.measures.items()})
    names = ["Total Revenue EUR", "Avg NO2 Level", "Avg O3 Level"]
    for by, filters in ((["DimDate.YearKey"], {}), (["DimDate.DateKey", "DimZone.StandardZone"], {}), ([], {"DimDate.DayName": lambda c: c == "Monday"}),
                        (["DimGDP.GDP_Value"], {"DimZone.StandardZone": lambda c: c != "B", "FactTaxiDaily.HourOfDay": lambda c: c == 2}),
                        (["DimDate.DateKey"], {"DimDate.DateKey": lambda c: c > F.lit(SUNK)})):
        split, plain = [m.evaluate(names, by, filters, keep_blank=True) for m in (star, whole)]
        assert rows(split) == rows(plain) and split.dtypes == plain.dtypes
    optimized = star.evaluate("Total Revenue EUR", ["DimDate.YearKey"])._jdf.queryExecution().optimizedPlan().toString()
    lines = [line.lstrip(" :+-").split(" ")[0] for line in optimized.splitlines()]
    assert "Aggregate" in lines[lines.index("Join"):], optimized


def test_thirds_are_rounded_as_by_avg(spark):
    facts = spark.createDataFrame([(D1 + dt.timedelta(i % 7), "NY", "A", "S", "no2", Decimal(i), 1) for i in range(1, 60)], contracts.FACT_AIR_DAILY)
    dates = gold.dim_date(spark.createDataFrame([(D1 + dt.timedelta(i),) for i in range(7)], "date date"))
    got = model.star_model({"FactAirQualityDaily": facts, "DimDate": dates}).evaluate("Avg NO2 Level", ["DimDate.YearKey"])
    assert got.first()[1] == facts.agg(F.avg("AvgValue")).first()[0]
