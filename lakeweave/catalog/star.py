"""Silver jobs, the star schema and the measures on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeweave.catalog import staging
from lakeweave.catalog.registry import query
from lakeweave.catalog.staging import clock, mean2
from lakeweave.operators import joins, series
from lakeweave.plans import gold, model, silver


def silver_trips(t):
    return silver.taxi(staging.trips(t), staging.zone_lookup(t), time_type="timestamp_ntz")


def silver_readings(t):
    return silver.air(staging.air_tables(t), staging.AIR_YEARS)


@query(f"""
WITH {staging.TRIPS}
SELECT {clock('pickup')} AS pickup_datetime, {clock('dropoff')} AS dropoff_datetime, passengers AS passenger_count,
       trip_distance, CAST(total AS DOUBLE) AS total_amount, CAST(surcharge AS DOUBLE) AS congestion_surcharge,
       year(pickup) AS pickup_year, hour(pickup) AS pickup_hour, dayofweek(pickup) + 1 AS pickup_day,
       month(pickup) AS pickup_month, borough AS pickup_borough, zone AS pickup_zone
FROM silver_taxi
""")
def silver_taxi(t):
    return silver_trips(t)


@query(f"""
WITH {staging.AIR}
SELECT CAST(day AS VARCHAR) AS date, location_name, locality, timezone, parameter_name, value, parameter_units,
       40.5::DOUBLE AS latitude, (-74.25)::DOUBLE AS longitude, year(day) AS year, month(day) AS month,
       dayofweek(day) + 1 AS dayofweek
FROM silver_air
""")
def silver_air(t):
    return silver_readings(t)


@query(f"WITH {staging.GDP} SELECT year, country_code, gdp_usd FROM gdp")
def silver_gdp(t):
    return silver.gdp(staging.gdp_records(t), excluded_year=2001)


@query(f"""
WITH {staging.WEATHER}
SELECT CAST(strftime(time, '%Y%m%d') AS BIGINT) AS "DateKey", {clock('time')} AS weather_timestamp, zone AS zone_name,
       hour(time) AS hour_of_day, year(time) AS year, month(time) AS month, dayofweek(time) + 1 AS day_of_week,
       temp AS temperature_c, humidity AS humidity_pct, precip AS precipitation_mm, rain AS rain_mm,
       snow AS snowfall_cm, wind AS wind_speed_kmh, CAST(direction AS DOUBLE) AS wind_direction_deg
FROM silver_weather
""")
def silver_weather(t):
    return silver.weather(staging.weather_readings(t), staging.WEATHER_FIRST, staging.WEATHER_LAST,
                          time_type="timestamp_ntz").withColumnRenamed("humidity_%", "humidity_pct").withColumn(
        "wind_direction_deg", F.col("wind_direction_deg").cast("double"))


FACT_TAXI = f"""
fact_taxi AS (
  SELECT CAST(pickup AS DATE) AS day, hour(pickup) AS hr, zone, count(*) AS trips, sum(total) AS revenue,
         {mean2('sum(CAST(total * 100 AS BIGINT))', 'count(*)', 2)} AS fare,
         {mean2('sum(CAST(CAST(trip_distance AS DECIMAL(18,6)) * 100 AS BIGINT))', 'count(*)', 2)} AS distance,
         {mean2('sum(minutes)', 'count(*)', 0)} AS duration
  FROM silver_taxi GROUP BY 1, 2, 3)
"""


@query(f"""
WITH {staging.TRIPS}, {FACT_TAXI}
SELECT CAST(day AS VARCHAR) AS "DateKey", hr AS "HourOfDay", zone AS pickup_zone, trips AS "TotalTrips",
       CAST(revenue AS DOUBLE) AS "TotalRevenue", fare AS "AvgFare", distance AS "AvgTripDistance",
       duration AS "AvgTripDuration" FROM fact_taxi
""")
def fact_hourly(t):
    return gold.fact_taxi_daily(silver_trips(t))


FACT_AIR = f"""
fact_air AS (
  SELECT day, timezone, locality, location_name, parameter_name AS pollutant,
         {mean2('sum(CAST(CAST(value AS DECIMAL(18,6)) * 1000 AS BIGINT))', 'count(*)', 3)} AS avg_value,
         count(*) AS readings
  FROM silver_air GROUP BY 1, 2, 3, 4, 5)
"""


@query(f"""
WITH {staging.AIR}, {FACT_AIR}
SELECT CAST(day AS VARCHAR) AS "DateKey", timezone, locality, location_name, pollutant AS "Pollutant",
       avg_value AS "AvgValue", readings AS "ReadingCount" FROM fact_air
""")
def fact_daily(t):
    return gold.fact_air_daily(silver_readings(t))


@query(f"""
WITH {staging.TRIPS}, {staging.AIR}
SELECT zone AS "StandardZone", CASE min(r) WHEN 0 THEN 'Taxi' ELSE 'Weather' END AS "SourceType" FROM (
  SELECT zone, 0 AS r FROM silver_taxi UNION ALL SELECT locality, 1 FROM silver_air) WHERE zone IS NOT NULL GROUP BY zone
""")
def dim_zone(t):
    return gold.dim_zone(silver_trips(t), silver_readings(t))


def usd_series(t):
    return silver.fx(staging.usd_rates(t), staging.USD_FIRST, staging.USD_LAST)


@query(f"""
WITH {staging.DIM_FX} SELECT CAST(day AS VARCHAR) AS "DateKey", CAST(rate AS DOUBLE) AS "ExchangeRate" FROM dim_fx
""")
def dim_fx(t):
    return gold.dim_fx(usd_series(t))


@query(f"""
WITH {staging.GDP} SELECT year AS "YearKey", CAST(gdp_usd AS DOUBLE) AS "GDP_Value" FROM gdp WHERE country_code = 'N3'
""")
def dim_gdp(t):
    return gold.dim_gdp(silver.gdp(staging.gdp_records(t), excluded_year=2001), "N3")


def taxi_model(t):
    """Trips with their dates, rates and zones; the calendar covers the trips."""
    trips = silver_trips(t)
    dates = gold.dim_date(series.calendar_of(t("events"), "ts"))
    gdp = t("events").groupBy(F.year("ts").alias("year")).agg(F.sum(F.floor("value")).alias("gdp_usd"))
    zones = (t("customer").select(F.col("c_mktsegment").alias("StandardZone")).distinct()
             .withColumn("SourceType", F.lit("Taxi")))
    return model.star_model({
        "FactTaxiDaily": gold.fact_taxi_daily(trips), "DimDate": dates, "DimFX": gold.dim_fx(usd_series(t)),
        "DimGDP": gold.dim_gdp(gdp.withColumn("country_code", F.lit("USA"))), "DimZone": zones})


def air_model(t):
    dates = gold.dim_date(series.calendar_of(t("orders"), "o_orderdate"))
    return model.star_model({"FactAirQualityDaily": gold.fact_air_daily(silver_readings(t)), "DimDate": dates})


@query(f"""
WITH {staging.TRIPS}, {FACT_TAXI}, {staging.DIM_FX}
SELECT f.zone AS pickup_zone, CAST(sum(CAST(revenue AS DECIMAL(18,2)) * CAST(rate AS DECIMAL(18,4))) AS DOUBLE) AS revenue_eur
FROM fact_taxi f LEFT JOIN dim_fx USING (day) GROUP BY 1 HAVING sum(revenue * rate) IS NOT NULL
""")
def measure_sumx(t):
    return taxi_model(t).evaluate("Total Revenue EUR", by=["FactTaxiDaily.pickup_zone"]).toDF("pickup_zone", "revenue_eur")


@query(f"""
WITH {staging.TRIPS}, {FACT_TAXI}, {staging.DIM_FX}
SELECT CASE WHEN d.day IS NULL THEN NULL ELSE strftime(f.day, '%A') END AS "DayName",
       CAST(sum(CAST(revenue AS DECIMAL(18,2)) * CAST(rate AS DECIMAL(18,4))) AS DOUBLE) AS revenue_eur
FROM fact_taxi f LEFT JOIN dim_fx USING (day)
LEFT JOIN (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events) d ON d.day = f.day
WHERE f.zone IN ('BUILDING', 'MACHINERY') AND d.day >= DATE '2024-01-10'
GROUP BY 1 HAVING sum(revenue * rate) IS NOT NULL
""")
def measure_filtered(t):
    return taxi_model(t).evaluate("Total Revenue EUR", by=["DimDate.DayName"], filters={
        "DimZone.StandardZone": lambda c: c.isin("BUILDING", "MACHINERY"),
        "DimDate.DateKey": lambda c: c >= F.lit("2024-01-10").cast("date")}).toDF("DayName", "revenue_eur")


@query(f"""
WITH {staging.TRIPS}, {FACT_TAXI}, {staging.DIM_FX}
SELECT f.zone AS pickup_zone, CAST(day AS VARCHAR) AS "DateKey",
       '€ ' || format('{{:,.4f}}', CAST(max(rate) AS DOUBLE)) AS "ExchangeRate",
       format('{{:.2f}} mi', max(distance)) AS "AvgTripDistance", format('{{:.2f}} Mins', max(duration)) AS "AvgTripDuration",
       '$' || format('{{:,.2f}}', max(fare)) AS "AvgFare"
FROM fact_taxi f JOIN dim_fx USING (day) GROUP BY 1, 2
""")
def formatted_columns(t):
    """The largest values per zone and day, shown as the model shows its columns."""
    fact = gold.fact_taxi_daily(silver_trips(t))
    rated = joins.many_to_one(fact, gold.dim_fx(usd_series(t)), "DateKey", "DateKey", {"ExchangeRate": "ExchangeRate"}, "DimFX")
    shown = ("ExchangeRate", "AvgTripDistance", "AvgTripDuration", "AvgFare")
    tops = rated.filter("ExchangeRate IS NOT NULL").groupBy("pickup_zone", "DateKey").agg(*[F.max(c).alias(c) for c in shown])
    return model.formatted(tops)


def level(name, pollutant):
    total = "sum(CAST(avg_value * 100 AS BIGINT))"
    n = "count(*)"
    only = f"FILTER (WHERE pollutant = '{pollutant}')"
    # Mean of decimals at four more places, rounded half up, as decimal averages are.
    return (f"CAST((2 * 10000 * CAST({total} {only} AS HUGEINT) + {n} {only}) // nullif(2 * {n} {only}, 0) AS DOUBLE) / 1000000 "
            f"AS {name}")


LEVELS = {"Avg NO2 Level": "no2", "Avg PM2.5 Level": "pm25", "Avg O3 Level": "o3"}


@query(f"""
WITH {staging.AIR}, {FACT_AIR}
SELECT year(day) AS "YearKey", month(day) AS "MonthNumber", {', '.join(level('avg_' + p, p) for p in LEVELS.values())}
FROM fact_air GROUP BY 1, 2
""")
def measure_filtered_avg(t):
    return air_model(t).evaluate(list(LEVELS), by=["DimDate.YearKey", "DimDate.MonthNumber"]).toDF(
        "YearKey", "MonthNumber", *["avg_" + p for p in LEVELS.values()])


@query(f"""
WITH {staging.AIR}, {FACT_AIR},
per_year AS (SELECT year(day) AS y, {level('lvl', 'no2')} FROM fact_air GROUP BY 1)
SELECT DISTINCT y AS "YearKey", pollutant AS "Pollutant", lvl AS avg_no2
FROM fact_air JOIN per_year ON y = year(day)
""")
def measure_override(t):
    """Grouped by the very column the measure fixes: each group shows the fixed value."""
    return air_model(t).evaluate("Avg NO2 Level", by=["DimDate.YearKey", "FactAirQualityDaily.Pollutant"],
                                 filters={"FactAirQualityDaily.Pollutant": lambda c: c.isNotNull()}).toDF(
        "YearKey", "Pollutant", "avg_no2")


@query(f"""
WITH {staging.TRIPS}, {FACT_TAXI}, g AS (
  SELECT year(ts) AS y, CAST(sum(CAST(floor(value) AS BIGINT)) AS DOUBLE) AS gdp FROM events GROUP BY 1),
d AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events)
SELECT year(d.day) AS "YearKey", gdp AS "GDP_Value", CAST(sum(revenue) AS DOUBLE) AS revenue, CAST(sum(trips) AS BIGINT) AS trips
FROM fact_taxi f LEFT JOIN d ON d.day = f.day LEFT JOIN g ON g.y = year(d.day) GROUP BY 1, 2
""")
def snowflake_join(t):
    wide = taxi_model(t).wide("FactTaxiDaily", [
        "FactTaxiDaily.TotalRevenue", "FactTaxiDaily.TotalTrips", "DimDate.YearKey", "DimGDP.GDP_Value"])
    return wide.groupBy(F.col("`DimDate.YearKey`").alias("YearKey"), F.col("`DimGDP.GDP_Value`").alias("GDP_Value")).agg(
        F.sum("`FactTaxiDaily.TotalRevenue`").alias("revenue"), F.sum("`FactTaxiDaily.TotalTrips`").alias("trips"))


@query(f"""
WITH {staging.TRIPS}, {FACT_TAXI}
SELECT zone AS pickup_zone, CAST(sum(hr) AS BIGINT) AS "HourOfDay", CAST(sum(trips) AS BIGINT) AS "TotalTrips",
       CAST(sum(revenue) AS DOUBLE) AS "TotalRevenue", CAST(sum(CAST(fare AS DECIMAL(10,2))) AS DOUBLE) AS "AvgFare",
       CAST(sum(CAST(distance AS DECIMAL(10,2))) AS DOUBLE) AS "AvgTripDistance",
       CAST(sum(CAST(duration AS DECIMAL(10,2))) AS DOUBLE) AS "AvgTripDuration"
FROM fact_taxi GROUP BY 1
""")
def default_summarise(t):
    return taxi_model(t).summarise("FactTaxiDaily", ["FactTaxiDaily.pickup_zone"])


@query("""
WITH o AS (SELECT CAST(o_orderdate AS DATE) + 9131 AS day, count(*) AS orders, sum(CAST(o_totalprice AS DECIMAL(12,2))) AS amount FROM orders GROUP BY 1),
e AS (SELECT CAST(ts AS DATE) AS day, count(*) AS events, sum(CAST(value AS DECIMAL(12,2))) AS value FROM events GROUP BY 1)
SELECT CAST(coalesce(o.day, e.day) AS VARCHAR) AS day, CAST(orders AS DOUBLE) AS orders, CAST(amount AS DOUBLE) AS amount, CAST(events AS DOUBLE) AS events, CAST(value AS DOUBLE) AS value
FROM o FULL JOIN e ON o.day = e.day
""")
def drill_across(t):
    """Two facts on one day axis; each is aggregated before they meet."""
    orders = t("orders").groupBy(F.date_add(F.to_date("o_orderdate"), 9131).alias("day")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum(F.col("o_totalprice").cast("decimal(12,2)")).alias("amount"))
    events = t("events").groupBy(F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("events"), F.sum(F.col("value").cast("decimal(12,2)")).alias("value"))
    counts = {c: F.col(c).cast("double") for c in ("orders", "events")}
    return joins.drill_across([orders, events], ["day"]).withColumns(counts)


@query(f"""
WITH {staging.TRIPS}, {FACT_TAXI}, {staging.DIM_FX}, keyed AS (
  SELECT f.day, f.zone, revenue, rate FROM fact_taxi f LEFT JOIN dim_fx USING (day))
SELECT CAST(day AS VARCHAR) AS "DateKey", zone AS pickup_zone, CAST(revenue AS DOUBLE) AS "TotalRevenue",
       CAST(rate AS DOUBLE) AS rate FROM keyed
""")
def fact_with_rate(t):
    fact = gold.fact_taxi_daily(silver_trips(t)).select("DateKey", "pickup_zone", "TotalRevenue")
    return joins.many_to_one(fact, gold.dim_fx(usd_series(t)), "DateKey", "DateKey", {"ExchangeRate": "rate"}, "DimFX")


def both_facts(t):
    """One model with trips and readings over a calendar of both."""
    taxi, air = taxi_model(t), air_model(t)
    dates = taxi.table("DimDate").unionByName(air.table("DimDate")).distinct()
    return model.star_model({**taxi.tables, **air.tables, "DimDate": dates})


@query(f"""
WITH {staging.TRIPS}, {FACT_TAXI}, {staging.DIM_FX}, {staging.AIR}, {FACT_AIR},
d AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events),
taxi_part AS (SELECT year(d.day) AS y, month(d.day) AS m, CAST(sum(CAST(revenue AS DECIMAL(18,2)) * CAST(rate AS DECIMAL(18,4))) AS DOUBLE) AS r
          FROM fact_taxi f LEFT JOIN dim_fx USING (day) LEFT JOIN d ON d.day = f.day GROUP BY 1, 2),
levels AS (SELECT year(day) AS y, month(day) AS m, {level('l', 'no2')} FROM fact_air GROUP BY 1, 2)
SELECT coalesce(taxi_part.y, levels.y) AS "YearKey", coalesce(taxi_part.m, levels.m) AS "MonthNumber", r AS revenue_eur, l AS avg_no2
FROM taxi_part FULL JOIN levels ON taxi_part.y IS NOT DISTINCT FROM levels.y AND taxi_part.m IS NOT DISTINCT FROM levels.m
WHERE r IS NOT NULL OR l IS NOT NULL
""")
def model_two_facts(t):
    """Measures of both facts by the dimension they share."""
    return both_facts(t).evaluate(["Total Revenue EUR", "Avg NO2 Level"], by=["DimDate.YearKey", "DimDate.MonthNumber"]).toDF(
        "YearKey", "MonthNumber", "revenue_eur", "avg_no2")


@query(f"""
WITH {staging.TRIPS}, {FACT_TAXI}, d AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events)
SELECT strftime(d.day, '%A') AS "DayName", CAST(sum(trips) AS BIGINT) AS trips FROM fact_taxi f JOIN d ON d.day = f.day GROUP BY 1
""")
def model_views(t):
    """The tables of the model by name in SQL."""
    taxi_model(t).create_views("lw_model_")
    return t.spark.sql("""
        SELECT d.DayName, sum(f.TotalTrips) AS trips FROM lw_model_FactTaxiDaily f
        JOIN lw_model_DimDate d ON f.DateKey = d.DateKey GROUP BY d.DayName""")
