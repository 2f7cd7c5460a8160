"""The given tables shaped like the bronze tables of the jobs, and the same in SQL.

Nulls, NaNs, out-of-range values, repeated deliveries and unknown keys are made
from column values, so every query works on all rows of its table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeweave.catalog.registry import Tables


def clock(column: str) -> str:
    """SQL for a timestamp in the text form of the results."""
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"


def mean2(total: str, n: str, scale: int) -> str:
    """SQL for a mean rounded half up to two places, from the integer total of
    non-negative values scaled by ``10**scale``. Integers keep it exact."""
    unit = 10 ** scale
    return (f"CAST((2 * 100 * CAST({total} AS HUGEINT) + {n} * {unit}) // (2 * {n} * {unit}) AS DOUBLE) / 100")


def deliver(df: DataFrame, twice: Column) -> DataFrame:
    """Every row with its ``copy`` number, those marked ``twice`` a second time."""
    copies = F.when(twice, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return df.withColumn("copy", F.explode(copies))


def trips(t: Tables) -> DataFrame:
    """Trips from events; those of view events are delivered twice, one in five
    users travelled five years earlier."""
    e = t("events")
    pickup = F.when(F.col("user_id") % 5 == 0, F.col("ts") - F.expr("interval 1826 days")).otherwise(F.col("ts"))
    minutes = F.make_dt_interval(F.lit(0), F.lit(0), F.floor("value").cast("int"), F.lit(0))
    once = e.select(
        F.lit(1).alias("vendorid"),
        pickup.alias("tpep_pickup_datetime"),
        (pickup + minutes).alias("tpep_dropoff_datetime"),
        F.nullif(F.col("user_id") % 7, F.lit(6)).cast("double").alias("passenger_count"),
        (F.col("value") - 1).alias("trip_distance"),
        F.col("user_id").cast("int").alias("pulocationid"),
        F.col("event_id").cast("int").alias("dolocationid"),
        F.col("value").alias("fare_amount"),
        (F.col("value") - 5).alias("total_amount"),
        (F.nullif(F.col("event_id") % 5, F.lit(3)) - 1).cast("double").alias("congestion_surcharge"),
        "event_type",
    )
    delivered = deliver(once, F.col("event_type") == "view")
    return delivered.withColumn("dolocationid", F.col("dolocationid") + F.col("copy")).drop("event_type", "copy")


TRIPS = """
once AS (
  SELECT event_type,
         CASE WHEN user_id % 5 = 0 THEN ts - INTERVAL 1826 DAY ELSE ts END AS pickup,
         CAST(floor(value) AS BIGINT) AS minutes,
         nullif(user_id % 7, 6) AS passengers,
         value - 1 AS trip_distance, user_id AS location, value AS fare,
         value - 5 AS total, nullif(event_id % 5, 3) - 1 AS surcharge
  FROM events),
trips AS (SELECT * FROM once UNION ALL SELECT * FROM once WHERE event_type = 'view'),
clean AS (
  SELECT DISTINCT pickup, pickup + to_minutes(minutes) AS dropoff, minutes,
         CASE WHEN coalesce(passengers, 1) = 0 THEN 1 ELSE coalesce(passengers, 1) END AS passengers,
         trip_distance, location, CAST(fare AS DECIMAL(10,2)) AS fare,
         CAST(total AS DECIMAL(10,2)) AS total,
         greatest(coalesce(surcharge, 0), 0) AS surcharge
  FROM trips
  WHERE CAST(fare AS DECIMAL(10,2)) > 0 AND CAST(total AS DECIMAL(10,2)) > 0 AND trip_distance > 0
    AND year(pickup) IN (2021, 2022, 2023, 2024)
    AND year(pickup + to_minutes(minutes)) IN (2021, 2022, 2023, 2024)),
zone_lookup AS (
  SELECT c_custkey AS location, n_name AS borough, c_mktsegment AS zone
  FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 0),
silver_taxi AS (
  SELECT c.*, borough, zone FROM clean c LEFT JOIN zone_lookup USING (location))
"""


def zone_lookup(t: Tables) -> DataFrame:
    """Customers as zones; those with a debt are unknown to the lookup."""
    nations = t("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return t("customer").filter(F.col("c_acctbal") > 0).join(nations, "c_nationkey").select(
        F.col("c_custkey").cast("int").alias("LocationID"), F.col("n_name").alias("Borough"),
        F.col("c_mktsegment").alias("Zone"), F.lit("Yellow Zone").alias("service_zone"))


# Half-open bounds of the yearly tables; two of them overlap.
AIR_TABLES = (("1995-07-01", "1996-07-01"), ("1996-07-01", "1998-01-01"), ("1997-07-01", "1999-01-01"))
AIR_YEARS = (1996, 1997, 1998)


def air_tables(t: Tables) -> list[DataFrame]:
    """Readings from orders, one table per period; open orders are delivered twice."""
    status = F.col("o_orderstatus")
    readings = t("orders").select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        F.concat(F.lit("station "), "o_orderpriority").alias("location_name"),
        F.nullif(F.substring("o_orderpriority", 3, 50), F.lit("LOW")).alias("locality"),
        F.lit("America/New_York").alias("timezone"),
        F.when(status == "F", "no2").when(status == "O", "pm25").otherwise("o3").alias("parameter_name"),
        (F.floor("o_totalprice") / 1000 - 50).alias("value"),
        F.when(status == "O", "µg/m³").otherwise("ppm").alias("parameter_units"),
        F.lit(40.5).alias("latitude"), F.lit(-74.25).alias("longitude"),
        "o_orderdate", "o_orderstatus",
    )
    periods = [readings.filter((F.col("o_orderdate") >= F.lit(low)) & (F.col("o_orderdate") < F.lit(high)))
               for low, high in AIR_TABLES]
    return [deliver(p, F.col("o_orderstatus") == "O").drop("o_orderdate", "o_orderstatus", "copy") for p in periods]


def _air_sql() -> str:
    parts = [f"""
  SELECT DISTINCT * FROM readings
  WHERE day >= DATE '{low}' AND day < DATE '{high}' AND value >= 0 AND year(day) IN (1996, 1997, 1998)"""
             for low, high in AIR_TABLES]
    return """
readings AS (
  SELECT CAST(o_orderdate AS DATE) AS day, 'station ' || o_orderpriority AS location_name,
         nullif(substr(o_orderpriority, 3), 'LOW') AS locality, 'AmericaNew_York' AS timezone,
         CASE o_orderstatus WHEN 'F' THEN 'no2' WHEN 'O' THEN 'pm25' ELSE 'o3' END AS parameter_name,
         floor(o_totalprice) / 1000 - 50 AS value,
         CASE o_orderstatus WHEN 'O' THEN 'µg/m³' ELSE 'ppm' END AS parameter_units
  FROM orders),
unioned AS (""" + " UNION ALL ".join(parts) + """),
silver_air AS (
  SELECT day, location_name, coalesce(locality, 'Unknown') AS locality, timezone, parameter_name,
         value, parameter_units FROM unioned)
"""


AIR = _air_sql()

FX_FIRST, FX_LAST = "1995-06-01", "2001-06-30"


def fx_rates(t: Tables) -> DataFrame:
    """Many rates per pair and day, one customer in seven without a value."""
    return t("orders").select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("TIME_PERIOD"),
        F.col("o_orderpriority").alias("CURRENCY"), F.col("o_orderstatus").alias("CURRENCY_DENOM"),
        F.when(F.col("o_custkey") % 7 != 0, F.floor("o_totalprice") / 10000).alias("OBS_VALUE"))


def usd_rates(t: Tables) -> DataFrame:
    """One rate per day of the events, none at weekends."""
    day = F.to_date("ts")
    return (t("events").groupBy(day.alias("TIME_PERIOD"))
            .agg((F.max("value") / 100).alias("top"))
            .select("TIME_PERIOD", F.lit("USD").alias("CURRENCY"), F.lit("EUR").alias("CURRENCY_DENOM"),
                    F.when(~F.dayofweek("TIME_PERIOD").isin(1, 7), F.col("top")).alias("OBS_VALUE")))


USD_FIRST, USD_LAST = "2024-01-01", "2024-01-31"

DIM_FX = """
days AS (SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY)) AS DATE) AS day),
rates AS (
  SELECT CAST(ts AS DATE) AS day,
         CASE WHEN dayofweek(CAST(ts AS DATE)) NOT IN (0, 6) THEN CAST(max(value) / 100 AS DECIMAL(10,4)) END AS rate
  FROM events GROUP BY 1),
carried AS (
  SELECT days.day, last_value(rate IGNORE NULLS) OVER (
           ORDER BY days.day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS rate
  FROM days LEFT JOIN rates USING (day)),
dim_fx AS (SELECT day, rate FROM carried WHERE rate IS NOT NULL)
"""


def gdp_records(t: Tables) -> DataFrame:
    """Order value per year and nation, delivered twice for the first nations."""
    owners = t("customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    grouped = (t("orders").join(owners, "o_custkey")
               .groupBy(F.year("o_orderdate").cast("string").alias("date"), "c_nationkey")
               .agg(F.sum(F.floor("o_totalprice")).alias("value")))
    records = grouped.select("date", F.concat(F.lit("N"), "c_nationkey").alias("countryiso3code"),
                             F.col("value").cast("string").alias("value"), "c_nationkey")
    return deliver(records, F.col("c_nationkey") < 10).drop("c_nationkey", "copy")


GDP = """
gdp AS (
  SELECT year(o_orderdate) AS year, 'N' || c_nationkey AS country_code,
         CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) AS BIGINT) AS gdp_usd
  FROM orders JOIN customer ON o_custkey = c_custkey
  WHERE year(o_orderdate) <> 2001 GROUP BY 1, 2)
"""

WEATHER_FIRST, WEATHER_LAST = "2024-01-03", "2024-01-29"


def weather_readings(t: Tables) -> DataFrame:
    """Hourly readings from events, many per hour and zone."""
    user, value = F.col("user_id"), F.col("value")
    return t("events").select(
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("date"),
        F.col("event_type").alias("ZoneName"),
        (value - 20).alias("temperature_2m"),
        (user % 120).cast("double").alias("relative_humidity_2m"),
        (value - 1).alias("precipitation"),
        (value - 2).alias("rain"),
        F.when(user % 11 != 0, value).alias("snowfall"),
        value.alias("wind_speed_10m"),
        F.when(user % 10 == 0, F.lit(float("nan"))).otherwise(user * 3.0).alias("wind_direction_10m"),
    )


WEATHER = """
typed AS (
  SELECT date_trunc('hour', ts) AS time, event_type AS zone, round(value - 20, 2) AS temp,
         CAST(user_id % 120 AS DOUBLE) AS humidity, round(value - 1, 2) AS precip, round(value - 2, 2) AS rain,
         CASE WHEN user_id % 11 <> 0 THEN round(value, 2) END AS snow, round(value, 2) AS wind,
         CASE WHEN user_id % 10 <> 0 THEN user_id * 3 END AS direction
  FROM events
  WHERE date_trunc('hour', ts) >= TIMESTAMP '2024-01-03' AND date_trunc('hour', ts) <= TIMESTAMP '2024-01-29'),
silver_weather AS (
  SELECT * FROM typed
  QUALIFY row_number() OVER (PARTITION BY time, zone ORDER BY temp NULLS FIRST, humidity NULLS FIRST,
    precip NULLS FIRST, rain NULLS FIRST, snow NULLS FIRST, wind NULLS FIRST, direction NULLS FIRST) = 1)
"""
