"""The silver jobs' own checks on the given tables."""

from __future__ import annotations

from lakeweave.catalog import staging
from lakeweave.catalog.quality import TAXI_NAMES, failing
from lakeweave.catalog.registry import query
from lakeweave.catalog.star import silver_readings, silver_trips
from lakeweave.plans import profiles, silver
from lakeweave.session import stored


@query(f"""
WITH {staging.TRIPS}
SELECT count(*) AS rows, {', '.join(f"{failing(c + ' IS NULL')} AS {n}_nulls" for n, c in TAXI_NAMES)},
       {failing('total <= 0')} AS negative_totals, {failing('trip_distance <= 0')} AS negative_distances,
       {failing('surcharge < 0')} AS negative_surcharges, {failing('passengers = 0')} AS zero_passengers,
       CAST(CAST(min(pickup) AS DATE) AS VARCHAR) AS first_day, CAST(CAST(max(pickup) AS DATE) AS VARCHAR) AS last_day,
       count(DISTINCT CAST(pickup AS DATE)) AS days
FROM silver_taxi
""")
def profile_taxi(t):
    return profiles.taxi(silver_trips(t))


AIR_NAMES = (("date", "day"), ("location_name", "location_name"), ("locality", "locality"), ("timezone", "timezone"),
             ("parameter_name", "parameter_name"), ("value", "value"), ("parameter_units", "parameter_units"),
             ("latitude", "timezone"), ("longitude", "timezone"), ("year", "day"), ("month", "day"), ("dayofweek", "day"))


@query(f"""
WITH {staging.AIR}
SELECT count(*) AS rows, {', '.join(f"{failing(c + ' IS NULL')} AS {n}_nulls" for n, c in AIR_NAMES)},
       {failing('value < 0')} AS negative_readings, CAST(min(day) AS VARCHAR) AS first_day, CAST(max(day) AS VARCHAR) AS last_day,
       count(DISTINCT day) AS days
FROM silver_air
""")
def profile_air(t):
    return profiles.air(silver_readings(t))


@query(f"WITH {staging.AIR} SELECT parameter_name, count(*) AS count FROM silver_air GROUP BY 1")
def air_parameters(t):
    return profiles.air_parameters(silver_readings(t))


@query(f"WITH {staging.AIR} SELECT locality, count(*) AS count FROM silver_air GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def air_localities(t):
    return profiles.air_localities(silver_readings(t))


@query(f"""
WITH cal AS (SELECT CAST(unnest(generate_series(
  DATE '{staging.FX_FIRST}', DATE '{staging.FX_LAST}', INTERVAL 1 DAY)) AS DATE) AS day),
obs AS (SELECT CAST(o_orderdate AS DATE) AS day, o_orderpriority AS base, o_orderstatus AS target,
               CASE WHEN o_custkey % 7 <> 0 THEN CAST(floor(o_totalprice) / 10000 AS DECIMAL(10,4)) END AS v FROM orders),
filled AS (
  SELECT day, base, target, last_value(v IGNORE NULLS) OVER (
    PARTITION BY base, target ORDER BY day, v NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v
  FROM (SELECT * FROM cal, (SELECT DISTINCT base, target FROM obs)) LEFT JOIN obs USING (day, base, target)),
kept AS (SELECT * FROM filled WHERE v IS NOT NULL)
SELECT count(*) AS rows, {failing('day IS NULL')} AS date_nulls, {failing('base IS NULL')} AS base_currency_nulls,
       {failing('target IS NULL')} AS target_currency_nulls, {failing('v IS NULL')} AS exchange_rate_nulls,
       {failing('v <= 0')} AS impossible_rates, CAST(min(day) AS VARCHAR) AS first_day, CAST(max(day) AS VARCHAR) AS last_day,
       count(DISTINCT day) AS days,
       (SELECT count(*) FROM (SELECT 1 FROM kept GROUP BY day, base, target HAVING count(*) > 1)) AS duplicates
FROM kept
""")
def profile_fx(t):
    return profiles.fx(stored(silver.fx(staging.fx_rates(t), staging.FX_FIRST, staging.FX_LAST), "silver"))


@query(f"""
WITH {staging.GDP}
SELECT {failing('year IS NULL')} AS year_nulls, {failing('country_code IS NULL')} AS country_code_nulls,
       {failing('gdp_usd IS NULL')} AS gdp_usd_nulls, min(year) AS first_year, max(year) AS last_year,
       {failing('gdp_usd <= 0')} AS impossible_values
FROM gdp
""")
def profile_gdp(t):
    return profiles.gdp(silver.gdp(staging.gdp_records(t), excluded_year=2001))


@query(f"""
WITH {staging.GDP}
SELECT 'count' AS statistic, CAST(count(*) AS DOUBLE) AS value FROM gdp
UNION ALL SELECT 'min', min(gdp_usd) FROM gdp
UNION ALL SELECT '25%', quantile_cont(CAST(gdp_usd AS DOUBLE), 0.25) FROM gdp
UNION ALL SELECT '50%', quantile_cont(CAST(gdp_usd AS DOUBLE), 0.5) FROM gdp
UNION ALL SELECT '75%', quantile_cont(CAST(gdp_usd AS DOUBLE), 0.75) FROM gdp
UNION ALL SELECT 'mean', CAST(sum(gdp_usd) AS DOUBLE) / count(*) FROM gdp
UNION ALL SELECT 'max', max(gdp_usd) FROM gdp
""")
def gdp_summary(t):
    return profiles.gdp_summary(stored(silver.gdp(staging.gdp_records(t), excluded_year=2001), "silver"))
