"""Quality checks, suites and reports on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeweave.catalog import staging
from lakeweave.catalog.registry import query
from lakeweave.operators import aggregates, checks
from lakeweave.plans import silver, suites
from lakeweave.session import stored

FIELDS = ("suite", "kind", "name", "CAST(success AS string) AS success",
          "CAST(unexpected_count AS double) AS unexpected_count", "detail")


def nullable_events(t):
    return t("events").select(
        "event_id", "ts", F.nullif(F.col("user_id") % 7, F.lit(2)).alias("grp"),
        F.nullif(F.col("event_type"), F.lit("click")).alias("event_type"), (F.col("value") - 20).alias("value"))


EVENTS = """
e AS (SELECT event_id, ts, nullif(user_id % 7, 2) AS grp, nullif(event_type, 'click') AS event_type,
             value - 20 AS value FROM events)
"""


def checked(name, *listed):
    suite = checks.Suite(name, checks=tuple(listed))
    return lambda df: suite.evaluate(df).filter(F.col("kind") == "check").select(
        "name", "success", "unexpected_count", "detail")


def one_check(name, count, detail, source="e"):
    return (f"SELECT '{name}' AS name, {count} = 0 AS success, {count} AS unexpected_count, "
            f"CASE WHEN {count} > 0 THEN {detail} END AS detail FROM {source}")


def failing(test):
    return f"count(*) FILTER (WHERE {test})"


@query(f"WITH {EVENTS} " + " UNION ALL ".join(
    one_check(f"No Nulls → {c}", failing(f"{c} IS NULL"), f"'Found ' || {failing(f'{c} IS NULL')} || ' null rows'")
    for c in ("event_id", "ts", "grp", "event_type", "value")))
def quality_not_null(t):
    suite = checks.Suite("nulls", null_detail="Found {n} null rows")
    return suite.evaluate(nullable_events(t)).filter(F.col("kind") == "check").select(
        "name", "success", "unexpected_count", "detail")


EXAMPLES = """(SELECT string_agg(t, ', ' ORDER BY v) FROM (
  SELECT DISTINCT v, CAST(v AS VARCHAR) AS t FROM (SELECT CAST(value - 20 AS DECIMAL(10,2)) AS v FROM events) WHERE v < 0 ORDER BY v LIMIT 5))"""


@query(f"""
WITH e AS (SELECT CAST(value - 20 AS DECIMAL(10,2)) AS value, nullif(user_id % 7, 2) AS grp FROM events)
{one_check("Non-Negative", failing("value < 0"),
           f"'Found ' || {failing('value < 0')} || ' negative. Examples: [' || {EXAMPLES} || '...]'")}
UNION ALL {one_check("Strict", failing("value <= 0"), f"{failing('value <= 0')} || ' not above zero'")}
UNION ALL {one_check("Group", failing("grp < 1 OR grp > 5"), f"{failing('grp < 1 OR grp > 5')} || ' outside'")}
UNION ALL {one_check("Wide", failing("value > 1000000"), "''")}
""")
def quality_between(t):
    rows = t("events").select((F.col("value") - 20).cast("decimal(10,2)").alias("value"),
                              F.nullif(F.col("user_id") % 7, F.lit(2)).alias("grp"))
    return checked(
        "bounds",
        checks.between("Non-Negative", "value", "Found {n} negative. Examples: [{examples}]", low=0),
        checks.between("Strict", "value", "{n} not above zero", low=0, strict_low=True),
        checks.between("Group", "grp", "{n} outside", low=1, high=5),
        checks.between("Wide", "value", "", high=1000000),
        checks.between("Absent", "no_such_column", "{n}", low=0),
    )(rows)


@query("""
SELECT 'Row Count ≥ 1' AS name, count(*) >= 1 AS success, greatest(1 - count(*), 0) AS unexpected_count,
       CASE WHEN count(*) < 1 THEN 'Only ' || format('{:,}', count(*)) || ' rows' END AS detail FROM events
UNION ALL
SELECT 'Row Count ≥ 900,000,000', count(*) >= 900000000, greatest(900000000 - count(*), 0),
       CASE WHEN count(*) < 900000000 THEN 'Only ' || format('{:,}', count(*)) || ' rows' END FROM events
""")
def quality_row_count(t):
    return checked("rows", checks.RowCountCheck("Row Count ≥ 1", 1, "Only {n} rows"),
                   checks.RowCountCheck("Row Count ≥ 900,000,000", 900_000_000, "Only {n} rows"))(t("events"))


BAD_DAYS = failing("CAST(o_orderdate AS DATE) < DATE '1996-01-01' OR CAST(o_orderdate AS DATE) > DATE '2000-12-31'")


@query(one_check("Days", BAD_DAYS, f"{BAD_DAYS} || ' outside'", "orders"))
def quality_dates(t):
    return checked("days", checks.dates_between(
        "Days", "o_orderdate", "1996-01-01", "2000-12-31", "{n} outside"))(t("orders"))


@query("""
SELECT 'Unique' AS name, d = 0 AS success, d AS unexpected_count, CASE WHEN d > 0 THEN d || ' duplicate rows found' END AS detail
FROM (SELECT CAST(sum(n - 1) AS BIGINT) AS d FROM (SELECT count(*) AS n FROM events GROUP BY CAST(ts AS DATE), user_id))
""")
def quality_unique(t):
    rows = t("events").select(F.to_date("ts").alias("day"), "user_id")
    return checked("keys", checks.UniqueCheck("Unique", ("day", "user_id"), "{n} duplicate rows found"))(rows)


@query(f"""
WITH {EVENTS}, g AS (SELECT event_type, count(*) AS n FROM e WHERE event_type IS NOT NULL GROUP BY 1),
s AS (SELECT max(n) - min(n) AS d, '{{' || string_agg('''' || event_type || ''': ' || n, ', ' ORDER BY event_type) || '}}' AS l FROM g)
SELECT 'Balance' AS name, d <= 24 AS success, d AS unexpected_count,
       CASE WHEN d > 24 THEN 'Row imbalance across zones: ' || d || ' hours. Counts: ' || l END AS detail FROM s
UNION ALL SELECT 'Loose', d <= 1000000000, d, CASE WHEN d > 1000000000 THEN '' END FROM s
""")
def quality_balance(t):
    return checked(
        "balance",
        checks.BalanceCheck("Balance", "event_type", 24, "Row imbalance across zones: {n} hours. Counts: {counts}"),
        checks.BalanceCheck("Loose", "event_type", 1_000_000_000, "{n}"))(nullable_events(t))


def small_suite():
    return checks.Suite(
        "Events", null_detail="Found {n} null rows",
        checks=(
            checks.between("Non-Negative", "value", "Found {n} negative", low=0),
            checks.RowCountCheck("Row Count ≥ 1", 1, "Only {n} rows"),
            checks.UniqueCheck("Unique", ("event_id",), "{n} duplicate rows found"),
        ),
        stats=(checks.Stat("Largest", ("value",), lambda: F.format_number(F.max("value"), 2)),
               checks.Stat("Missing", ("absent",), lambda: F.max("absent").cast("string"))))


def suite_sql(suite, nulls, others, stats, source, null_detail):
    """SQL for a suite: not-null checks, further ``(name, count, detail)`` and statistics."""
    lines = []
    for column, test in nulls:
        n = failing(test)
        lines.append(f"SELECT '{suite}' AS suite, 'check' AS kind, 'No Nulls → {column}' AS name, CAST({n} = 0 AS VARCHAR) AS success, "
                     f"CAST({n} AS DOUBLE) AS unexpected_count, CASE WHEN {n} > 0 THEN 'Found ' || {n} || ' {null_detail}' END AS detail FROM {source} HAVING count(*) >= 0")
    for name, n, detail in others:
        lines.append(f"SELECT '{suite}', 'check', '{name}', CAST({n} = 0 AS VARCHAR), {n}, CASE WHEN {n} > 0 THEN {detail} END FROM {source} HAVING count(*) >= 0")
    for name, value in stats:
        lines.append(f"SELECT '{suite}', 'stat', '{name}', NULL, NULL, {value} FROM {source} HAVING count(*) >= 0")
    return " UNION ALL ".join(lines)


SMALL = suite_sql(
    "Events", [(c, f"{c} IS NULL") for c in ("event_id", "ts", "grp", "event_type", "value")],
    [("Non-Negative", failing("value < 0"), f"'Found ' || {failing('value < 0')} || ' negative'"),
     ("Row Count ≥ 1", "greatest(1 - count(*), 0)", "''"),
     ("Unique", "(count(*) - count(DISTINCT event_id))", "''")],
    [("Largest", "format('{:,.2f}', max(value))"), ("Missing", "'N/A'"),
     ("Total Null Values", f"format('{{:,}}', {failing('grp IS NULL')} + {failing('event_type IS NULL')})")],
    "e", "null rows")


@query(f"WITH {EVENTS} {SMALL}")
def quality_suite(t):
    return small_suite().evaluate(nullable_events(t)).selectExpr(*FIELDS)


@query(f"""
WITH {EVENTS}, r AS ({SMALL})
SELECT suite, count(*) AS total, count(*) FILTER (WHERE success = 'true') AS passed, count(*) FILTER (WHERE success = 'false') AS failed,
       format('{{:.1f}}%', 100.0 * count(*) FILTER (WHERE success = 'true') / count(*)) AS success_rate
FROM r WHERE kind = 'check' GROUP BY suite
""")
def quality_totals(t):
    return checks.totals(small_suite().evaluate(nullable_events(t)))


@query(f"""
WITH {EVENTS},
n AS (SELECT {failing('grp IS NULL')} AS grp, {failing('event_type IS NULL')} AS typ, {failing('value < 0')} AS neg,
             format('{{:,.2f}}', max(value)) AS largest FROM e)
SELECT 'Events' AS suite, section, CAST(position AS BIGINT) AS position, name, value FROM (
  SELECT 'summary' AS section, 0 AS position, 'Total Checks' AS name, '8' AS value
  UNION ALL SELECT 'summary', 1, 'Passed', '5'
  UNION ALL SELECT 'summary', 2, 'Failed', '3'
  UNION ALL SELECT 'summary', 3, 'Success Rate', '62.5%'
  UNION ALL SELECT 'failure', 1, 'No Nulls → grp', substr('Found ' || grp || ' null rows', 1, 12) || '... [Truncated]' FROM n
  UNION ALL SELECT 'failure', 2, 'No Nulls → event_type', substr('Found ' || typ || ' null rows', 1, 12) || '... [Truncated]' FROM n
  UNION ALL SELECT 'failure', 3, 'Overflow Alert', 'And 1 more column validation checks failed. Please check notebook console logs for details.'
  UNION ALL SELECT 'statistic', 8, 'Largest', largest FROM n
  UNION ALL SELECT 'statistic', 9, 'Missing', 'N/A'
  UNION ALL SELECT 'statistic', 10, 'Total Null Values', format('{{:,}}', grp + typ) FROM n)
""")
def quality_report(t):
    return checks.report(small_suite().evaluate(nullable_events(t)), max_failures=2, max_len=12)


def _examples(column, table, test):
    distinct = f"SELECT DISTINCT {column} AS v FROM {table} WHERE {test}"
    return (f"coalesce((SELECT string_agg(CAST(v AS VARCHAR), ', ' ORDER BY v) FROM ({distinct} ORDER BY v LIMIT 5)), '') || "
            f"CASE WHEN (SELECT count(*) FROM ({distinct})) > 5 THEN '...' ELSE '' END")


TAXI_NAMES = (("pickup_datetime", "pickup"), ("dropoff_datetime", "dropoff"), ("passenger_count", "passengers"),
              ("trip_distance", "trip_distance"), ("total_amount", "total"), ("congestion_surcharge", "surcharge"),
              ("pickup_year", "pickup"), ("pickup_hour", "pickup"), ("pickup_day", "pickup"),
              ("pickup_month", "pickup"), ("pickup_borough", "borough"), ("pickup_zone", "zone"))


@query(f"WITH {staging.TRIPS} " + suite_sql(
    "Taxi Data Quality", [(name, f"{column} IS NULL") for name, column in TAXI_NAMES],
    [("Positive Total Amount", failing("total <= 0"), "''"),
     ("Positive Trip Distance", failing("trip_distance <= 0"), "''"),
     ("Passenger Imputation Check", failing("passengers < 1"), "''")],
    [("Total Records", "format('{:,}', count(*))"), ("Unique Zones", "format('{:,}', count(DISTINCT zone))"),
     ("Processing Window", "strftime(min(pickup), '%Y-%m-%d') || ' to ' || strftime(max(pickup), '%Y-%m-%d')"),
     ("Total Revenue", "'$' || format('{:,.2f}', CAST(sum(total) AS DOUBLE))"),
     ("Total Null Values", f"format('{{:,}}', {failing('borough IS NULL')} + {failing('zone IS NULL')})")],
    "silver_taxi", "null rows"))
def suite_taxi(t):
    trips = silver.taxi(staging.trips(t), staging.zone_lookup(t), time_type="timestamp_ntz")
    return suites.check_table(stored(trips, "silver"), "taxi").selectExpr(*FIELDS)


@query(f"WITH {staging.TRIPS}, raw AS (SELECT CAST(fare - 10 AS DECIMAL(10,2)) AS total_amount, CAST(location % 4 - 1 AS DOUBLE) AS trip_distance FROM once), " + f"""
c AS (SELECT {failing('total_amount <= 0')} AS a, {failing('trip_distance <= 0')} AS b FROM raw)
SELECT name, n = 0 AS success, n AS unexpected_count, CASE WHEN n > 0 THEN detail END AS detail FROM (
  SELECT 'Positive Total Amount' AS name, a AS n, 'Found ' || a || ' zero or negative values (<= 0). Examples: [' ||
    {_examples('total_amount', 'raw', 'total_amount <= 0')} || ']' AS detail FROM c
  UNION ALL SELECT 'Positive Trip Distance', b, 'Found ' || b || ' zero or negative distance metrics (<= 0). Examples: [' ||
    {_examples('trip_distance', 'raw', 'trip_distance <= 0')} || ']' FROM c)
""")
def suite_taxi_examples(t):
    """The taxi suite on rows as they arrive, so that its range checks fail."""
    raw = t("events").select((F.col("value") - 10).cast("decimal(10,2)").alias("total_amount"),
                             (F.col("user_id") % 4 - 1).cast("double").alias("trip_distance"))
    return suites.check_table(raw, "taxi").filter("kind = 'check' AND name LIKE 'Positive%'").select(
        "name", "success", "unexpected_count", "detail")


AIR_COLUMNS = ("day", "location_name", "locality", "timezone", "parameter_name", "value", "parameter_units")


@query(f"WITH {staging.AIR} " + suite_sql(
    "Air Quality Data Quality",
    [("date" if c == "day" else c, f"{c} IS NULL") for c in AIR_COLUMNS]
    + [(c, "FALSE") for c in ("latitude", "longitude")]
    + [(c, "day IS NULL") for c in ("year", "month", "dayofweek")],
    [("Non-Negative Concentration Value", failing("value < 0"), "''")],
    [("Total Readings", "format('{:,}', count(*))"), ("Unique Localities", "format('{:,}', count(DISTINCT locality))"),
     ("Parameters Checked", "(SELECT string_agg(parameter_name, ', ' ORDER BY parameter_name) FROM (SELECT DISTINCT parameter_name FROM silver_air))"),
     ("Max Value by Parameter", "(SELECT string_agg(p || ': ' || format('{:,.2f}', m), ' | ' ORDER BY p) FROM (SELECT parameter_name AS p, max(value) AS m FROM silver_air GROUP BY 1))"),
     ("Processing Window", "strftime(min(day), '%Y-%m-%d') || ' to ' || strftime(max(day), '%Y-%m-%d')"),
     ("Total Null Values", "'0'")],
    "silver_air", "null metrics"))
def suite_air(t):
    readings = silver.air(staging.air_tables(t), staging.AIR_YEARS)
    return suites.check_table(stored(readings, "silver"), "air").selectExpr(*FIELDS)


@query(f"""
WITH {staging.DIM_FX}, f AS (SELECT * FROM dim_fx) """ + suite_sql(
    "FX Rate Data Quality", [("date", "day IS NULL"), ("base_currency", "FALSE"), ("target_currency", "FALSE"), ("exchange_rate", "rate IS NULL")],
    [("Market Rationality Boundary (0.2 - 3.0)", failing("rate < 0.2 OR rate > 3.0"),
      failing("rate < 0.2 OR rate > 3.0") + " || ' pricing metrics outside bounds'")],
    [("Total Trading Days", "format('{:,}', count(*))"),
     ("Processing Window", "strftime(min(day), '%Y-%m-%d') || ' to ' || strftime(max(day), '%Y-%m-%d')"),
     ("Max Historical Rate", "format('{:.4f}', CAST(max(rate) AS DOUBLE))"), ("Total Null Values", "'0'")],
    "f", "broken fields"))
def suite_fx(t):
    rates = silver.fx(staging.usd_rates(t), staging.USD_FIRST, staging.USD_LAST)
    return suites.check_table(stored(rates, "silver"), "fx").selectExpr(*FIELDS)


@query(f"WITH {staging.GDP} " + suite_sql(
    "US GDP Data Quality", [(c, f"{c} IS NULL") for c in ("year", "country_code", "gdp_usd")],
    [("Valid Operational History Years", failing("year < 1900 OR year > 1999"),
      f"'Found ' || {failing('year < 1900 OR year > 1999')} || ' invalid historical dates'"),
     ("Positive Absolute Value GDP", failing("gdp_usd < 1"), "''")],
    [("Historical Profiles", "count(*) || ' Years Monitored'"), ("Processing Window", "min(year) || ' to ' || max(year)"),
     ("Peak US Valuation", "'$' || format('{:,.2f}', CAST(max(gdp_usd) AS DOUBLE))"), ("Total Null Values", "'0'")],
    "gdp", "empty fields"))
def suite_gdp(t):
    records = silver.gdp(staging.gdp_records(t), excluded_year=2001)
    return suites.check_table(stored(records, "silver"), "gdp", as_of_year=1999).selectExpr(*FIELDS)


#: Names, bounds and texts of the published weather report.
WEATHER_NAMES = (("weather_timestamp", "time"), ("zone_name", "zone"), ("temperature_c", "temp"), ("humidity_%", "humidity"),
                 ("precipitation_mm", "precip"), ("wind_speed_kmh", "wind"), ("rain_mm", "rain"),
                 ("snowfall_cm", "snow"), ("wind_direction_deg", "direction"))
WEATHER_RANGES = (
    ("Temperature Range (-30°C to 45°C)", "temp < -30 OR temp > 45", "values outside realistic NYC range"),
    ("Humidity Range (0–100%)", "humidity < 0 OR humidity > 100", "values outside 0–100 range"),
    ("Precipitation Non-Negative", "precip < 0", "negative precipitation values"),
    ("Rain Non-Negative", "rain < 0", "negative rain values"),
    ("Snowfall Non-Negative", "snow < 0", "negative snowfall values"),
    ("Wind Speed Non-Negative", "wind < 0", "negative wind speed values"),
    ("Wind Direction Range (0–360°)", "direction < 0 OR direction > 360", "values outside 0–360 range"))


@query(f"WITH {staging.WEATHER}, zones AS (SELECT zone, count(*) AS n FROM silver_weather GROUP BY 1) " + suite_sql(
    "Weather Data Quality", [(name, f"{column} IS NULL") for name, column in WEATHER_NAMES],
    [(name, failing(test), f"{failing(test)} || ' {detail}'") for name, test, detail in WEATHER_RANGES]
    + [("Date Range (2023-01-01 to 2026-12-31)", failing("time < TIMESTAMP '2023-01-01' OR time >= TIMESTAMP '2027-01-01'"), "''"),
       ("No Duplicate (timestamp, zone) pairs", "0", "''"),
       ("Row Count ≥ 100,000", "greatest(100000 - count(*), 0)",
        "'Only ' || format('{:,}', count(*)) || ' rows found — possible missing data'")],
    [("Total Rows", "format('{:,}', count(*))"), ("Unique Zones", "CAST(count(DISTINCT zone) AS VARCHAR)"),
     ("Temp Range", "format('{:.1f}°C to {:.1f}°C', min(temp), max(temp))"),
     ("Avg Humidity", "format('{:.1f}%', avg(humidity))"), ("Max Precip", "format('{:.2f} mm', max(precip))"),
     ("Max Snowfall", "format('{:.2f} cm', max(snow))"), ("Max Wind", "format('{:.1f} km/h', max(wind))"),
     ("Date Range", "strftime(min(time), '%Y-%m-%d') || ' → ' || strftime(max(time), '%Y-%m-%d')"),
     ("Total Nulls", f"format('{{:,}}', {failing('snow IS NULL')} + {failing('direction IS NULL')})")],
    "silver_weather", "null values") + """
UNION ALL SELECT 'Weather Data Quality', 'check', 'Hourly Completeness per Zone', CAST(max(n) - min(n) <= 24 AS VARCHAR), max(n) - min(n),
  CASE WHEN max(n) - min(n) > 24 THEN 'Row imbalance across zones: ' || (max(n) - min(n)) || ' hours. Counts: {' ||
    string_agg('''' || zone || ''': ' || n, ', ' ORDER BY zone) || '}' END FROM zones""")
def suite_weather(t):
    readings = silver.weather(staging.weather_readings(t), staging.WEATHER_FIRST, staging.WEATHER_LAST,
                              time_type="timestamp_ntz")
    return suites.check_table(stored(readings, "silver"), "weather").selectExpr(*FIELDS)


@query("""
SELECT 'orders' AS name, CAST(o_custkey AS VARCHAR) AS "group", CAST(count(*) AS DOUBLE) AS value FROM orders GROUP BY o_custkey
UNION ALL SELECT 'largest', CAST(o_custkey AS VARCHAR), max(o_totalprice) FROM orders GROUP BY o_custkey
""")
def suite_many_groups(t):
    """Size and largest value of every group in rows, however many groups there are."""
    return aggregates.group_values(t("orders"), "o_custkey", {"orders": F.count(F.lit(1)), "largest": F.max("o_totalprice")})


@query("""
SELECT 'Value Range' AS name, count(*) FILTER (WHERE event_id % 5 <> 0 AND (value < 10 OR value > 50)) = 0 AS success,
       count(*) FILTER (WHERE event_id % 5 <> 0 AND (value < 10 OR value > 50)) AS unexpected_count,
       CASE WHEN count(*) FILTER (WHERE event_id % 5 <> 0 AND (value < 10 OR value > 50)) > 0 THEN
         count(*) FILTER (WHERE event_id % 5 <> 0 AND (value < 10 OR value > 50)) || ' outside' END AS detail FROM events
""")
def quality_between_nan(t):
    """NaN is a missing value, not one above the bound."""
    values = t("events").select(F.when(F.col("event_id") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("value")).alias("value"))
    return checked("Events", checks.between("Value Range", "value", "{n} outside", low=10, high=50))(values)
