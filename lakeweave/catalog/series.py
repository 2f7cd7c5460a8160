"""Calendars, spines, forward fill and array series on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeweave.catalog import staging
from lakeweave.catalog.registry import query
from lakeweave.functions.scalars import iso_utc, local_clock
from lakeweave.operators import series
from lakeweave.plans import gold, silver
from lakeweave.sources import nested

CALENDAR = """
cal AS (SELECT CAST(unnest(generate_series(
  (SELECT CAST(min(o_orderdate) AS DATE) FROM orders), (SELECT CAST(max(o_orderdate) AS DATE) FROM orders),
  INTERVAL 1 DAY)) AS DATE) AS day)
"""


@query(f"WITH {CALENDAR} SELECT CAST(day AS VARCHAR) AS date FROM cal")
def calendar_days(t):
    return series.calendar_of(t("orders"), "o_orderdate")


@query(f"""
WITH {CALENDAR}
SELECT CAST(day AS VARCHAR) AS "DateKey", year(day) AS "YearKey", month(day) AS "MonthNumber",
       strftime(day, '%B') AS "MonthName", quarter(day) AS "Quarter", strftime(day, '%A') AS "DayName",
       CAST(CASE WHEN dayofweek(day) IN (0, 6) THEN 1 ELSE 0 END AS BIGINT) AS "IsWeekend" FROM cal
""")
def dim_date(t):
    return gold.dim_date(series.calendar_of(t("orders"), "o_orderdate"))


@query(f"""
WITH {CALENDAR}
SELECT CAST(day AS VARCHAR) AS date, o_orderpriority, o_orderstatus
FROM cal, (SELECT DISTINCT o_orderpriority, o_orderstatus FROM orders)
""")
def calendar_spine(t):
    orders = t("orders")
    first = orders.agg(F.to_date(F.min("o_orderdate"))).scalar()
    last = orders.agg(F.to_date(F.max("o_orderdate"))).scalar()
    return series.spine(orders, ["o_orderpriority", "o_orderstatus"], first, last)


@query("""
WITH cal AS (SELECT CAST(unnest(generate_series(DATE '2024-01-02', DATE '2024-01-28', INTERVAL 1 DAY)) AS DATE) AS day),
obs AS (SELECT CAST(ts AS DATE) AS day, user_id,
               CASE WHEN event_id % 3 <> 0 THEN CAST(value AS DECIMAL(10,2)) END AS v FROM events),
filled AS (
  SELECT day, user_id, last_value(v IGNORE NULLS) OVER (
    PARTITION BY user_id ORDER BY day, v NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v
  FROM (SELECT day, user_id FROM cal, (SELECT DISTINCT user_id FROM events)) LEFT JOIN obs USING (day, user_id))
SELECT CAST(day AS VARCHAR) AS date, user_id, CAST(v AS DOUBLE) AS value FROM filled WHERE v IS NOT NULL
""")
def forward_fill(t):
    observed = t("events").select(
        F.to_date("ts").alias("date"), "user_id",
        F.when(F.col("event_id") % 3 != 0, F.col("value").cast("decimal(10,2)")).alias("value"))
    return series.forward_fill(observed, ["user_id"], "date", "value",
                               F.lit("2024-01-02").cast("date"), F.lit("2024-01-28").cast("date"))


@query("""
WITH obs AS (SELECT event_id, event_type, ts, CASE WHEN event_id % 3 = 0 THEN CAST(value AS DECIMAL(10,2)) END AS v FROM events)
SELECT event_id, event_type, CAST(last_value(v IGNORE NULLS) OVER (
  PARTITION BY event_type ORDER BY ts, v NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS value FROM obs
""")
def carry_forward(t):
    """A few keys of many readings each, filled at the grain of the readings."""
    observed = t("events").select("event_id", "event_type", "ts", F.when(
        F.col("event_id") % 3 == 0, F.col("value").cast("decimal(10,2)")).alias("value"))
    return series.carry_forward(observed, ["event_type"], "ts", "value").drop("ts")


@query(f"""
WITH cal AS (SELECT CAST(unnest(generate_series(
  DATE '{staging.FX_FIRST}', DATE '{staging.FX_LAST}', INTERVAL 1 DAY)) AS DATE) AS day),
obs AS (SELECT CAST(o_orderdate AS DATE) AS day, o_orderpriority AS base, o_orderstatus AS target,
               CASE WHEN o_custkey % 7 <> 0 THEN CAST(floor(o_totalprice) / 10000 AS DECIMAL(10,4)) END AS v FROM orders),
filled AS (
  SELECT day, base, target, last_value(v IGNORE NULLS) OVER (
    PARTITION BY base, target ORDER BY day, v NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v
  FROM (SELECT * FROM cal, (SELECT DISTINCT base, target FROM obs)) LEFT JOIN obs USING (day, base, target))
SELECT CAST(day AS VARCHAR) AS date, base AS base_currency, target AS target_currency,
       CAST(v AS DOUBLE) AS exchange_rate FROM filled WHERE v IS NOT NULL
""")
def silver_fx(t):
    return silver.fx(staging.fx_rates(t), staging.FX_FIRST, staging.FX_LAST)


@query("""
SELECT strftime(o_orderdate + to_hours(i), '%Y-%m-%d %H:%M:%S.%f') AS date, o_orderkey AS series,
       o_totalprice + i AS a, o_totalprice * i AS b,
       hour(o_orderdate + to_hours(i)) AS utc_hour
FROM orders, (SELECT unnest(range(4)) AS i)
""")
def series_explode(t):
    """Four hours per order from parallel arrays; times are shown in UTC."""
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    start, price = F.timestamp_diff("SECOND", epoch, F.col("o_orderdate")), F.col("o_totalprice")
    packed = t("orders").select(
        F.col("o_orderkey").alias("series"), start.alias("from"), (start + 4 * 3600).alias("until"),
        F.lit(3600).alias("step"),
        F.array(*[price + i for i in range(4)]).alias("a"), F.array(*[price * i for i in range(4)]).alias("b"))
    rows = nested.explode_series(packed, "from", "until", "step", ["a", "b"])
    utc = epoch + F.make_dt_interval(secs=F.unix_seconds("date"))
    return rows.withColumn("date", utc).withColumn("utc_hour", F.hour("date"))


@query("""
SELECT event_id, hour(timezone('America/New_York', timezone('UTC', ts))) AS local_hour,
       CAST(CAST(timezone('America/New_York', timezone('UTC', ts)) AS DATE) AS VARCHAR) AS local_day,
       strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso FROM events
""")
def local_hours(t):
    """Instants given in UTC, shown on the clock of another zone."""
    since = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts"))
    instant = F.timestamp_micros(since)
    local = local_clock(instant, "America/New_York")
    return t("events").select("event_id", F.hour(local).alias("local_hour"), F.to_date(local).alias("local_day"),
                              iso_utc(instant).alias("iso"))
