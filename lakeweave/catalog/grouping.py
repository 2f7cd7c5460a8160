"""Aggregations, duplicates and profiles on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeweave.catalog.registry import query
from lakeweave.functions import predicates
from lakeweave.operators import aggregates, dedupe


def daily_users(t):
    return t("events").select(F.to_date("ts").alias("day"), "user_id")


@query("""
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, user_id, count(*) AS count FROM events GROUP BY 1, 2 HAVING count(*) > 1
""")
def having_duplicates(t):
    return dedupe.repeated_keys(daily_users(t), ["day", "user_id"])


@query("""
SELECT CAST(sum(n - 1) AS BIGINT) AS duplicates FROM (SELECT count(*) AS n FROM events GROUP BY CAST(ts AS DATE), user_id)
""")
def duplicate_rows(t):
    return dedupe.duplicate_rows(daily_users(t), ["day", "user_id"])


@query("""
SELECT event_type, user_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts, event_id) = 1
""")
def dedupe_by_key(t):
    rows = t("events").select("event_type", "user_id", "ts", "event_id", "value")
    return dedupe.first_by_key(rows, ["event_type", "user_id"], ["ts", "event_id"])


@query("""
SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority FROM orders
""")
def exact_duplicates(t):
    return dedupe.exact(t("orders").select("o_custkey", "o_orderstatus", "o_orderpriority"))


@query("""
SELECT count(*) FILTER (WHERE o_orderkey IS NULL) AS o_orderkey,
       count(*) FILTER (WHERE nullif(o_orderstatus, 'P') IS NULL) AS status,
       count(*) FILTER (WHERE nullif(o_custkey % 7, 3) IS NULL) AS customer_group,
       count(*) FILTER (WHERE o_custkey % 11 = 0) AS rate
FROM orders
""")
def null_profile(t):
    rate = F.when(F.col("o_custkey") % 11 == 0, F.lit(float("nan"))).otherwise(F.col("o_totalprice"))
    return aggregates.null_profile(t("orders").select(
        "o_orderkey", F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"),
        F.nullif(F.col("o_custkey") % 7, F.lit(3)).alias("customer_group"), rate.alias("rate")), nan_is_null=True)


@query("""
SELECT count(DISTINCT CAST(ts AS DATE)) AS days, CAST(CAST(min(ts) AS DATE) AS VARCHAR) AS first_day,
       CAST(CAST(max(ts) AS DATE) AS VARCHAR) AS last_day FROM events
""")
def date_bounds(t):
    return aggregates.date_bounds(t("events"), "ts")


@query("""
WITH p AS (SELECT CAST(o_totalprice AS DECIMAL(12,2)) AS v, o_totalprice AS d FROM orders)
SELECT 'count' AS statistic, CAST(count(*) AS DOUBLE) AS value FROM p
UNION ALL SELECT 'min', min(d) FROM p
UNION ALL SELECT '25%', quantile_cont(d, 0.25) FROM p
UNION ALL SELECT '50%', quantile_cont(d, 0.5) FROM p
UNION ALL SELECT '75%', quantile_cont(d, 0.75) FROM p
UNION ALL SELECT 'mean', CAST((2 * CAST(sum(v) * 100 AS HUGEINT) * 10000 + count(*)) // (2 * count(*)) AS DOUBLE) / 1000000 FROM p
UNION ALL SELECT 'max', max(d) FROM p
""")
def numeric_summary(t):
    return aggregates.numeric_summary(t("orders").select(F.col("o_totalprice").cast("decimal(12,2)").alias("v")), "v")


@query("""
SELECT count(*) AS rows, count(DISTINCT user_id) AS distinct_values, CAST(sum(user_id) AS BIGINT) AS total,
       CAST(sum(user_id) AS DOUBLE) / count(user_id) AS mean, min(user_id) AS smallest, max(user_id) AS largest
FROM events
""")
def column_stats(t):
    return aggregates.column_stats(t("events"), "user_id")


@query("""
SELECT count(*) FILTER (WHERE o_totalprice <= 5000) AS low_price,
       count(*) FILTER (WHERE o_totalprice < 20000 OR o_totalprice > 400000) AS outside_bounds,
       count(*) FILTER (WHERE nullif(o_orderstatus, 'P') IS NULL) AS no_status
FROM orders
""")
def count_matching(t):
    price = F.col("o_totalprice")
    return aggregates.count_matching(t("orders"), {
        "low_price": price <= 5000,
        "outside_bounds": predicates.outside(price, 20000, 400000),
        "no_status": F.nullif(F.col("o_orderstatus"), F.lit("P")).isNull(),
    })


@query("""
SELECT count(*) AS rows, count(*) FILTER (WHERE nullif(user_id % 7, 2) IS NULL) AS k_nulls,
       count(*) FILTER (WHERE ts IS NULL) AS ts_nulls, count(*) FILTER (WHERE value IS NULL) AS value_nulls,
       count(*) FILTER (WHERE value <= 1) AS small_values,
       CAST(CAST(min(ts) AS DATE) AS VARCHAR) AS first_day, CAST(CAST(max(ts) AS DATE) AS VARCHAR) AS last_day,
       count(DISTINCT CAST(ts AS DATE)) AS days
FROM events
""")
def silver_profile(t):
    rows = t("events").select(F.nullif(F.col("user_id") % 7, F.lit(2)).alias("k"), "ts", "value")
    return aggregates.profile(rows, {"small_values": F.col("value") <= 1}, day="ts")


@query("""
SELECT string_agg(event_type || ': ' || format('{:,.2f}', top), ' | ' ORDER BY event_type) AS max_by_type,
       string_agg(event_type, ', ' ORDER BY event_type) AS types
FROM (SELECT event_type, max(value) AS top FROM events GROUP BY 1)
""")
def max_per_group_text(t):
    return aggregates.group_texts(t("events"), "event_type", "value", "types", "max_by_type")


@query("""
SELECT max(n) - min(n) AS spread, count(*) AS groups FROM (
  SELECT nullif(event_type, 'click') AS g, count(*) AS n FROM events GROUP BY 1) WHERE g IS NOT NULL
""")
def group_spread(t):
    return aggregates.group_spread(t("events").select(F.nullif(F.col("event_type"), F.lit("click")).alias("g")), "g")
