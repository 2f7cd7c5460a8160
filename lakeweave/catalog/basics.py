"""Projections, filters, scalars, joins and ordering on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeweave.catalog.registry import query
from lakeweave.catalog.staging import clock
from lakeweave.contracts import schema
from lakeweave.functions import predicates, scalars, text
from lakeweave.operators import dedupe, joins, ordering, shape
from lakeweave.plans import gold
from lakeweave.sources import tables

FIRST, LAST = "2024-01-05", "2024-01-25"


def hourly_totals(events):
    """Events as trips: count and revenue per day, hour and type."""
    trips = events.select(F.col("ts").alias("pickup_datetime"), F.hour("ts").alias("pickup_hour"),
                          F.col("event_type").alias("pickup_zone"), F.col("value").cast("decimal(10,2)").alias("total_amount"))
    return gold.hourly_totals(trips, FIRST, LAST)


HOURLY = f"""
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS "DateKey", hour(ts) AS "HourOfDay", event_type AS pickup_zone,
       count(*) AS totaltrips, CAST(sum(CAST(value AS DECIMAL(10,2))) AS DOUBLE) AS totalrevenue
FROM events
WHERE ts >= TIMESTAMP '{FIRST}' AND ts <= TIMESTAMP '{LAST}' AND event_type IS NOT NULL
GROUP BY 1, 2, 3 ORDER BY 1, 2, 3
"""


@query(HOURLY + " LIMIT 100")
def hourly_revenue_top100(t):
    return ordering.first_rows(hourly_totals(t("events")), ["DateKey", "HourOfDay"], 100, ["pickup_zone"])


@query(HOURLY)
def hourly_revenue(t):
    return hourly_totals(t("events")).orderBy("DateKey", "HourOfDay", "pickup_zone")


PARTY = schema("""
    key bigint
    name string
    nationkey int
    acctbal double
    mktsegment string
""")


@query("""
SELECT c_custkey AS key, c_name AS name, CAST(c_nationkey AS BIGINT) AS nationkey,
       CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS DOUBLE) AS acctbal, c_mktsegment AS mktsegment FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, CAST(CAST(s_acctbal AS DECIMAL(12,2)) AS DOUBLE), NULL FROM supplier
""")
def conform_union(t):
    customers = t("customer").toDF("KEY", "Name", "NationKey", "AcctBal", "MktSegment")
    suppliers = t("supplier").toDF("Key", "NAME", "nationkey", "acctbal").withColumn("extra", F.lit(1))
    both = shape.union_all(shape.conform(shape.lower_names(customers), PARTY), shape.conform(suppliers, PARTY))
    return shape.retype(both, {"acctbal": "decimal(12,2)"})


@query("""
SELECT l_orderkey AS order_key, CAST(l_linenumber AS BIGINT) AS line, CAST(l_quantity AS BIGINT) AS quantity,
       CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS DOUBLE) AS price, round(sqrt(l_extendedprice), 2) AS root,
       CAST(NULL AS DOUBLE) AS flag_number, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS ship_day
FROM lineitem
""")
def typed_projection(t):
    typed = shape.project(t("lineitem"), {
        "order_key": "l_orderkey", "line": "l_linenumber", "quantity": ("l_quantity", "int"),
        "price": ("l_extendedprice", "decimal(10,2)"), "root": "l_extendedprice",
        "flag_number": ("l_returnflag", "double"), "ship_day": ("l_shipdate", "date"),
    })
    return typed.withColumn("root", F.round(F.sqrt("root"), 2))


@query("""
SELECT DISTINCT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day,
       CASE WHEN coalesce(nullif(o_custkey % 5, 4), 1) = 0 THEN 1 ELSE coalesce(nullif(o_custkey % 5, 4), 1) END AS passengers,
       CAST(greatest(CAST(o_totalprice AS DECIMAL(12,2)) - 5000, 0) AS DOUBLE) AS amount,
       year(o_orderdate) AS order_year, month(o_orderdate) AS order_month, dayofweek(o_orderdate) + 1 AS order_weekday
FROM orders
WHERE o_totalprice > 0 AND o_orderkey > 0 AND year(o_orderdate) IN (1996, 1997, 1999)
""")
def silver_clean(t):
    zero = F.lit(0).cast("decimal(13,2)")
    amount = (F.col("o_totalprice").cast("decimal(12,2)") - F.lit(5000).cast("decimal(12,2)")).cast("decimal(13,2)")
    passengers = F.coalesce(F.nullif(F.col("o_custkey") % 5, F.lit(4)), F.lit(1))
    kept = t("orders").filter(predicates.all_positive(F.col("o_totalprice"), F.col("o_orderkey"))
                              & predicates.years_in(F.col("o_orderdate"), [1996, 1997, 1999]))
    rows = kept.select(F.to_date("o_orderdate").alias("day"),
                       F.when(passengers == 0, 1).otherwise(passengers).alias("passengers"),
                       F.when(amount < 0, zero).otherwise(amount).alias("amount"))
    return shape.with_parts(dedupe.exact(rows), "day", {
        "order_year": F.year, "order_month": F.month, "order_weekday": F.dayofweek})


@query("""
SELECT c_custkey AS customer_key, n_name AS borough, CAST(r.n_regionkey AS DOUBLE) AS zone
FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 3) r ON c_nationkey = n_nationkey
""")
def lookup_left_join(t):
    some = t("nation").filter(F.col("n_regionkey") < 3)
    joined = joins.lookup(t("customer"), some, "c_nationkey", "n_nationkey",
                          {"n_name": "borough", "n_regionkey": "zone"},
                          drop=("c_nationkey", "c_name", "c_acctbal", "c_mktsegment"))
    return shape.rename(joined, {"c_custkey": "customer_key"}).withColumn("zone", F.col("zone").cast("double"))


@query(f"""
SELECT 'midnight' AS bound, count(*) AS n, min({clock('ts')}) AS first_ts, max({clock('ts')}) AS last_ts
FROM events WHERE ts >= TIMESTAMP '{FIRST}' AND ts <= TIMESTAMP '{LAST}'
UNION ALL
SELECT 'whole day', count(*), min({clock('ts')}), max({clock('ts')})
FROM events WHERE ts >= TIMESTAMP '{FIRST}' AND ts < TIMESTAMP '2024-01-26'
""")
def range_midnight_bound(t):
    def bounded(label, whole):
        kept = t("events").filter(predicates.between_days(F.col("ts"), FIRST, LAST, end_inclusive_day=whole))
        return kept.agg(F.lit(label).alias("bound"), F.count(F.lit(1)).alias("n"),
                        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    return bounded("midnight", False).unionByName(bounded("whole day", True))


@query("""
SELECT event_id, k FROM (SELECT event_id, nullif(user_id % 5, 2) AS k FROM events) WHERE k <> 3
""")
def not_equal_null(t):
    keyed = t("events").select("event_id", F.nullif(F.col("user_id") % 5, F.lit(2)).alias("k"))
    return keyed.filter(F.col("k") != 3)


@query("""
SELECT event_id, value FROM events
WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 72 HOUR AND ts <= (SELECT max(ts) FROM events) - INTERVAL 48 HOUR
""")
def open_closed_range(t):
    events = t("events")
    low = events.agg((F.max("ts") - F.expr("interval 72 hours"))).scalar()
    return events.filter(predicates.open_closed(
        F.col("ts"), low, low + F.expr("interval 24 hours"))).select("event_id", "value")


@query("SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber FROM lineitem WHERE l_linenumber IN (2, 3, 7)")
def in_set(t):
    return t("lineitem").filter(F.col("l_linenumber").isin(2, 3, 7)).select("l_orderkey", "l_linenumber")


@query("""
SELECT event_id, value - 20 AS value FROM events WHERE user_id % 13 <> 0 AND value - 20 >= 0
""")
def non_negative_no_nan(t):
    value = F.when(F.col("user_id") % 13 == 0, F.lit(float("nan"))).otherwise(F.col("value") - 20)
    return (t("events").select("event_id", value.alias("value"))
            .filter(predicates.non_negative(F.col("value"))))


@query("""
SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS date_key, quarter(o_orderdate) AS quarter,
       strftime(o_orderdate, '%B') AS month_name, strftime(o_orderdate, '%A') AS day_name,
       CAST(CASE WHEN dayofweek(o_orderdate) IN (0, 6) THEN 1 ELSE 0 END AS BIGINT) AS weekend
FROM orders
""")
def date_key(t):
    return shape.with_parts(t("orders").select("o_orderkey", "o_orderdate"), "o_orderdate", {
        "date_key": scalars.date_key, "quarter": F.quarter, "month_name": scalars.month_name,
        "day_name": scalars.day_name, "weekend": scalars.weekend_flag}).drop("o_orderdate")


@query("SELECT event_id, replace('America/' || event_type || '/' || user_id, '/', '') AS stripped FROM events")
def strip_text(t):
    path = F.concat(F.lit("America/"), "event_type", F.lit("/"), F.col("user_id").cast("string"))
    return t("events").select("event_id", scalars.strip_text(path).alias("stripped"))


@query("""
SELECT event_id, CASE WHEN event_type = 'click' THEN NULL ELSE strftime(ts, '%Y-%m-%d') END AS day FROM events
""")
def prefix_date(t):
    stamp = F.when(F.col("event_type") == "click", F.lit("")).otherwise(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return t("events").select("event_id", scalars.date_prefix(stamp).alias("day"))


@query("""
SELECT o_orderpriority AS priority, count(*) AS count FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10
""")
def topk_groups(t):
    return ordering.top_groups(t("orders").select(F.col("o_orderpriority").alias("priority")), "priority", 10)


@query("""
SELECT 'earliest' AS sample, rank, event_id FROM (
  SELECT row_number() OVER (ORDER BY ts, event_id) AS rank, event_id FROM events) WHERE rank <= 5
UNION ALL
SELECT 'largest', rank, event_id FROM (
  SELECT row_number() OVER (ORDER BY value DESC, event_id) AS rank, event_id FROM events) WHERE rank <= 5
""")
def ordered_samples(t):
    """A few rows to look at: the earliest and the largest, from the whole table."""
    def sample(label, rank_key):
        ranked = t("events").select(rank_key.alias("k"), "event_id")
        top = ordering.first_rows(ranked, ["k"], 5, ["event_id"]).agg(
            F.sort_array(F.collect_list(F.struct("k", "event_id"))).alias("l"))
        return top.select(F.lit(label).alias("sample"), F.posexplode("l").alias("place", "e")).select(
            "sample", (F.col("place") + 1).alias("rank"), "e.event_id")
    return sample("earliest", F.col("ts")).unionByName(sample("largest", -F.col("value")))


@query("""
SELECT z.column0 AS zone, event_type, count(*) AS n, string_agg(DISTINCT CAST(hour(ts) AS VARCHAR), ',' ORDER BY CAST(hour(ts) AS VARCHAR)) AS hours
FROM events JOIN (VALUES ('Manhattan', 0), ('Queens', 1), ('Brooklyn', 2), ('Bronx', 3), ('Staten Island', 4), ('EWR', 5)) z
  ON user_id % 6 = z.column1
GROUP BY 1, 2
""".replace("z.column0", "z.col0").replace("z.column1", "z.col1"))
def sql_scan_inline_lookup(t):
    """Tables named by suffix in SQL text, concatenated, with an in-line lookup."""
    events = t("events")
    for half, test in (("am", F.hour("ts") < 12), ("pm", F.hour("ts") >= 12)):
        events.filter(test).createOrReplaceTempView(f"lw_events_{half}")
    parts = tables.suffixed_tables(t.spark, "lw_events_", ["am", "pm"])
    merged = shape.union_all(*parts.values())
    rows = [(name, i) for i, (name, _, _) in enumerate(tables.ZONES)]
    lookup = tables.from_rows(t.spark, rows, "zone string, number bigint")
    joined = joins.lookup(merged.withColumn("number_key", F.col("user_id") % 6), lookup, "number_key", "number",
                          {"zone": "zone"})
    hours = F.array_join(F.array_sort(F.collect_set(F.hour("ts").cast("string"))), ",")  # at most 24 values
    return joined.groupBy("zone", "event_type").agg(F.count(F.lit(1)).alias("n"), hours.alias("hours"))


@query("""
SELECT event_type, format('{:,}', count(*)) AS n,
       '$' || format('{:,.2f}', CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE)) AS total,
       '-€ ' || format('{:,.2f}', CAST(max(value) AS DOUBLE)) AS negative,
       '($' || format('{:,.2f}', CAST(max(value) AS DOUBLE)) || ')' AS bracketed,
       format('{:.2f} mi', max(value)) AS distance,
       format('{:.1f}%', 100.0 * count(*) FILTER (WHERE user_id < 50) / count(*)) AS share,
       strftime(min(ts), '%Y-%m-%d') || ' to ' || strftime(max(ts), '%Y-%m-%d') AS window
FROM events GROUP BY 1
""".replace("AS window", 'AS "window"'))
def format_values(t):
    top = F.max("value")
    return t("events").groupBy("event_type").agg(
        text.thousands(F.count(F.lit(1))).alias("n"),
        text.currency(F.sum(F.col("value").cast("decimal(12,2)"))).alias("total"),
        text.currency(-top, "€", gap=" ").alias("negative"),
        text.currency(-top, negative="parentheses").alias("bracketed"),
        text.with_unit(top, 2, " mi").alias("distance"),
        text.percent(F.count_if(F.col("user_id") < 50), F.count(F.lit(1))).alias("share"),
        text.span(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).alias("window"))
