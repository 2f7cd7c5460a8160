"""Sources and sinks: written to the shared scratch folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lakeweave.catalog.registry import query
from lakeweave.catalog import staging
from lakeweave.catalog.basics import HOURLY, hourly_totals
from lakeweave.contracts import GDP_RECORD, LOCATION_PAGE, READING_PAGE, schema, record
from lakeweave.operators import dedupe
from lakeweave.plans import gold, silver
from lakeweave.session import scratch_dir
from lakeweave.sinks import export, quarantine as quarantined, tables as sinks
from lakeweave.sinks.versions import Versioned
from lakeweave.sources import files, nested, tables


def fresh_name(stem: str) -> str:
    return f"lw_{stem}_{uuid.uuid4().hex}"


@query("""
SELECT event_id, k FROM (SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
""")
def json_expand(t):
    return nested.expand(t("events").select("event_id", "props"), "props", ["k"], schema=record(k="bigint"))


ENVELOPE_SQL = """
SELECT 'GDP' AS indicator_id, 'Gross' AS indicator_value, 'C' || c_custkey AS country_id, c_name AS country_value,
       c_mktsegment AS countryiso3code, CAST(y AS BIGINT) AS date,
       CASE WHEN y = 1999 THEN NULL ELSE CAST(c_custkey * 1000 + y AS DOUBLE) END AS value, 2.0::DOUBLE AS decimal
FROM customer, (VALUES (1999), (2000), (2001)) v(y)
"""


@query(ENVELOPE_SQL)
def json_envelope(t):
    """One document ``[meta, [records]]`` per customer, flattened to the bronze table."""
    document = F.concat(F.lit('[{"page": 1}, '), F.to_json(F.array(*gdp_records())), F.lit("]"))
    return silver.gdp_bronze(nested.envelope_records(
        t("customer").select(document.alias("text")), "text", GDP_RECORD)).withColumn("value", F.col("value").cast("double"))


def gdp_records():
    """Three yearly records of a customer."""
    def made(year):
        value = F.lit(None).cast("string") if year == 1999 else (F.col("c_custkey") * 1000 + year).cast("string")
        return F.struct(
            F.struct(F.lit("GDP").alias("id"), F.lit("Gross").alias("value")).alias("indicator"),
            F.struct(F.concat(F.lit("C"), "c_custkey").alias("id"), F.col("c_name").alias("value")).alias("country"),
            F.col("c_mktsegment").alias("countryiso3code"), F.lit(str(year)).alias("date"),
            value.alias("value"), F.lit("2").alias("decimal"))
    return [made(y) for y in (1999, 2000, 2001)]


@query(ENVELOPE_SQL)
def json_files(t):
    """The same records from files, each one document for a hundred customers."""
    path = scratch_dir(t.spark, "envelope")
    pages = t("customer").groupBy(F.floor(F.col("c_custkey") / 100).alias("page")).agg(
        F.flatten(F.collect_list(F.array(*gdp_records()))).alias("records"))
    text = F.concat(F.lit('[{"page": '), F.col("page").cast("string"), F.lit("}, "), F.to_json("records"), F.lit("]"))
    pages.select("page", text.alias("text")).write.partitionBy("page").text(path)
    return silver.gdp_bronze(nested.read_json_envelope(t.spark, path, GDP_RECORD).drop("page")).withColumn(
        "value", F.col("value").cast("double"))


def location_of():
    """A supplier as a location with four sensors."""
    sensor = lambda i: F.struct(
        (F.col("s_suppkey") * 10 + i).alias("id"),
        F.struct(F.lit(i).cast("bigint").alias("id"), F.lit(f"P{i}").alias("name"), F.lit("ppm").alias("units"),
                 F.lit(None).cast("string").alias("displayName")).alias("parameter"))
    coordinates = F.when(F.col("s_acctbal") >= 0, F.struct(
        F.lit(40.5).alias("latitude"), F.lit(-74.25).alias("longitude")))
    return F.struct(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
        F.when(F.col("s_nationkey") >= 5, F.concat(F.lit("L"), "s_nationkey")).alias("locality"),
        F.lit("America/New_York").alias("timezone"), coordinates.alias("coordinates"),
        F.array(*[sensor(i) for i in (1, 2, 7, 10)]).alias("sensors"))


@query("""
SELECT s_suppkey AS location_id, s_name AS location_name, CASE WHEN s_nationkey < 5 THEN NULL ELSE 'L' || s_nationkey END AS locality,
       'America/New_York' AS timezone, CASE WHEN s_acctbal < 0 THEN NULL ELSE 40.5::DOUBLE END AS latitude,
       CASE WHEN s_acctbal < 0 THEN NULL ELSE (-74.25)::DOUBLE END AS longitude,
       s_suppkey * 10 + p AS sensor_id, CAST(p AS BIGINT) AS parameter_id, 'P' || p AS parameter_name, 'ppm' AS parameter_units,
       CAST(NULL AS VARCHAR) AS parameter_display,
       CASE WHEN l_returnflag = 'A' THEN NULL ELSE strftime(l_shipdate, '%Y-%m-%d') END AS date, l_quantity AS value
FROM supplier, (VALUES (2), (7), (10)) v(p), lineitem
WHERE l_suppkey = s_suppkey AND l_linenumber % 4 = CASE p WHEN 2 THEN 0 WHEN 7 THEN 1 ELSE 2 END
""")
def nested_flatten(t):
    """Location pages and reading pages to the bronze table of readings."""
    pages = t("supplier").select(F.array(location_of()).cast(LOCATION_PAGE["results"].dataType).alias("results"))

    parameter = F.element_at(F.array(F.lit(2), F.lit(7), F.lit(10), F.lit(1)), (F.col("l_linenumber") % 4 + 1))
    utc = F.when(F.col("l_returnflag") == "A", F.lit("")).otherwise(
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    reading = F.struct(F.col("l_quantity").alias("value"), F.struct(F.struct(utc.alias("utc")).alias("datetimeFrom")).alias("period"))
    days = t("lineitem").select((F.col("l_suppkey") * 10 + parameter).alias("sensor_id"),
                                F.array(reading).cast(READING_PAGE["results"].dataType).alias("results"))
    return silver.air_bronze(nested.flatten_locations(pages), nested.flatten_readings(days))


@query("""
SELECT s_suppkey AS location_id, s_name AS location_name, s_suppkey * 10 + p AS sensor_id, CAST(p AS BIGINT) AS parameter_id,
       CAST(s_suppkey // 10 AS BIGINT) AS page
FROM supplier, (VALUES (2), (7), (10)) v(p) WHERE p <> 10 OR s_suppkey >= 0
""")
def page_files(t):
    """Location pages as files, one document each; the page is told by the path."""
    path = scratch_dir(t.spark, "pages")
    pages = t("supplier").groupBy(F.floor(F.col("s_suppkey") / 10).alias("page")).agg(
        F.collect_list(location_of()).cast(LOCATION_PAGE["results"].dataType).alias("results"))
    pages.select("page", F.to_json(F.struct("results")).alias("text")).write.partitionBy("page").text(path)
    read = nested.read_pages(t.spark, path, LOCATION_PAGE)
    page = F.regexp_extract("source_path", "page=([0-9]+)", 1).cast("bigint")
    parts = read.select("results", page.alias("page"))
    located = nested.flatten_locations(parts).select("location_id", "location_name", "sensor_id", "parameter_id")
    numbers = parts.select(F.explode("results.id").alias("location_id"), "page")
    return located.join(numbers, "location_id")


CUSTOMER_CSV = schema("""
    c_custkey bigint
    c_name string
    c_nationkey int
    c_acctbal double
    c_mktsegment string
""")


@query("""
SELECT c_custkey, '"' || c_name || '"' AS c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal,
       c_mktsegment FROM customer
""")
def csv_roundtrip(t):
    """Quotes are text and types are declared."""
    path = scratch_dir(t.spark, "csv")
    quoted = t("customer").select([F.concat(F.lit('"'), c, F.lit('"')).alias(c) if c == "c_name" else F.col(c)
                                   for c in CUSTOMER_CSV.names])
    quoted.write.option("header", True).option("quote", "").csv(path)
    return files.read_typed_csv(t.spark, path, CUSTOMER_CSV)


@query("SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_inferred(t):
    path = scratch_dir(t.spark, "csv")
    t("customer").write.option("header", True).csv(path)
    return files.read_csv(t.spark, path)


DRIFT = schema("""
    event_id bigint
    user_id double
    value double
    event_type string
    airport_fee double
""")


@query("""
SELECT event_id, CAST(user_id AS DOUBLE) AS user_id, value, CASE WHEN value < 10 THEN event_type END AS event_type,
       CAST(NULL AS DOUBLE) AS airport_fee FROM events
""")
def month_paths(t):
    """Monthly files of three schema versions, read as one table."""
    base = scratch_dir(t.spark, "months")
    events = t("events")
    versions = {
        1: events.filter("value < 10").select("event_id", F.col("user_id").cast("int"), "value", "event_type"),
        2: events.filter("value >= 10 AND value < 50").select(
            F.col("event_id").alias("Event_ID"), F.col("user_id").cast("double").alias("User_Id"), "value",
            F.lit(1).alias("extra")),
        3: events.filter("value >= 50").select("event_id", "user_id", F.col("value").alias("VALUE")),
    }
    for month, df in versions.items():
        df.write.parquet(files.month_paths(base, 2025, [month])[0])
    return files.read_months(t.spark, base, 2025, sorted(versions), DRIFT)


@query("""
SELECT event_id, value, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20'
""")
def partitioned_write(t):
    """Written by day; reading ten days lists only their folders."""
    path = scratch_dir(t.spark, "parts")
    sinks.write_parquet(t("events").select("event_id", "value", F.to_date("ts").alias("day")), path, ["day"])
    written = schema("event_id bigint\nvalue double\nday date")
    return files.read_parquet(t.spark, path, written).filter("day >= DATE'2024-01-10' AND day < DATE'2024-01-20'")


@query("""
SELECT 'good' AS part, event_id, CAST(value AS VARCHAR) AS note FROM events WHERE event_type <> 'error'
UNION ALL SELECT 'bad', event_id, 'reading: cannot read ''n/a'' as double' FROM events WHERE event_type = 'error'
""")
def quarantine(t):
    text = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col("value").cast("string"))
    good, bad = quarantined.split(t("events").select("event_id", text.alias("reading")), {"reading": "double"}, ["event_id"])
    return good.select(F.lit("good").alias("part"), "event_id", F.col("reading").cast("string").alias("note")).unionByName(
        bad.select(F.lit("bad").alias("part"), "event_id", F.col("error").alias("note")))


@query("SELECT event_id, 'value: cannot read ''n/a'' as double' AS error FROM events WHERE event_type = 'error'")
def error_table(t):
    """The side table written when there are bad records."""
    name, path = fresh_name("quarantine"), scratch_dir(t.spark, "errors")
    text = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col("value").cast("string"))
    _, bad = quarantined.split(t("events").select("event_id", text.alias("value")), {"value": "double"}, ["event_id"])
    quarantined.save_errors(bad, name, path=path)
    return tables.table(t.spark, f"{name}_errors")


@query(f"""
SELECT string_agg('{{"DateKey":"' || "DateKey" || '","HourOfDay":' || "HourOfDay" || ',"pickup_zone":"' || pickup_zone ||
  '","totaltrips":' || totaltrips || '}}', ',' ORDER BY "DateKey", "HourOfDay", pickup_zone) AS body
FROM ({HOURLY} LIMIT 100)
""".replace("string_agg(", "'[' || string_agg(").replace(") AS body", ") || ']' AS json"))
def export_json(t):
    return export.json_array(hourly_totals(t("events")).drop("totalrevenue"), ["DateKey", "HourOfDay", "pickup_zone"])


@query("SELECT event_id, event_type, value FROM events")
def export_lines(t):
    path = scratch_dir(t.spark, "lines")
    export.export_lines(t("events").select("event_id", "event_type", "value"), path)
    return t.spark.read.schema("event_id bigint, event_type string, value double").json(path)


@query("SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name, c.n AS customers FROM nation JOIN (SELECT c_nationkey, 2 * count(*) AS n FROM customer GROUP BY 1) c ON c_nationkey = n_nationkey")
def append_table(t):
    """Appended twice, every row counts twice."""
    name, path = fresh_name("append"), scratch_dir(t.spark, "append")
    rows = t("customer").select("c_custkey", "c_nationkey")
    sinks.save_table(rows, name, path=path)
    sinks.append_table(rows, name)
    counts = dedupe.key_counts(tables.table(t.spark, name), ["c_nationkey"], "customers")
    return t("nation").join(counts, F.col("n_nationkey") == F.col("c_nationkey")).select("n_nationkey", "n_name", "customers")


@query("SELECT o_orderkey, o_totalprice AS price, o_orderstatus AS status FROM orders")
def overwrite_schema(t):
    """An overwrite replaces rows and columns."""
    name = fresh_name("overwrite")
    sinks.save_table(t("orders").select("o_orderkey", "o_custkey"), name, path=scratch_dir(t.spark, "before"))
    sinks.save_table(t("orders").select("o_orderkey", F.col("o_totalprice").alias("price"),
                                        F.col("o_orderstatus").alias("status")), name,
                     path=scratch_dir(t.spark, "after"))
    return tables.table(t.spark, name)


@query("SELECT o_orderkey, o_orderstatus AS status, 2 * o_totalprice AS price FROM orders WHERE o_orderstatus <> 'P'")
def atomic_replace(t):
    """Replaced by what is read from itself, with other columns and partitions."""
    sink = Versioned(t.spark, scratch_dir(t.spark, "versions"))
    sink.replace(t("orders").select("o_orderkey", "o_orderstatus", "o_totalprice"))
    sink.replace(sink.read().filter("o_orderstatus <> 'P'").select(
        "o_orderkey", F.col("o_orderstatus").alias("status"), (2 * F.col("o_totalprice")).alias("price")), ["status"])
    return sink.read()


@query(f"""
WITH {staging.DIM_FX} SELECT CAST(day AS VARCHAR) AS "DateKey", CAST(rate AS DOUBLE) AS "ExchangeRate" FROM dim_fx
""")
def contract_save(t):
    from lakeweave.contracts import DIM_FX
    name, path = fresh_name("dimfx"), scratch_dir(t.spark, "gold")
    rates = silver.fx(staging.usd_rates(t), staging.USD_FIRST, staging.USD_LAST)
    sinks.save_gold(gold.dim_fx(rates), name, DIM_FX, path=path)
    return tables.table(t.spark, name)
