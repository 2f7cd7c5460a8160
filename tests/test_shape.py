import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeweave import contracts
from lakeweave.functions import predicates, scalars, text
from lakeweave.operators import dedupe, joins, shape


def test_conform_adds_drops_orders_and_casts(spark):
    raw = spark.createDataFrame([(1, "7", "x")], "VendorID bigint, PASSENGER_COUNT string, extra_column string")
    df = shape.conform(raw, contracts.BRONZE_TAXI)
    assert df.schema.names == contracts.BRONZE_TAXI.names
    assert [f.dataType for f in df.schema] == [f.dataType for f in contracts.BRONZE_TAXI]
    row = df.first()
    assert (row.vendorid, row.passenger_count, row.airport_fee, row.tpep_pickup_datetime) == (1, 7.0, None, None)


def test_conform_is_idempotent(spark, rows):
    raw = spark.createDataFrame([(1, 2.5), (None, None)], "VendorID int, trip_distance double")
    once = shape.conform(raw, contracts.BRONZE_TAXI)
    assert rows(shape.conform(once, contracts.BRONZE_TAXI)) == rows(once)


def test_colliding_names_fail(spark):
    with pytest.raises(ValueError):
        shape.lower_names(spark.createDataFrame([(1, 2)], "a int, b int").toDF("Ab", "aB"))


def test_bad_text_becomes_null(spark, rows):
    df = spark.createDataFrame([("1.5",), ("oops",), (None,)], "v string")
    assert rows(shape.project(df, {"n": ("v", "double")})) == [(1.5,), (None,), (None,)]


def test_percent_sign_in_a_name(spark):
    df = spark.createDataFrame([(55.0,)], "`humidity_%` double")
    assert shape.project(df, {"h_%": ("humidity_%", "int")}).first()[0] == 55


def test_nan_is_a_gap(spark, rows):
    df = spark.createDataFrame([(float("nan"),), (-1.0,), (0.0,), (None,)], "v double")
    assert rows(df.filter(predicates.non_negative(F.col("v")))) == [(0.0,)]
    assert df.filter(scalars.is_missing(F.col("v"), "double")).count() == 2
    assert df.select(scalars.nan_to_null(F.col("v")).alias("v")).filter("v IS NULL").count() == 2


def test_last_day_is_lost_but_for_midnight(spark):
    df = spark.sql("SELECT explode(array(timestamp'2023-09-30 00:00:00', timestamp'2023-09-30 00:00:01', "
                   "timestamp'2023-09-01 00:00:00')) AS t")
    assert df.filter(predicates.between_days(F.col("t"), "2023-09-01", "2023-09-30")).count() == 2
    assert df.filter(predicates.between_days(F.col("t"), "2023-09-01", "2023-09-30", True)).count() == 3


def test_years_in_equals_year_call(spark):
    df = spark.sql("SELECT explode(sequence(date'2018-12-30', date'2026-01-03')) AS d")
    years = [2019, 2021, 2022, 2025]
    assert df.filter(predicates.years_in(F.col("d"), years)).count() == df.filter(F.year("d").isin(years)).count()


@pytest.mark.parametrize("value,expected", [(5.0, False), (0.0, True), (11.0, True), (None, False)])
def test_outside_with_strict_low(spark, value, expected):
    df = spark.createDataFrame([(value,)], "v double")
    assert df.select(predicates.outside(F.col("v"), 0, 10, strict_low=True)).first()[0] is expected


def test_formats(spark):
    row = spark.createDataFrame([(-1234.5, "x" * 12)], "n double, s string").select(
        text.currency(F.col("n")).alias("a"), text.currency(F.col("n"), negative="parentheses").alias("b"),
        text.truncated(F.col("s"), 10).alias("c"), text.percent(F.lit(1), F.lit(3)).alias("d"),
        text.percent(F.lit(0), F.lit(0)).alias("e"), text.with_unit(F.lit(1234.567), 2, " mi").alias("f"),
        text.span(F.lit(None).cast("date"), F.lit(None).cast("date")).alias("g")).first()
    assert tuple(row) == ("-$1,234.50", "($1,234.50)", "x" * 10 + "... [Truncated]", "33.3%", "0.0%", "1234.57 mi", "N/A")


def test_date_prefix_and_keys(spark):
    df = spark.createDataFrame([("2022-03-04T00:00:00Z",), ("",), (None,)], "s string")
    assert [r[0] for r in df.select(scalars.date_prefix(F.col("s"))).collect()] == ["2022-03-04", None, None]
    assert spark.sql("SELECT date'2023-11-05' AS d").select(scalars.date_key(F.col("d"))).first()[0] == 20231105


def test_iso_utc_ignores_the_session_zone(spark):
    df = spark.sql("SELECT timestamp_seconds(1699164000) AS t")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert df.select(scalars.iso_utc(F.col("t"))).first()[0] == "2023-11-05T06:00:00Z"
        assert df.select(F.hour(scalars.local_clock(F.col("t"), "America/New_York"))).first()[0] == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_first_by_key_is_the_smallest_row(spark, rows):
    df = spark.createDataFrame([("a", 2, "y"), ("a", 1, "z"), ("a", 1, "b"), (None, 3, "c"), (None, 2, "d")],
                               "k string, o int, v string")
    assert rows(dedupe.first_by_key(df, ["k"], ["o"])) == [("a", 1, "b"), (None, 2, "d")]


def test_duplicate_rows_counts_beyond_the_first(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 1), (2, 1), (None, 1), (None, 1)], "a int, b int")
    assert dedupe.duplicate_rows(df, ["a", "b"]).first()[0] == 3
    assert dedupe.duplicate_rows(df.limit(0), ["a", "b"]).first()[0] == 0


def test_lookup_leaves_unmatched_rows(spark, rows):
    trips = spark.createDataFrame([(1, 10), (2, 99), (3, None)], "id int, loc int")
    zones = spark.createDataFrame([(10, "Q", "Astoria")], "LocationID int, Borough string, Zone string")
    got = joins.lookup(trips, zones, "loc", "LocationID", {"Borough": "b", "Zone": "z"}, drop=["loc"])
    assert rows(got) == [(1, "Q", "Astoria"), (2, None, None), (3, None, None)]


def test_repeated_dimension_key_fails(spark, rows):
    fact = spark.createDataFrame([(1, 5), (2, 6)], "k int, v int")
    good = spark.createDataFrame([(1, "a"), (None, "b"), (None, "c")], "dk int, n string")
    bad = good.union(spark.createDataFrame([(1, "z")], good.schema))
    assert rows(joins.many_to_one(fact, good, "k", "dk", {"n": "n"})) == [(1, 5, "a"), (2, 6, None)]
    with pytest.raises(Exception, match="DimX: key occurs more than once: 1"):
        joins.many_to_one(fact, bad, "k", "dk", {"n": "n"}, "DimX").collect()


def test_drill_across_matches_null_keys(spark, rows):
    a = spark.createDataFrame([("x", 1), (None, 2)], "k string, `m.1` int")
    b = spark.createDataFrame([("y", 3), (None, 4)], "k string, n int")
    assert rows(joins.drill_across([a, b], ["k"])) == [("x", 1, None), ("y", None, 3), (None, 2, 4)]


def test_missing_type_contract_is_typed():
    assert contracts.DIM_DATE["IsWeekend"].nullable is False
    assert contracts.FACT_TAXI_DAILY["TotalRevenue"].dataType == T.DecimalType(18, 2)
    assert len(contracts.FX_FILE) == 32 and len(contracts.BRONZE_FX) == 16


def test_rows_are_counted_by_the_action_itself(spark):
    from lakeweave.operators.aggregates import column_stats, observed
    df, seen = observed(spark.range(10))
    assert df.filter("id > 100").count() == 0
    assert seen.get["rows"] == 10
    assert column_stats(spark.range(100), "id", approximate=True).first().distinct_values in range(90, 111)
