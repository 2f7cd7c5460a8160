import datetime as dt
import re
from decimal import Decimal

from pyspark.sql import functions as F

from lakeweave import contracts
from lakeweave.operators import aggregates, checks
from lakeweave.plans import suites

AT = dt.datetime(2023, 5, 6, 13)


def outcome(rows_df):
    return {r["name"]: r for r in rows_df.collect()}


def totals(rows_df):
    return tuple(checks.totals(rows_df).select("total", "passed", "failed", "success_rate").first())


def taxi(spark, *changes):
    base = dict(zip(contracts.SILVER_TAXI.names, (AT, AT, 1, 1.5, Decimal("10.00"), Decimal("0.00"), 2023, 13, 7, 5, "Q", "Astoria")))
    return spark.createDataFrame([tuple({**base, **c}.values()) for c in changes], contracts.SILVER_TAXI)


def test_clean_taxi_passes(spark):
    rows = suites.check_table(taxi(spark, {}, {"pickup_zone": "B"}), "taxi")
    assert totals(rows) == (15, 15, 0, "100.0%")
    got = outcome(rows)
    assert got["Unique Zones"].detail == "2" and got["Total Revenue"].detail == "$20.00"
    assert got["Processing Window"].detail == "2023-05-06 to 2023-05-06"


def test_bad_taxi_names_examples(spark):
    changes = [{"total_amount": Decimal(-n)} for n in range(8)] + [{"trip_distance": 0.0}, {"passenger_count": 0}, {"pickup_zone": None}]
    got = outcome(suites.check_table(taxi(spark, *changes), "taxi"))
    assert got["Positive Total Amount"].detail == (
        "Found 8 zero or negative values (<= 0). Examples: [-7.00, -6.00, -5.00, -4.00, -3.00...]")
    assert got["Positive Trip Distance"].detail == "Found 1 zero or negative distance metrics (<= 0). Examples: [0.0]"
    assert got["Passenger Imputation Check"].unexpected_count == 1
    assert got["No Nulls → pickup_zone"].detail == "Found 1 null rows"
    assert got["No Nulls → pickup_hour"].success and got["No Nulls → pickup_hour"].detail is None


def test_missing_column_is_not_checked(spark):
    rows = suites.check_table(taxi(spark, {}).drop("total_amount", "pickup_zone"), "taxi")
    got = outcome(rows)
    assert "Positive Total Amount" not in got and totals(rows)[0] == 12
    assert got["Unique Zones"].detail == "N/A" and got["Total Revenue"].detail == "N/A"


def test_empty_table(spark):
    rows = suites.check_table(taxi(spark, {}).limit(0), "taxi")
    assert totals(rows) == (15, 15, 0, "100.0%")
    assert outcome(rows)["Processing Window"].detail == "N/A"


def test_air_suite(spark):
    base = (dt.date(2022, 1, 1), "S", "Bronx", "NY")
    tail = (40.0, -74.0, 2022, 1, 7)
    data = [(*base, "pm25", 1.5, "u", *tail), (*base, "no2", -2.0, "u", *tail), (*base, "no2", float("nan"), "u", *tail)]
    got = outcome(suites.check_table(spark.createDataFrame(data, contracts.SILVER_AIR), "air"))
    assert got["Parameters Checked"].detail == "no2, pm25"
    assert got["No Nulls → value"].unexpected_count == 1  # NaN
    assert got["Non-Negative Concentration Value"].detail == "Found 1 negative pollutant readings (< 0). Examples: [-2.0]"


def test_fx_and_gdp_suites(spark):
    fx = spark.createDataFrame([(dt.date(2020, 1, 1), "USD", "EUR", Decimal(v)) for v in ("0.2000", "0.1999", "3.0001", "3.0000")],
                               contracts.SILVER_FX)
    got = outcome(suites.check_table(fx, "fx"))
    assert got["Market Rationality Boundary (0.2 - 3.0)"].detail == "2 pricing metrics outside bounds"
    assert got["Max Historical Rate"].detail == "3.0001"
    gdp = spark.createDataFrame([(1899, "USA", 5), (2030, "USA", 0), (2000, "USA", None)], contracts.SILVER_GDP)
    got = outcome(suites.check_table(gdp, "gdp", as_of_year=2026))
    assert got["Valid Operational History Years"].unexpected_count == 2
    assert got["Positive Absolute Value GDP"].unexpected_count == 1
    assert got["Processing Window"].detail == "1899 to 2030" and got["Historical Profiles"].detail == "3 Years Monitored"
    clock = outcome(suites.check_table(gdp, "gdp"))
    assert clock["Valid Operational History Years"].unexpected_count in (1, 2)


def weather(spark, hours, zones=("A", "B")):
    start = dt.datetime(2024, 1, 1)
    data = [(20240101, start + dt.timedelta(hours=h), z, 0, 2024, 1, 1, 1.0, 50.0, 0.0, 0.0, 0.0, 1.0, 90)
            for z, n in zip(zones, hours) for h in range(n)]
    return spark.createDataFrame(data, contracts.SILVER_WEATHER)


def test_weather_suite(spark):
    df = weather(spark, (40, 10))
    df = df.unionByName(df.filter("zone_name = 'B'")).unionByName(
        df.limit(1).withColumns({"weather_timestamp": F.lit("2027-01-01 00:00:00").cast("timestamp"),
                                 "temperature_c": F.lit(45.1), "humidity_%": F.lit(None).cast("double"),
                                 "zone_name": F.lit(None).cast("string")}))
    got = outcome(suites.check_table(df, "weather", min_rows=1000, tolerance=10))
    assert got["No Duplicate (timestamp, zone) pairs"].unexpected_count == 10
    assert got["Row Count ≥ 1,000"].detail == "Only 61 rows found — possible missing data"
    assert got["Hourly Completeness per Zone"].detail == "Row imbalance across zones: 20 hours. Counts: {'A': 40, 'B': 20}"
    assert got["Date Range (2023-01-01 to 2026-12-31)"].unexpected_count == 1
    assert got["Temperature Range (-30°C to 45°C)"].unexpected_count == 1
    assert got["No Nulls → humidity_%"].unexpected_count == 1
    assert got["Temp Range"].detail == "1.0°C to 45.1°C" and got["Max Wind"].detail == "1.0 km/h"


def test_balance_lists_every_group(spark):
    df = spark.range(500).select(F.format_string("g%03d", F.least(F.col("id"), F.lit(150))).alias("g"))
    suite = checks.Suite("s", checks=(checks.BalanceCheck("b", "g", 1, "{n}: {counts}"),))
    row = outcome(suite.evaluate(df))["b"]
    assert row.unexpected_count == 349 and row.detail.startswith("349: {'g000': 1, ") and row.detail.endswith("'g150': 350}")
    assert row.detail.count("'g") == 151


def test_air_suite_names_all_parameters(spark):
    df = spark.range(20_002).select(F.format_string("p%05d", F.col("id") % 10_001).alias("parameter_name"),
                                    F.when(F.col("id") % 10_001 > 0, F.col("id").cast("double")).alias("value"))
    got = outcome(suites.check_table(df, "air"))
    assert got["Parameters Checked"].detail.count(", ") == 10_000
    assert got["Max Value by Parameter"].detail.startswith("p00000: nan | p00001: 10,002.00 | ")
    only = outcome(suites.check_table(df.drop("value"), "air"))
    assert only["Parameters Checked"].detail.startswith("p00000, ") and only["Max Value by Parameter"].detail == "N/A"


def test_missing_numbers_are_not_out_of_bounds(spark):
    df = spark.createDataFrame([(float("nan"),), (5.0,), (None,), (11.0,)], "v double")
    suite = checks.Suite("s", checks=(checks.between("b", "v", "{n}", low=0, high=10),))
    assert outcome(suite.evaluate(df))["b"].unexpected_count == 1


def test_total_of_nulls_stands_where_the_reports_have_it(spark):
    for name, place in (("taxi", 2), ("air", 4), ("fx", 1), ("gdp", 1), ("weather", 1)):
        rows = suites.check_table(spark.createDataFrame([(1,)], "x int"), name).filter("kind = 'stat'").orderBy("seq").collect()
        assert [r["name"] for r in rows].index("Total Nulls" if name == "weather" else "Total Null Values") == place, name


def test_passed_and_failed_add_up(spark):
    for df, name in ((taxi(spark, {"pickup_zone": None}), "taxi"), (weather(spark, (5, 50)), "weather")):
        total, passed, failed, _ = totals(suites.check_table(df, name))
        assert total == passed + failed and failed > 0


def test_report_limits_failures(spark):
    df = spark.createDataFrame([tuple([None] * 20)], ", ".join(f"c{i} int" for i in range(20)))
    suite = checks.Suite("wide", null_detail="x" * 1000)
    lines = checks.report(suite.evaluate(df)).orderBy("section", "position").collect()
    failures = [r for r in lines if r.section == "failure"]
    assert len(failures) == 16 and failures[-1]["name"] == "Overflow Alert"
    assert failures[-1].value == "And 5 more column validation checks failed. Please check notebook console logs for details."
    assert failures[0].value == "x" * 900 + "... [Truncated]"
    summary = {r["name"]: r.value for r in lines if r.section == "summary"}
    assert summary == {"Total Checks": "20", "Passed": "0", "Failed": "20", "Success Rate": "0.0%"}


def test_one_grouping_serves_all_group_checks(spark, tmp_path):
    """A key check, a balance check and two lists; nulls, and a key that is a value too."""
    rows = [(1, "a", 2.0), (1, "a", 3.0), (2, "b", None), (None, "b", 1.0), (None, "b", 1.5), (3, None, 9.0), (1, None, 0.5)]
    spark.createDataFrame(rows, "t int, g string, v double").write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    suite = checks.Suite("s", checks=(
        checks.UniqueCheck("keys", ("t", "g"), "{n} twice"), checks.UniqueCheck("times", ("t",), "{n} twice"),
        checks.BalanceCheck("balance", "g", 0, "{n}: {counts}"), checks.UniqueCheck("absent", ("x",), "")), stats=(
        checks.GroupStat("groups", "g"), checks.GroupStat("tops", "g", "v"), checks.GroupStat("own", "v", "v"), checks.GroupStat("none", "x")))
    got = {r["name"]: (r["success"], r["unexpected_count"], r["detail"]) for r in suite.evaluate(df).collect()}
    assert got["keys"] == (False, 2, "2 twice") and got["times"] == (False, 3, "3 twice") and "absent" not in got
    assert got["balance"] == (False, 1, "1: {'a': 2, 'b': 3}")
    assert got["groups"][2] == "a, b" and got["tops"][2] == "a: 3.00 | b: 1.50" and got["none"][2] == "N/A"
    assert got["own"][2].startswith("0.5: 0.50 | 1.0: 1.00")
    groups = suite.groups(df)
    assert {k: g.count() for k, g in groups.items()} == {("t", "g"): 5, ("t",): 4, ("g",): 3, ("v",): 7}
    assert suite.evaluate(df.limit(0)).filter("name = 'balance'").first()["success"]


def test_a_million_groups_need_no_long_list(spark):
    df = spark.range(1_000_000).select(F.col("id").alias("g"), (F.col("id") % 3).cast("double").alias("v"))
    suite = checks.Suite("s", checks=(checks.BalanceCheck("balance", "g", 0, "{counts}"), checks.UniqueCheck("keys", ("g",), "")),
                         stats=(checks.GroupStat("tops", "g", "v"),))
    got = {r["name"]: r["detail"] for r in suite.evaluate(df).collect()}
    assert got["balance"] is None and got["tops"].count(" | ") == aggregates.LISTED and got["tops"].endswith("...")
    assert suite.groups(df)["g",].count() == 1_000_000
    text = df._sc._jvm.PythonSQLUtils.explainString(suite.evaluate(df)._jdf.queryExecution(), "formatted")
    assert "TakeOrderedAndProject" in text or "Limit" in text


def test_weather_groupings_take_one_exchange(spark, tmp_path):
    from lakeweave import contracts
    from lakeweave.plans import suites
    spark.createDataFrame([], contracts.SILVER_WEATHER).write.parquet(str(tmp_path / "w"))
    df = spark.read.parquet(str(tmp_path / "w"))
    text = df._sc._jvm.PythonSQLUtils.explainString(suites.weather_suite().evaluate(df)._jdf.queryExecution(), "formatted")
    # The rows themselves are read once more, for the row checks; the groups come from the stored grouping.
    assert len(set(re.findall(r"Location: InMemoryFileIndex \[([^\]]+/w)\]", text))) == 1
    assert len(re.findall(r"\) Scan parquet.*\nOutput.*\n.*\n.*Location: InMemoryFileIndex \[[^\]]+/w\]", text)) <= 1
