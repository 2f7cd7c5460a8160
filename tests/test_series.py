import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeweave.operators import aggregates, series
from lakeweave.sources import nested

SCHEMA = "k string, d date, v decimal(10,4)"


def day(text):
    return F.lit(text).cast("date")


def naive_fill(observed, first, last):
    """Spine, left join and window, as the definition says."""
    days = observed.sparkSession.sql(f"SELECT explode(sequence(date'{first}', date'{last}')) AS d")
    spine = days.crossJoin(observed.select("k").distinct())
    window = W.partitionBy("k").orderBy("d", F.asc_nulls_last("v")).rowsBetween(W.unboundedPreceding, 0)
    return (spine.join(observed, ["d", "k"], "left")
            .withColumn("v", F.last("v", ignorenulls=True).over(window)).filter("v IS NOT NULL").select("d", "k", "v"))


@pytest.mark.parametrize("seed", range(4))
def test_forward_fill_equals_its_definition(spark, rows, seed):
    rnd = random.Random(seed)
    start = dt.date(2020, 1, 1)
    data = [(rnd.choice(["a", "a", "a", "b", "c", None]), start + dt.timedelta(days=rnd.randrange(40)),
             None if rnd.random() < 0.35 else Decimal(rnd.randrange(50)) / 10) for _ in range(120)]
    observed = spark.createDataFrame(data, SCHEMA)
    got = series.forward_fill(observed, ["k"], "d", "v", day("2020-01-06"), day("2020-02-03"))
    assert rows(got) == rows(naive_fill(observed, "2020-01-06", "2020-02-03"))


def test_one_row_per_day_from_the_first_value(spark, rows):
    observed = spark.createDataFrame([("p", dt.date(2020, 1, 3), Decimal("1.1")), ("p", dt.date(2020, 1, 4), None),
                                      ("p", dt.date(2020, 1, 1), None)], SCHEMA)
    got = rows(series.forward_fill(observed, ["k"], "d", "v", day("2020-01-01"), day("2020-01-06")))
    assert [r[0].day for r in got] == [3, 4, 5, 6]
    assert {r[2] for r in got} == {Decimal("1.1000")}


def test_many_copies_of_a_null_observation_all_stay(spark, monkeypatch):
    monkeypatch.setattr(series, "COPIES_PER_CHUNK", 7)
    first = dt.date(2020, 1, 1)
    data = [("hot", first, Decimal(1))] + [("hot", first, None)] * 50 + [("hot", first + dt.timedelta(2), None)] * 14
    got = series.forward_fill(spark.createDataFrame(data, SCHEMA), ["k"], "d", "v", day("2020-01-01"), day("2020-01-04"))
    assert [tuple(r) for r in got.groupBy("d").count().orderBy("d").collect()] == [
        (first, 51), (dt.date(2020, 1, 2), 1), (dt.date(2020, 1, 3), 14), (dt.date(2020, 1, 4), 1)]


def test_calendar_has_both_ends(spark):
    assert series.calendar(spark, "1999-01-04", "2026-04-30").count() == 9979
    assert series.calendar(spark, "2020-01-02", "2020-01-01").count() == 0


def test_explode_series_end_is_exclusive(spark, rows):
    df = spark.createDataFrame([("z", 0, 7200, 3600, [1.0, 2.0]), ("empty", 50, 50, 10, [])],
                               "zone string, s bigint, e bigint, step int, a array<double>")
    got = nested.explode_series(df, "s", "e", "step", ["a"])
    assert [(r.date.hour, r.zone, r.a) for r in got.orderBy("date").collect()] == [(0, "z", 1.0), (1, "z", 2.0)]


def test_explode_series_keeps_both_autumn_hours(spark):
    # 2023-11-05, 01:30 happens twice in New York.
    df = spark.createDataFrame([("z", 1699162200, 1699169400, 3600, [1.0, 2.0])],
                               "zone string, s bigint, e bigint, step int, a array<double>")
    got = nested.explode_series(df, "s", "e", "step", ["a"])
    local = F.convert_timezone(F.lit("UTC"), F.lit("America/New_York"), F.col("date").cast("timestamp_ntz"))
    assert got.select("date").distinct().count() == 2
    assert got.select(local).distinct().count() == 1


@pytest.mark.parametrize("data", [[5.0], [1.0, 2.0], list(range(101)), [7.0] * 60 + [1.0, 9.0], [None, 3.0, 1.0]])
def test_percentiles_are_exact(spark, data):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in data], "v double")
    wanted = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {r.p: r.value for r in aggregates.percentiles(df, "v", wanted).collect()}
    expected = df.select(F.percentile("v", F.array(*[F.lit(p) for p in wanted]))).first()[0]
    assert [got[p] for p in wanted] == pytest.approx(expected)


def test_percentiles_of_a_skewed_column(spark):
    df = spark.range(20000).select(F.when(F.col("id") % 3 == 0, F.lit(42.0)).otherwise(F.hash("id") % 1000 / 7.0).alias("v"))
    got = {r.p: r.value for r in aggregates.percentiles(df, "v", [0.25, 0.5, 0.75]).collect()}
    expected = df.select(F.percentile("v", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))).first()[0]
    assert [got[0.25], got[0.5], got[0.75]] == pytest.approx(expected)


def test_a_slice_of_the_values_spans_many_tasks(spark):
    """What was one task's slice, a part in 128 of the values, is several ranges now, and the plan sorts few of them."""
    df = spark.range(60_000).select((F.hash("id") / 7.0).alias("v"))
    settings = {"spark.sql.shuffle.partitions": "512", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        held = sorted(r["count"] for r in aggregates.value_ranges(df, "v").groupBy("range").count().collect())
        assert len(held) > 450 and held[-1] < 60_000 / 128 / 2
        got = {r.p: r.value for r in aggregates.percentiles(df, "v", [0.0, 0.25, 0.5, 0.75, 1.0]).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    expected = df.select(F.percentile("v", F.array(*[F.lit(p) for p in (0.0, 0.25, 0.5, 0.75, 1.0)]))).first()[0]
    assert [got[p] for p in (0.0, 0.25, 0.5, 0.75, 1.0)] == pytest.approx(expected)


def test_text_lists_and_rows_hold_every_group(spark):
    rows = spark.range(12_000).select(F.col("id").cast("string").alias("g"), F.col("id").alias("v"))
    text = aggregates.one_text(rows, "g", {"t": (F.col("g"), ",")})
    assert len(text.first()[0].split(",")) == 12_000
    values = aggregates.group_values(rows, "g", {"top": F.max("v"), "n": F.count("v")})
    assert values.count() == 24_000 and values.filter("name = 'top' AND value = `group`").count() == 12_000


def test_a_text_says_that_there_are_more(spark):
    rows = spark.range(12_000).select(F.format_string("%05d", "id").alias("g"))
    text = lambda df: aggregates.one_text(df, "g", {"t": (F.col("g"), ",")}, most=1000).first()[0].split(",")
    assert text(rows) == [f"{i:05d}" for i in range(1000)] + ["..."]
    assert text(rows.filter("g < '01000'"))[-1] == "00999" and text(rows.limit(0)) == [""]


def test_values_are_carried_across_ranges(spark, rows):
    rng = random.Random(4)
    start = dt.datetime(1969, 12, 31, 20)
    data = [(i, rng.choice(["hot", "hot", "hot", "b", None]), rng.choice([None] + [start + dt.timedelta(seconds=rng.randrange(40_000)) for _ in range(9)]),
             rng.choice([None, None, None, rng.randrange(50)])) for i in range(800)]
    data += [(900 + i, "early", start, v) for i, v in enumerate((None, 3, 5, None))] + [(950, "alone", start, None)]
    last, want = {}, []
    for i, key, time, value in sorted(data, key=lambda r: (r[2] is None, r[2] or start, r[3] is None, r[3] or 0)):
        if time is not None:
            last[key] = value = last.get(key) if value is None else value
        want.append((i, key, time, value))
    df = spark.createDataFrame(data, "id long, `a.key` string, time timestamp_ntz, `__value` long")
    for span in (60, 3600, 10**6):
        assert rows(series.carry_forward(df, ["a.key"], "time", "__value", span)) == sorted(want, key=repr)
    assert series.carry_forward(df.limit(0), ["a.key"], "time", "__value").collect() == []


def test_one_key_is_filled_by_many_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(40_000).select(F.lit("hot").alias("k"), F.timestamp_seconds(F.col("id") * 9).alias("t"),
                                        F.when(F.col("id") % 1000 == 0, F.col("id")).alias("v"))
        got = series.carry_forward(df, ["k"], "t", "v", span_seconds=600).filter("v % 1000 = 0")
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id().alias("p")).count().orderBy(F.desc("count")).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    filled = [n for n in sizes if n > 1000]
    assert sum(sizes) == 40_000 and len(filled) > 2 and filled[0] < 2 * sorted(filled)[len(filled) // 2]
