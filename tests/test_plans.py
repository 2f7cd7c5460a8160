"""What the physical plans must show, and keys that hold a third of all rows."""

import re

import pytest
from pyspark.sql import functions as F

from lakeweave import contracts
from lakeweave.catalog import QUERIES
from lakeweave.functions import predicates
from lakeweave.operators import dedupe, joins, series
from lakeweave.plans import silver, suites
from lakeweave.sinks import tables

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture
def events(spark):
    return spark.read.parquet(f"{FOLDER}/events.parquet")


@pytest.fixture
def stored(spark, tmp_path):
    """An empty stored table of a contract, so that plans start at a scan."""
    def make(name):
        path = str(tmp_path / name)
        spark.createDataFrame([], getattr(contracts, name)).write.parquet(path)
        return spark.read.parquet(path)
    return make


def test_flagship_is_a_pruned_pushed_top_k(spark):
    text = plan(QUERIES["hourly_revenue_top100"](spark, FOLDER))
    assert "TakeOrderedAndProject" in text
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(ts", text)
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in text
    assert text.count("Exchange") <= 4  # one exchange, named in the tree and in the details


def test_year_ranges_reach_the_scan(events):
    text = plan(events.filter(predicates.years_in(F.col("ts"), [2023, 2024])))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(ts.*LessThan\(ts", text)


def test_small_lookup_is_broadcast_without_a_hint(stored):
    lookup = stored("ZONE_LOOKUP")
    text = plan(silver.taxi(stored("BRONZE_TAXI"), lookup))
    assert "BroadcastHashJoin LeftOuter" in text and "SortMergeJoin" not in text
    assert len(re.findall(r"\) Exchange\n", text)) == 1  # the deduplication only
    assert "vendorid" not in text and "tip_amount" not in text


def test_large_lookup_is_shuffled(spark, events):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        text = plan(joins.lookup(events, events.select("event_id", "props"), "user_id", "event_id", {"props": "p"}))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin LeftOuter" in text


def test_checked_dimension_stays_splittable(spark, events):
    """No aggregate stands between the dimension's exchange and the join."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(joins.many_to_one(events, events.select("event_id", "props"), "user_id", "event_id", {"props": "p"}))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    tree = text.split("\n\n")[0]
    join = tree[tree.index("SortMergeJoin"):]
    assert re.match(r"SortMergeJoin LeftOuter.*?:- (\* )?Sort.*?Exchange.*?\+- (\* )?Sort.*?Exchange", join, re.S)
    assert "Aggregate" not in join


def test_no_cross_join_or_python_in_any_query(spark):
    writing = {"append_table", "overwrite_schema", "contract_save", "csv_roundtrip", "csv_inferred", "export_lines",
               "error_table", "month_paths", "partitioned_write", "sync_chunk_load", "stream_sync",
               "stream_two_checkpoints", "stream_two_writers", "json_files", "page_files"}
    for name in sorted(set(QUERIES) - writing):
        text = plan(QUERIES[name](spark, FOLDER))
        for word in ("CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "RDDScan"):
            assert word not in text, (name, word)


def test_suite_reads_the_table_at_most_twice(stored):
    """Once for all checks and statistics, once more for the examples."""
    text = plan(suites.taxi_suite().evaluate(stored("SILVER_TAXI")))
    assert 2 <= text.count("Scan parquet") <= 4  # each scan stands in the tree and in the details


def test_examples_are_limited_before_the_exchange(stored):
    text = plan(suites.taxi_suite().evaluate(stored("SILVER_TAXI")))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_insert_ignore_reads_only_the_days_of_the_batch(spark, tmp_path, events):
    path = str(tmp_path / "sink")
    rows = events.select("ts", "user_id", "value", F.to_date("ts").alias("day"))
    tables.write_parquet(rows, path, ["day"])
    sink = spark.read.parquet(path)
    batch = rows.drop("day").filter(F.col("ts") >= F.lit("2024-01-28"))
    fresh = tables.new_rows(batch, sink, ["ts", "user_id"], "ts", "day")
    assert re.search(r"PartitionFilters: \[.*day.*Subquery", plan(fresh))
    assert fresh.count() == 0


# Skew ---------------------------------------------------------------------------


def hot(spark, n=30_000):
    """A third of the rows share one key, a third share a null key."""
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(
        F.concat(F.lit("k"), (F.col("id") % 500).cast("string")))
    return spark.range(0, n, 1, 8).select(key.alias("k"), "id", (F.col("id") % 10).alias("v"))


def test_hot_keys_are_combined_before_the_shuffle(spark):
    tree = plan(dedupe.first_by_key(hot(spark), ["k"])).split("\n\n")[0]
    assert tree.index("Aggregate") < tree.index("Exchange") < tree.rindex("Aggregate")
    assert dedupe.first_by_key(hot(spark), ["k"]).count() == hot(spark).select("k").distinct().count()


def test_copies_collapse_before_an_insert_joins(spark):
    source = hot(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tree = plan(tables.new_rows(source, source.filter("v = 1").withColumnRenamed("id", "other"), ["k"])).split("\n\n")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "LeftAnti" not in tree
    assert tree.index("SortMergeJoin LeftOuter") < tree.index("Aggregate") < tree.index("Exchange")


def test_null_keys_skip_the_shuffle_of_an_insert(spark):
    source = hot(spark)
    sink = source.filter("k = 'hot'")
    fresh = tables.new_rows(source, sink, ["k"])
    assert fresh.filter("k IS NULL").count() == 10_000
    assert fresh.filter("k = 'hot'").count() == 0
    assert fresh.filter("k IS NOT NULL").count() == source.filter("k LIKE 'k%'").select("k").distinct().count()
    tree = plan(fresh).split("\n\n")[0]
    assert "Exchange" not in tree[tree.rindex("\n   +- "):]  # the last branch holds the null keys


def test_skewed_lookup_is_split_and_whole(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        facts = hot(spark).withColumn("pad", F.sha2(F.col("id").cast("string"), 256))
        dims = facts.filter("k IS NOT NULL").select("k").distinct().collect()
        dimension = spark.createDataFrame([(r.k, r.k.upper()) for r in dims], "dk string, name string").repartition(8)
        joined = joins.many_to_one(facts, dimension, "k", "dk", {"name": "name"})
        joined.write.format("noop").mode("overwrite").save()
        assert joined.count() == 30_000
        assert joined.filter("name = 'HOT'").count() == 10_000
        collected = joined.select("id", "name", "pad")
        collected.collect()
        assert "skew=true" in collected._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_series_shuffles_one_row_per_day(spark):
    observed = hot(spark).filter("k IS NOT NULL").select(
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 7).cast("int")).alias("d"), "k",
        F.when(F.col("v") < 5, F.col("v").cast("double")).alias("v"))
    bounds = [F.lit(x).cast("date") for x in ("2020-01-01", "2020-01-10")]
    filled = series.forward_fill(observed, ["k"], "d", "v", *bounds)
    text = plan(filled)
    window_input = text[text.index("Window"):]
    assert "Aggregate" in window_input
    got = filled.filter("k = 'hot'").groupBy("d").count().collect()
    expected = observed.filter("k = 'hot'").groupBy("d").count().collect()
    assert {r.d: r["count"] for r in got if r.d.day <= 7} == {r.d: r["count"] for r in expected}
