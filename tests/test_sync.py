import datetime as dt
import re
import uuid

import pytest
from pyspark.sql import functions as F

from lakeweave import contracts
from lakeweave.sinks import export, ledger, quarantine, tables
from lakeweave.streaming import sync

T0 = dt.datetime(2023, 1, 1)
KEYS = ["time", "zone"]


def reading(hour, zone="A", temp=1.0, direction=5):
    return (T0 + dt.timedelta(hours=hour), zone, temp, 1.0, 0.0, 0.0, 0.0, 1.0, direction)


def metrics(spark, *data):
    return spark.createDataFrame(list(data), contracts.WEATHER_METRICS)


@pytest.fixture
def table(spark):
    name = f"metrics_{uuid.uuid4().hex}"
    tables.ensure_table(spark, name, contracts.WEATHER_METRICS, "time")
    tables.ensure_table(spark, name, contracts.WEATHER_METRICS, "time")
    return name


def test_insert_ignore_twice_loads_once(spark, table):
    source = metrics(spark, reading(1), reading(1, temp=9.0), reading(2), reading(30))
    tables.insert_ignore(source, table, KEYS, "time")
    assert spark.table(table).count() == 3
    tables.insert_ignore(source, table, KEYS, "time")
    assert spark.table(table).count() == 3
    assert spark.table(table).select("day").distinct().count() == 2


def test_null_keys_never_conflict(spark, rows):
    sink = metrics(spark, reading(1, None), reading(2))
    source = metrics(spark, reading(1, None), reading(1, None), reading(2), reading(3, temp=None, direction=None))
    got = tables.new_rows(source, sink, KEYS, time="time")
    assert got.filter("zone IS NULL").count() == 2
    assert rows(got.filter("zone IS NOT NULL"), "time", "temp") == [(T0 + dt.timedelta(hours=3), None)]


def test_chunk_takes_the_first_hour_and_a_full_day(spark):
    source = metrics(spark, *[reading(h) for h in range(60)])
    empty = source.limit(0)
    chunk = sync.incremental_chunk(source, empty, "time")
    assert [r.time.hour for r in chunk.collect()][:2] == [0, 1] and chunk.count() == 24
    after = sync.incremental_chunk(source, chunk, "time")
    assert after.agg(F.min("time"), F.max("time")).first() == (T0 + dt.timedelta(hours=24), T0 + dt.timedelta(hours=47))


def test_chunk_bounds_are_pushed_to_the_scan(spark, tmp_path):
    metrics(spark, *[reading(h) for h in range(60)]).write.parquet(str(tmp_path / "s"))
    source = spark.read.parquet(str(tmp_path / "s"))
    chunk = sync.incremental_chunk(source, source.filter("time < '2023-01-02'"), "time")
    text = spark._jvm.PythonSQLUtils.explainString(chunk._jdf.queryExecution(), "formatted")
    assert re.search(r"GreaterThan\(time,ScalarSubquery#\d+\), LessThanOrEqual\(time,ScalarSubquery", text)


def test_gap_and_end(spark):
    source = metrics(spark, reading(0), reading(100), reading(101))
    first = source.filter(F.col("time") <= F.lit(T0))
    assert [r.time for r in sync.incremental_chunk(source, first, "time").collect()] == [T0 + dt.timedelta(hours=100)]
    assert sync.incremental_chunk(source, source, "time").count() == 0


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_chunks_until_empty_give_the_source(spark, table, rows, zone):
    # Hours around the November change, when a local hour repeats.
    start = dt.datetime(2023, 11, 4, 20, tzinfo=dt.timezone.utc)
    hours = [*range(60), 120, 121]
    data = [(start + dt.timedelta(hours=h), z, float(h), 1.0, 0.0, 0.0, 0.0, 1.0, 1) for h in hours for z in ("A", "B")]
    source = spark.createDataFrame(data, contracts.WEATHER_METRICS)
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        chunks = sync.sync_all(source, table, KEYS, "time", default="2023-11-04 00:00:00")
        assert chunks == 6  # 24 h each, then the jump over the gap and what follows it
        loaded = spark.table(table)
        assert rows(loaded.select(F.unix_micros("time"), "zone", "temp")) == rows(source.select(F.unix_micros("time"), "zone", "temp"))
        assert sync.sync_once(source, table, KEYS, "time") is False
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_sessions_in_two_zones_share_a_table(spark, table, tmp_path):
    start = dt.datetime(2023, 12, 31, 12, tzinfo=dt.timezone.utc)
    data = [(start + dt.timedelta(hours=h), "A", 1.0, 1.0, 0.0, 0.0, 0.0, 1.0, 1) for h in range(30)]
    source = spark.createDataFrame(data, contracts.WEATHER_METRICS).withColumn("year", F.year("time"))
    source.write.partitionBy("year").parquet(str(tmp_path / "s"))  # years of this session's zone
    stored = spark.read.parquet(str(tmp_path / "s"))
    for zone in ("Asia/Tokyo", "America/Los_Angeles", "UTC"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            sync.sync_all(stored, table, KEYS, "time", year="year", default="2023-01-01 00:00:00",
                          prepare=lambda df: df.drop("year"))
            tables.insert_ignore(stored.drop("year"), table, KEYS, "time")
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert spark.table(table).count() == 30
    assert spark.table(table).select("day").distinct().count() == 2


def test_weather_to_metrics_names(spark):
    data = [(20230101, T0, "A", 0, 2023, 1, 1, 1.0, 2.0, None, 4.0, 5.0, 6.0, None)]
    got = sync.to_metrics(spark.createDataFrame(data, contracts.SILVER_WEATHER))
    assert got.schema.names == contracts.WEATHER_METRICS.names
    assert tuple(got.first())[1:] == ("A", 1.0, 2.0, None, 4.0, 5.0, 6.0, None)


def test_stream_restarts_and_equals_batch(spark, rows, tmp_path):
    folder, target, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    parts = [metrics(spark, reading(1), reading(2), reading(2, temp=5.0), reading(4, None)),
             metrics(spark, reading(2), reading(3), reading(4, None))]
    for df in parts:
        df.coalesce(1).write.mode("append").parquet(folder)
        stream = sync.file_stream(spark, folder, contracts.WEATHER_METRICS, files_per_batch=1)
        sync.start_sync(stream, target, KEYS, "time", state).awaitTermination()
    loaded = sync.read_synced(spark, target, contracts.WEATHER_METRICS)
    both = parts[0].unionByName(parts[1])
    assert rows(loaded, "time", "zone") == rows(tables.new_rows(both, both.limit(0), KEYS), "time", "zone")


def test_repeated_batch_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "sink")
    batch = metrics(spark, reading(1), reading(2, None))
    for _ in range(2):
        sync.load_batch(batch, 0, path, KEYS, "time", "a")
    sync.load_batch(batch, 1, path, KEYS, "time", "a")
    sync.load_batch(batch, 0, path, KEYS, "time", "b")
    loaded = sync.read_synced(spark, path, contracts.WEATHER_METRICS)
    assert loaded.filter("zone IS NOT NULL").count() == 1 and loaded.filter("zone IS NULL").count() == 3


def test_two_checkpoints_lose_no_row(spark, rows, tmp_path):
    target = str(tmp_path / "out")
    for n in (1, 2):
        metrics(spark, reading(n), reading(5)).coalesce(1).write.parquet(str(tmp_path / f"in{n}"))
        stream = sync.file_stream(spark, str(tmp_path / f"in{n}"), contracts.WEATHER_METRICS)
        sync.start_sync(stream, target, KEYS, "time", str(tmp_path / f"state{n}")).awaitTermination()
    hours = lambda df: sorted(r.time for r in df.collect())
    want = [T0 + dt.timedelta(hours=h) for h in (1, 2, 5)]
    assert hours(sync.read_synced(spark, target, contracts.WEATHER_METRICS)) == want
    sync.compact_synced(spark, target, str(tmp_path / "whole"), contracts.WEATHER_METRICS)
    assert hours(sync.read_synced(spark, str(tmp_path / "whole"), contracts.WEATHER_METRICS)) == want


def test_null_times_are_refused(spark, table):
    bad = metrics(spark, reading(1)).withColumn("time", F.when(F.lit(False), F.col("time")))
    with pytest.raises(Exception, match="time must not be null"):
        tables.insert_ignore(bad, table, KEYS, "time")
    assert spark.table(table).count() == 0


def test_search_for_the_next_time_is_bounded(spark, tmp_path):
    metrics(spark, reading(0), reading(30)).write.parquet(str(tmp_path / "s"))
    source = spark.read.parquet(str(tmp_path / "s"))
    row = sync._upcoming(source, "time", F.lit(T0), "24 hours", None, within=True)
    text = spark._jvm.PythonSQLUtils.explainString(row._jdf.queryExecution(), "formatted")
    assert re.search(r"PushedFilters: \[.*GreaterThan\(time.*LessThanOrEqual\(time", text)
    assert row.first().next is None


def test_error_table_only_with_errors(spark, rows):
    df = spark.createDataFrame([(1, "5"), (2, "x"), (3, None)], "id int, v string")
    good, bad = quarantine.split(df, {"v": "int"}, ["id"])
    assert rows(good) == [(1, 5), (3, None)]
    assert rows(bad) == [(2, "v: cannot read 'x' as int")]
    name = f"q_{uuid.uuid4().hex}"
    assert quarantine.save_errors(bad, name) and spark.table(f"{name}_errors").count() == 1
    assert not quarantine.save_errors(bad.limit(0), f"{name}2")
    assert not spark.catalog.tableExists(f"{name}2_errors")


def test_json_array(spark, tmp_path):
    import json
    df = spark.sql("SELECT date'2023-09-01' + cast(id as int) AS DateKey, cast(null AS string) AS z, id FROM range(150)")
    export.export_json(df, str(tmp_path / "j"), ["DateKey"], 100)
    data = json.loads(spark.read.text(str(tmp_path / "j")).first()[0])
    assert len(data) == 100 and data[0] == {"DateKey": "2023-09-01", "z": None, "id": 0} and data[-1]["id"] == 99
    assert json.loads(export.json_array(df.limit(0), ["DateKey"]).first()[0]) == []


def test_partitioned_table_is_replaced(spark):
    name = f"w_{uuid.uuid4().hex}"
    for base in (0, 10):
        tables.save_table(spark.range(base, base + 4).selectExpr("id", "id % 2 AS year"), name, ["year"])
    assert sorted(r.id for r in spark.table(name).collect()) == [10, 11, 12, 13]
    tables.save_gold(spark.createDataFrame([(2020, 5.0)], "YearKey int, GDP_Value double"), f"{name}_g", contracts.DIM_GDP)
    assert [f.dataType for f in spark.table(f"{name}_g").schema] == [f.dataType for f in contracts.DIM_GDP]


# Several writers -----------------------------------------------------------------


def loaded(spark, path):
    return sorted((r.time, r.zone or "") for r in sync.read_synced(spark, path, contracts.WEATHER_METRICS).collect())


def test_a_writer_that_is_overtaken_looks_again(spark, tmp_path, monkeypatch):
    """Another load commits after this one has looked for its keys and before it commits."""
    path, real, overtaken = str(tmp_path / "sink"), ledger.Ledger.commit, []
    first = metrics(spark, reading(1), reading(2), reading(3, None))
    other = metrics(spark, reading(2, temp=9.0), reading(4), reading(3, None))

    def commit(self, version, folder, loads):
        if not overtaken:
            overtaken.append(True)
            sync.load_batch(other, 0, path, KEYS, "time", "b")
        return real(self, version, folder, loads)

    monkeypatch.setattr(ledger.Ledger, "commit", commit)
    sync.load_batch(first, 0, path, KEYS, "time", "a")
    assert loaded(spark, path) == sorted((T0 + dt.timedelta(hours=h), z) for h, z in [(1, "A"), (2, "A"), (4, "A"), (3, ""), (3, "")])
    sink = ledger.Ledger(spark, path, contracts.WEATHER_METRICS)
    assert [c.loads for c in sink.commits()] == [("b-0",), ("a-0",)]
    assert sink.sweep() == 1 and len(loaded(spark, path)) == 5 and sink.sweep() == 0
    for _ in range(2):  # both are listed
        sync.load_batch(first, 0, path, KEYS, "time", "a")
        sync.load_batch(other, 0, path, KEYS, "time", "b")
    assert len(sink.commits()) == 2


def test_writers_at_once_give_each_key_once(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor
    path = str(tmp_path / "sink")
    loads = [metrics(spark, *[reading(h, temp=float(n)) for h in range(n, n + 30)]) for n in range(5)]
    with ThreadPoolExecutor(5) as pool:
        list(pool.map(lambda n: sync.load_batch(loads[n], 0, path, KEYS, "time", f"w{n}"), range(5)))
    assert loaded(spark, path) == [(T0 + dt.timedelta(hours=h), "A") for h in range(34)]
    assert [c.version for c in ledger.Ledger(spark, path, contracts.WEATHER_METRICS).commits()] == list(range(5))


def test_a_load_that_dies_does_not_show(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "sink")
    sync.load_batch(metrics(spark, reading(1)), 0, path, KEYS, "time", "a")
    monkeypatch.setattr(ledger.Ledger, "commit", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        sync.load_batch(metrics(spark, reading(2)), 1, path, KEYS, "time", "a")
    monkeypatch.undo()
    assert len(loaded(spark, path)) == 1
    sync.load_batch(metrics(spark, reading(2)), 1, path, KEYS, "time", "a")
    assert len(loaded(spark, path)) == 2


def test_two_streams_at_once(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    for part in range(3):
        metrics(spark, *[reading(h) for h in range(part * 10, part * 10 + 15)]).coalesce(1).write.mode("append").parquet(source)
    for _ in range(2):  # started again, they add nothing
        running = [sync.start_sync(sync.file_stream(spark, source, contracts.WEATHER_METRICS, files_per_batch=1), target, KEYS, "time",
                                   str(tmp_path / f"state{n}")) for n in range(2)]
        for query in running:
            query.awaitTermination()
        assert loaded(spark, target) == [(T0 + dt.timedelta(hours=h), "A") for h in range(35)]
    whole = str(tmp_path / "whole")
    sync.compact_synced(spark, target, whole, contracts.WEATHER_METRICS)
    known = ledger.Ledger(spark, target, contracts.WEATHER_METRICS).commits()
    merged = ledger.Ledger(spark, whole, contracts.WEATHER_METRICS).commits()
    assert loaded(spark, whole) == loaded(spark, target)
    assert [set(c.loads) for c in merged] == [{load for c in known for load in c.loads}]
    with pytest.raises(ValueError):
        sync.compact_synced(spark, target, whole, contracts.WEATHER_METRICS)


def test_a_file_is_created_once(spark, tmp_path):
    path = f"{tmp_path}/list/1.json"
    assert ledger.create_new(spark, path, "a") and not ledger.create_new(spark, path, "b")
    assert open(path).read() == "a" and [p.name for p in (tmp_path / "list").iterdir() if not p.name.endswith(".crc")] == ["1.json"]
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    (tmp_path / "list" / "2").write_text("c")
    (tmp_path / "list" / "3").write_text("d")
    at = lambda n: hadoop(f"file://{tmp_path}/list/{n}")
    ledger.move_new(spark, at(2), at(4))
    with pytest.raises(FileExistsError):
        ledger.move_new(spark, at(3), at(4))


# All chunks at once ---------------------------------------------------------------


def greedy(times, low, span):
    """Chunks one after another, as ``sync_once`` cuts them."""
    out, times = [], sorted(times)
    while times:
        high = max(low + span, times[0])
        out.append((low, high))
        own = [t for t in times if t <= high]
        low, times = own[-1], times[len(own):]
    return out


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_bounds_of_all_chunks(spark, kind):
    import random
    rng = random.Random(3)
    hours = sorted({rng.randrange(24 * 40) for _ in range(300)} | {2000, 2001, 2050})
    times = [T0 + dt.timedelta(hours=h) for h in hours]
    source = spark.createDataFrame([(t,) for t in times], "time timestamp").select(F.col("time").cast(kind))
    got = [(r.low.replace(tzinfo=None), r.high.replace(tzinfo=None)) for r in
           sync.chunk_bounds(source, source.limit(0), "time").orderBy("chunk").collect()]
    assert got == greedy(times, T0 - dt.timedelta(microseconds=1), dt.timedelta(hours=24))
    assert sync.chunk_bounds(source, source, "time").count() == 0
    assert sync.chunk_bounds(source.limit(0), source.limit(0), "time").count() == 0


def test_rows_of_an_hour_stay_in_one_chunk(spark):
    times = [T0 + dt.timedelta(minutes=m) for m in (0, 20, 50, 59, 60, 61, 119, 500, 505)]
    source = spark.createDataFrame([(t,) for t in times], "time timestamp")
    bounds = sync.chunk_bounds(source, source.limit(0), "time", span="30 minutes").orderBy("chunk").collect()
    own = [[t for t in times if b.low < t <= b.high] for b in bounds]
    assert [t for part in own for t in part] == times and [len(p) for p in own] == [4, 3, 2]


@pytest.mark.parametrize("per_load", [None, 2])
def test_chunks_in_steps_give_the_same_rows(spark, table, rows, per_load):
    source = metrics(spark, *[reading(h, z, float(h)) for h in [*range(60), 120, 121] for z in ("A", None)])
    assert sync.sync_all(source, table, KEYS, "time", default="2023-01-01 00:00:00", chunks_per_load=per_load) == 5
    assert rows(spark.table(table).drop("day"), "time", "zone", "temp") == rows(source, "time", "zone", "temp")
    assert sync.sync_all(source, table, KEYS, "time") == 0


def test_a_thousand_chunks_take_few_jobs(spark, table):
    source = spark.range(1000).select((F.lit(T0).cast("timestamp") + F.make_interval(hours=F.col("id").cast("int") * 2)).alias("time"),
                                      F.lit("A").alias("zone"), *[F.lit(1.0).cast(f.dataType).alias(f.name) for f in contracts.WEATHER_METRICS[2:]])
    spark.sparkContext.setJobGroup("chunks", "chunks")
    try:
        assert sync.sync_all(source, table, KEYS, "time", span="1 hour") == 1000
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("chunks")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) < 30 and spark.table(table).count() == 1000
