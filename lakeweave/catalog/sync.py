"""Insert-ignore, incremental chunks and the streaming sync on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeweave.catalog.io import fresh_name
from lakeweave.catalog.registry import query
from lakeweave.contracts import schema
from lakeweave.session import scratch_dir
from lakeweave.sinks import tables as sinks
from lakeweave.sources import tables as sources
from lakeweave.streaming import sync

READING = schema("""
    time timestamp
    zone string
    amount double
""")


def hourly(t):
    """Many readings per hour and type, those of clicks without a type."""
    return t("events").select(F.date_trunc("hour", "ts").alias("time"),
                              F.nullif(F.col("event_type"), F.lit("click")).alias("zone"),
                              F.col("value").alias("amount"))


HOURLY = """
src AS (SELECT date_trunc('hour', ts) AS time, nullif(event_type, 'click') AS zone, value AS amount FROM events),
sink AS (SELECT * FROM src WHERE time < TIMESTAMP '2024-01-11')
"""
CLOCK = "strftime(time, '%Y-%m-%d %H:%M:%S.%f') AS time"


@query(f"""
WITH {HOURLY}
SELECT {CLOCK}, zone, amount FROM src WHERE zone IS NULL
UNION ALL
SELECT {CLOCK}, zone, min(amount) FROM src
WHERE zone IS NOT NULL AND NOT EXISTS (SELECT 1 FROM sink WHERE sink.time = src.time AND sink.zone = src.zone)
GROUP BY src.time, zone
""".replace(f"SELECT {CLOCK}, zone, min", "SELECT strftime(src.time, '%Y-%m-%d %H:%M:%S.%f') AS time, zone, min"))
def insert_ignore(t):
    source = hourly(t)
    sink = source.filter(F.col("time") < F.lit("2024-01-11"))
    return sinks.new_rows(source, sink, ["time", "zone"], time="time")


CHUNK = """
SELECT event_id, value, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM events
WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-11')
  AND ts <= (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-11') + INTERVAL 24 HOUR
"""


@query(CHUNK)
def incremental_chunk(t):
    events = t("events").select("event_id", "ts", "value")
    return sync.incremental_chunk(events, events.filter(F.col("ts") < F.lit("2024-01-11")), "ts")


@query("""
SELECT 'empty sink' AS sink, count(*) AS n, CAST(min(event_id) AS DOUBLE) AS first_id, CAST(max(event_id) AS DOUBLE) AS last_id
FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-06'
UNION ALL
SELECT 'before a gap', count(*), min(event_id), max(event_id) FROM events WHERE ts = (SELECT min(ts) FROM events)
UNION ALL
SELECT 'caught up', 0, NULL, NULL
""")
def incremental_edges(t):
    """No sink rows yet, a gap longer than the span, and nothing left to load."""
    events = t("events").select("event_id", "ts")
    old = t("events").agg((F.min("ts") - F.expr("interval 60 days")).alias("ts"))
    cases = {"empty sink": events.filter("false"), "before a gap": old, "caught up": events}
    parts = [sync.incremental_chunk(events, sink, "ts", default="2024-01-05 00:00:00").agg(
        F.lit(label).alias("sink"), F.count(F.lit(1)).alias("n"), F.min("event_id").cast("double").alias("first_id"),
        F.max("event_id").cast("double").alias("last_id")) for label, sink in cases.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("SELECT max(strftime(ts, '%Y-%m-%d %H:%M:%S.%f')) AS watermark FROM events")
def high_watermark(t):
    return sources.high_watermark(t("events"), "ts", F.lit("2023-01-01").cast("timestamp_ntz"))


LOADED = f"""
WITH {HOURLY}
SELECT {CLOCK}, zone, min(amount) AS amount FROM src WHERE zone IS NOT NULL GROUP BY src.time, zone
UNION ALL SELECT {CLOCK}, zone, amount FROM src WHERE zone IS NULL
"""


LOADED = LOADED.replace(f"SELECT {CLOCK}, zone, min", "SELECT strftime(src.time, '%Y-%m-%d %H:%M:%S.%f') AS time, zone, min")


@query(LOADED)
def sync_chunk_load(t):
    """Ten-day chunks into a table made on the spot, until the source is used up."""
    name, path = fresh_name("sync"), scratch_dir(t.spark, "sync")
    sinks.ensure_table(t.spark, name, READING, "time", path=path)
    source = hourly(t).withColumn("time", F.col("time").cast("timestamp"))
    sync.sync_all(source, name, ["time", "zone"], "time", span="10 days", default="2024-01-01 00:00:00")
    return sources.table(t.spark, name).drop("day")


@query(LOADED)
def stream_sync(t):
    """The same load as a stream, run twice from one checkpoint."""
    target, checkpoint = scratch_dir(t.spark, "stream"), scratch_dir(t.spark, "stream-state")
    events = t("events").schema
    for _ in range(2):
        incoming = sync.file_stream(t.spark, t.folder, events, "events*.parquet")
        readings = incoming.select(F.date_trunc("hour", "ts").cast("timestamp").alias("time"),
                                   F.nullif(F.col("event_type"), F.lit("click")).alias("zone"),
                                   F.col("value").alias("amount"))
        sync.start_sync(readings, target, ["time", "zone"], "time", checkpoint).awaitTermination()
    return sync.read_synced(t.spark, target, READING)


@query(LOADED)
def stream_two_checkpoints(t):
    """Two streams, each with a checkpoint of its own, into one sink: even hours, then odd ones."""
    target = scratch_dir(t.spark, "stream")
    for half in (0, 1):
        folder = scratch_dir(t.spark, "half")
        t("events").filter(F.hour("ts") % 2 == half).write.parquet(folder)
        incoming = sync.file_stream(t.spark, folder, t("events").schema)
        readings = incoming.select(F.date_trunc("hour", "ts").cast("timestamp").alias("time"),
                                   F.nullif(F.col("event_type"), F.lit("click")).alias("zone"),
                                   F.col("value").alias("amount"))
        sync.start_sync(readings, target, ["time", "zone"], "time", scratch_dir(t.spark, "stream-state")).awaitTermination()
    return sync.read_synced(t.spark, target, READING)


@query(f"""
WITH {HOURLY}
SELECT strftime(src.time, '%Y-%m-%d %H:%M:%S.%f') AS time, zone, min(amount) AS amount FROM src WHERE zone IS NOT NULL GROUP BY src.time, zone
""")
def stream_two_writers(t):
    """Two streams at the same time, each with a checkpoint of its own, over the same input into one sink."""
    target = scratch_dir(t.spark, "stream")
    incoming = sync.file_stream(t.spark, t.folder, t("events").schema, "events*.parquet")
    readings = incoming.select(F.date_trunc("hour", "ts").cast("timestamp").alias("time"), F.col("event_type").alias("zone"),
                               F.col("value").alias("amount")).filter("zone <> 'click'")
    running = [sync.start_sync(readings, target, ["time", "zone"], "time", scratch_dir(t.spark, "stream-state")) for _ in range(2)]
    for query_ in running:
        query_.awaitTermination()
    return sync.read_synced(t.spark, target, READING)
