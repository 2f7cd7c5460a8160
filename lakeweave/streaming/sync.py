"""High-water-mark sync, as polled chunks or as a stream.

Both forms load through ``new_rows``, so a repeated or restarted load adds
nothing twice. A stream's sink has a list of commits, so that several streams
may run into it at once; a table has one writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakeweave.functions.predicates import open_closed
from lakeweave.operators.shape import project
from lakeweave.session import stored
from lakeweave.sinks.ledger import Ledger
from lakeweave.sinks.tables import insert_ignore
from lakeweave.sources.tables import high_watermark, latest_day

# Where the sync starts, how far a chunk reaches, and the names
# the weather columns have in the sink.
DEFAULT_START = "2023-01-01 00:00:00"
SPAN = "24 hours"
WEATHER_COLUMNS = {
    "time": "weather_timestamp",
    "zone": "zone_name",
    "temp": "temperature_c",
    "humidity": "humidity_%",
    "precipitation": "precipitation_mm",
    "rain": "rain_mm",
    "snow": "snowfall_cm",
    "wind_speed": "wind_speed_kmh",
    "wind_direction": "wind_direction_deg",
}


def to_metrics(weather: DataFrame) -> DataFrame:
    return project(weather, WEATHER_COLUMNS)


def _low(source: DataFrame, sink: DataFrame, time: str, sink_time: str | None, default: str) -> Column:
    """The last time of the sink; for an empty one, just before ``default``."""
    kind = source.schema[time].dataType
    start = F.lit(default).cast(kind) - F.expr("interval 1 microsecond")
    mark = high_watermark(sink.select(F.col(sink_time or time).cast(kind).alias("t")), "t", start)
    return mark.scalar()


def _year(time: Column, days: int) -> Column:
    """The year to look for in the column the source is partitioned by, with a
    day's margin: the source may be partitioned in another time zone."""
    return F.year(time + F.expr(f"interval {days} days"))


def _upcoming(source: DataFrame, time: str, low: Column, span: str, year: str | None,
              within: bool = False) -> DataFrame:
    """One row: the ``next`` time after ``low`` and the ``high`` end of the chunk.

    ``within`` looks no further than ``span``, so the scan is bounded on both sides.
    """
    later = source.filter(F.col(time) > low)
    if within:
        later = later.filter(F.col(time) <= low + F.expr(f"interval {span}"))
    if year is not None:
        later = later.filter(F.col(year) >= _year(low, -1))
        if within:
            later = later.filter(F.col(year) <= _year(low + F.expr(f"interval {span}"), 1))
    return later.agg(F.min(time).alias("next")).select(
        "next", F.greatest(low + F.expr(f"interval {span}"), "next").alias("high"))


def _between(source: DataFrame, time: str, low: Column, high: Column, year: str | None) -> DataFrame:
    chunk = source.filter(open_closed(F.col(time), low, high))
    if year is not None:
        chunk = chunk.filter((F.col(year) >= _year(low, -1)) & (F.col(year) <= _year(high, 1)))
    return chunk


def incremental_chunk(source: DataFrame, sink: DataFrame, time: str, sink_time: str | None = None,
                      span: str = SPAN, default: str = DEFAULT_START, year: str | None = None) -> DataFrame:
    """The rows after the sink's last time, up to ``span`` later, in order of time.

    An empty sink starts at ``default``, that instant included. If nothing lies
    within the span but later rows exist, the chunk reaches to the next time that
    has rows, so a gap in the source cannot stop the sync. No row is left when
    the sink has caught up.

    The bounds are scalar subqueries: no job runs here, and each stands alone in
    its comparison, so the scan gets both as pushed filters.
    """
    low = _low(source, sink, time, sink_time, default)
    high = _upcoming(source, time, low, span, year).select("high").scalar()
    return _between(source, time, low, high, year).orderBy(time)


def sync_once(source: DataFrame, table: str, keys: Sequence[str], time: str,
              prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
              sink_time: str | None = None, span: str = SPAN, default: str = DEFAULT_START,
              year: str | None = None) -> bool:
    """Load the next chunk into ``table``; false when there was nothing to load.

    The bounds, one row, are read first, so that the load itself is planned with
    constants and prunes partitions. The search for the next time looks inside
    the span and goes beyond it only over a gap, so a long sync reads each part
    of the source a few times, not all later rows for every chunk. The chunk is
    read once and stored; what is loaded is worked out from there. It does not
    sort: the sink has no order.
    """
    target = sink_time or time
    low = _low(source, latest_day(source.sparkSession, table), time, target, default)
    # Instants travel as a number: text would confuse the repeated autumn hour.
    instant = isinstance(source.schema[time].dataType, T.TimestampType)

    def carried(column: Column) -> Column:
        return F.unix_micros(column) if instant else column.cast("string")

    def constant(value) -> Column:
        return F.timestamp_micros(F.lit(value)) if instant else F.lit(value).cast("timestamp_ntz")

    mark = source.sparkSession.range(1).select(carried(low).alias("low")).first().low
    low = constant(mark)
    for within in (True, False):
        row = _upcoming(source, time, low, span, year, within).select(
            carried(F.col("high")).alias("high"), F.col("next").isNotNull().alias("more")).first()
        if row.more:
            break
    else:
        return False
    chunk = stored(prepare(_between(source, time, low, constant(row.high), year)), "chunk")
    insert_ignore(chunk, table, keys, target)
    return True


def chunk_bounds(source: DataFrame, sink: DataFrame, time: str, sink_time: str | None = None, span: str = SPAN,
                 default: str = DEFAULT_START, year: str | None = None) -> DataFrame:
    """All chunks that a sync will load, as rows ``(chunk, low, high)``, from one pass over the source.

    A chunk holds the times after ``low`` up to ``high``: ``span`` from the last time of the chunk before, or further
    over a gap. The source is reduced to the first and last time of each of its hours, and chunks are cut at these: an
    hour goes to one chunk whole. One row per hour is gathered, some nine thousand for each year that is left to load.
    """
    low = _low(source, sink, time, sink_time, default)
    later = source.filter(F.col(time) > low)
    if year is not None:
        later = later.filter(F.col(year) >= _year(low, -1))
    hours = later.groupBy(F.date_trunc("hour", time).alias("hour")).agg(F.min(time).alias("first"), F.max(time).alias("last"))
    bound = F.struct(F.col("low"), F.col("low").alias("high"))
    kind = source.schema[time].dataType
    start = F.struct(F.col("low").alias("top"), F.lit(None).cast(kind).alias("high"),
                     F.filter(F.array(bound), lambda b: F.lit(False)).alias("done"))

    def cut(made: Column, hour: Column) -> Column:
        end = F.greatest(made["top"] + F.expr(f"interval {span}"), hour["last"])
        opened = F.concat(made["done"], F.array(F.struct(made["top"].alias("low"), end.alias("high"))))
        inside = F.coalesce(hour["last"] <= made["high"], F.lit(False))
        return F.struct(hour["last"].alias("top"), F.when(inside, made["high"]).otherwise(end).alias("high"),
                        F.when(inside, made["done"]).otherwise(opened).alias("done"))

    listed = hours.agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("hours"))
    folded = listed.withColumn("low", low).select(F.aggregate("hours", start, cut)["done"].alias("done"))
    return folded.select(F.posexplode("done").alias("chunk", "bound")).select("chunk", "bound.low", "bound.high")


def sync_all(source: DataFrame, table: str, keys: Sequence[str], time: str,
             prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
             sink_time: str | None = None, span: str = SPAN, default: str = DEFAULT_START,
             year: str | None = None, chunks_per_load: int | None = None) -> int:
    """Load all chunks. Returns their number.

    The bounds of all chunks come first, from one pass; what lies between them is loaded by one job, or in steps of
    ``chunks_per_load`` chunks, each of which is complete before the next begins. A key has one time, so that it makes
    no difference to the rows how many chunks a load has.
    """
    spark = source.sparkSession
    sink = latest_day(spark, table)
    bounds = stored(chunk_bounds(source, sink, time, sink_time, span, default, year), "bounds")
    instant = isinstance(source.schema[time].dataType, T.TimestampType)

    def carried(column: Column) -> Column:
        return F.unix_micros(column) if instant else column.cast("string")

    def constant(value) -> Column:
        return F.timestamp_micros(F.lit(value)) if instant else F.lit(value).cast("timestamp_ntz")

    load = F.expr(f"chunk div {chunks_per_load}") if chunks_per_load else F.lit(0)
    loads = bounds.groupBy(load.alias("load")).agg(F.min("low").alias("low"), F.max("high").alias("high"), F.count("*").alias("chunks"))
    steps = loads.select("load", carried(F.col("low")).alias("low"), carried(F.col("high")).alias("high"), "chunks").orderBy("load").collect()
    for step in steps:
        part = stored(prepare(_between(source, time, constant(step.low), constant(step.high), year)), "chunk")
        insert_ignore(part, table, keys, sink_time or time)
        spark.catalog.refreshTable(table)
    return sum(step.chunks for step in steps)


def load_batch(batch: DataFrame, batch_id: int, path: str, keys: Sequence[str], time: str, query: str) -> None:
    """Add the new rows of one micro-batch to a sink that other streams may write to at the same time.

    A load is a query and a batch of it. A batch that is run again after a
    failure is listed already or was never seen, so rows with a null key, which
    never conflict, are not doubled either. Another query, or one that starts
    anew with another checkpoint, counts its batches from 0 too and adds loads.
    """
    load = f"{query}-{batch_id}"
    sink = Ledger(batch.sparkSession, path, batch.schema)
    if not any(load in c.loads for c in sink.commits()):
        sink.insert(stored(batch, "batch"), load, keys, time)


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream keeps in its checkpoint from its first start on."""
    return spark.read.schema("id string").json(f"{checkpoint.rstrip('/')}/metadata").first()["id"]


def start_sync(stream: DataFrame, path: str, keys: Sequence[str], time: str, checkpoint: str,
               name: str | None = None) -> StreamingQuery:
    """Stream into a sink with commits until all available input is loaded."""
    Ledger(stream.sparkSession, path, stream.schema)
    writer = (stream.writeStream
              .foreachBatch(lambda batch, batch_id: load_batch(
                  batch, batch_id, path, keys, time, query_id(batch.sparkSession, checkpoint)))
              .option("checkpointLocation", checkpoint)
              .trigger(availableNow=True))
    return (writer.queryName(name) if name else writer).start()


def read_synced(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows that streams have loaded and committed."""
    return Ledger(spark, path, schema).rows()


def compact_synced(spark: SparkSession, path: str, target: str, schema: T.StructType) -> None:
    """Write all loads as one to a new sink; streams may go on there, without a batch twice."""
    Ledger(spark, path, schema).compact(target)


def file_stream(spark: SparkSession, folder: str, schema: T.StructType,
                pattern: str = "*.parquet", files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)
