"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession

MIB = 1024 ** 2


def sizing(input_bytes: int, cores: int, shuffled: float = 0.25, partition_bytes: int = 256 * MIB,
           split_bytes: int = 128 * MIB) -> dict[str, str]:
    """Settings for an input size, of which the share ``shuffled`` is exchanged.

    AQE merges shuffle partitions that turn out small but never adds any, so the
    initial number follows the input, at ``partition_bytes`` each. Every map task
    writes a block per partition: for very large inputs take larger splits and
    partitions, so that the blocks do not become too small and too many.
    """
    partitions = max(2 * cores, math.ceil(input_bytes * shuffled / partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{128 * MIB}b",
        "spark.sql.files.maxPartitionBytes": f"{split_bytes}b",
    }


def build_session(app: str = "lakeweave", master: str | None = None,
                  input_bytes: int | None = None, cores: int = 8, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; ``sizing`` ones if the input size is given.

    AQE coalesces small shuffle partitions, splits skewed join partitions and
    turns sort-merge joins into broadcast joins once a side is known to be
    small, so joins in this library carry no broadcast hint of their own.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Split a hot key even where a grouping on the join key follows.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.parquet.filterPushdown": "true",
        "spark.ui.enabled": "false",
        # Without a stack trace per expression, wide suites are planned in half the time.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    if input_bytes is not None:
        settings.update(sizing(input_bytes, cores))
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the scratch root of the session, which all executors share.

    The root lies in ``spark.checkpoint.dir`` or, where that is unset, in the
    warehouse folder, which every session has. Results read what is stored
    there, so it stays until ``drop_scratch``.
    """
    return f"{scratch_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def scratch_root(spark: SparkSession) -> str:
    """The root; on a cluster a warehouse on a local path is refused, as executors do not share it."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir")
        if not spark.sparkContext.master.startswith("local") and base.startswith(("/", "file:")):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share; the warehouse is {base}")
    return f"{base.rstrip('/')}/scratch-{spark.sparkContext.applicationId}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The same rows, written to the scratch folder and read back: evaluated once, with a short lineage."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> None:
    """Remove what the session has stored below its scratch root, and the tables there."""
    root = scratch_root(spark)
    for table in spark.catalog.listTables():
        if table.name.startswith("lw_"):
            spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", {"name": table.name})
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
