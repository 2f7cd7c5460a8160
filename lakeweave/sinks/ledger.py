"""One Parquet sink with several writers: folders of loads and a list of commits beside them.

A load is written to a folder of its own, which no reader looks at, and then
committed: the file with the next version's number is created, which fails if
another writer has created it first. Readers read the folders that the list
names. A writer that loses its number checks its rows against what the others
have committed since, and tries the next. So keys stay unique however many
writers there are, nothing waits for a lock, and a writer that dies leaves
nothing that blocks or shows.

A load has an id; one that is listed is not loaded again. The list holds a line
a load: merge loads (``compact``) before there are very many.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeweave.functions.scalars import utc_day
from lakeweave.sinks.tables import balanced, new_rows, without_nulls

LAYOUT = T.StructType([T.StructField("load_id", T.StringType()), T.StructField("day", T.DateType())])
ENTRY = T.StructType([T.StructField("version", T.LongType()), T.StructField("folder", T.StringType()),
                      T.StructField("loads", T.ArrayType(T.StringType()))])


@dataclass(frozen=True)
class Commit:
    version: int
    folder: str
    loads: tuple[str, ...]


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with all of its content in one step; false if it exists, whoever made it."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsc.hadoopConfiguration()
    fs = target.getFileSystem(conf)
    target = fs.makeQualified(target)
    written = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}")
    stream = fs.create(written)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    try:
        if target.toUri().getScheme() == "file":
            # Hadoop's move on a local file system looks and then moves; a link does both at once.
            os.link(written.toUri().getPath(), target.toUri().getPath())
        else:
            move_new(spark, written, target)
    except FileExistsError:
        return False
    finally:
        fs.delete(written, False)
    return True


def move_new(spark: SparkSession, source, target) -> None:
    """Rename a file unless the target exists, as the name node of a cluster decides it."""
    jvm = spark._jvm
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.NONE
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    try:
        files.rename(source, target, options)
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName():
            raise FileExistsError(target.toString()) from None
        raise


class Ledger:
    """The commits of a sink at ``path``; rows have the columns of ``schema``."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.list = f"{self.path}/_commits"
        folder = spark._jvm.org.apache.hadoop.fs.Path(self.list)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)

    def commits(self) -> list[Commit]:
        """In order of version, without gaps: a writer takes the number after the last it has read."""
        rows = self.spark.read.schema(ENTRY).json(self.list).select("version", "folder", "loads").orderBy("version").collect()
        return [Commit(r["version"], r["folder"], tuple(r["loads"])) for r in rows]

    def commit(self, version: int, folder: str, loads: Sequence[str]) -> bool:
        """List a folder under this version; false if another writer has it."""
        entry = {"version": version, "folder": folder, "loads": list(loads)}
        return create_new(self.spark, f"{self.list}/{version:020d}.json", json.dumps(entry) + "\n")

    def read(self, commits: Sequence[Commit] | None = None) -> DataFrame:
        """The rows of the listed loads, or of some, with ``load_id`` and ``day``."""
        layout = T.StructType([*self.schema, *LAYOUT])
        commits = self.commits() if commits is None else commits
        if not commits:
            return self.spark.createDataFrame([], layout)
        return (self.spark.read.schema(layout).option("basePath", self.path)
                .parquet(*[f"{self.path}/{c.folder}" for c in commits]))

    def rows(self) -> DataFrame:
        return self.read().select([f.name for f in self.schema])

    def write(self, df: DataFrame, load: str) -> str:
        """Rows with ``day`` to a new folder of the load, not yet listed."""
        folder = f"load_id={load}-{uuid.uuid4().hex}"
        balanced(df, ["day"]).write.partitionBy("day").parquet(f"{self.path}/{folder}")
        return folder

    def insert(self, source: DataFrame, load: str, keys: Sequence[str], time: str,
               required: Sequence[str] = ()) -> int | None:
        """Add the rows whose keys no listed load has; the version, or none if this load is listed.

        ``source`` is read several times, so store it first if it is expensive. After a lost number only the loads
        committed since are looked at, and only the rows that were new before.
        """
        commits = self.commits()
        fresh, seen = source, 0
        kind = source.schema[time].dataType
        while not any(load in c.loads for c in commits):
            fresh = new_rows(fresh, self.read(commits[seen:]), keys, time, "day")
            folder = self.write(without_nulls(fresh, required).withColumn("day", utc_day(F.col(time), kind)), load)
            if self.commit(len(commits), folder, [load]):
                return len(commits)
            layout = T.StructType([*self.schema, *LAYOUT])
            fresh = (self.spark.read.schema(layout).option("basePath", self.path).parquet(f"{self.path}/{folder}")
                     .select([f.name for f in self.schema]))
            seen, commits = len(commits), self.commits()
        return None

    def compact(self, target: str) -> Ledger:
        """The listed rows as one load of a new sink, which knows the loads it came from."""
        commits = self.commits()
        made = Ledger(self.spark, target, self.schema)
        folder = made.write(self.read(commits).drop("load_id"), "compacted")
        if not made.commit(0, folder, [load for c in commits for load in c.loads]):
            raise ValueError(f"{target} has commits already")
        return made

    def sweep(self) -> int:
        """Remove the folders that no commit names, which failed or overtaken loads left. Not while a load runs."""
        listed = {c.folder for c in self.commits()}
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        removed = 0
        for status in fs.listStatus(root):
            name = status.getPath().getName()
            if name.startswith("load_id=") and name not in listed:
                fs.delete(status.getPath(), True)
                removed += 1
        return removed
