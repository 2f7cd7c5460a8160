"""A Parquet folder that is replaced as a whole, in one step.

Spark's overwrite deletes before it writes: while it runs, and after it has
failed, there is nothing to read. Here every overwrite goes to a folder of its
own, and becomes the content when its version is listed. Readers that have
planned with the version before keep reading it; a job may read what it
replaces; schema and partitions may change with each version.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lakeweave.sinks.ledger import create_new
from lakeweave.sinks.tables import write_parquet

ENTRY = "version long, folder string, schema string"


@dataclass(frozen=True)
class Version:
    number: int
    folder: str
    schema: T.StructType


class Versioned:
    """The versions of a folder at ``path``. Without any it cannot be read."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.list = f"{self.path}/_versions"
        self._files(self.list)[0].mkdirs(self._files(self.list)[1])

    def _files(self, path: str):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration()), folder

    def history(self) -> list[Version]:
        """All listed versions, the oldest first: a line for each overwrite."""
        lines = self.spark.read.schema(ENTRY).json(self.list).orderBy("version").collect()
        return [Version(r["version"], r["folder"], T.StructType.fromJson(json.loads(r["schema"]))) for r in lines]

    def read(self, number: int | None = None) -> DataFrame:
        """The rows of the last version, or of the one with this number."""
        listed = [v for v in self.history() if number is None or v.number == number]
        if not listed:
            raise ValueError(f"{self.path} has no version" + ("" if number is None else f" {number}"))
        return self.spark.read.schema(listed[-1].schema).parquet(f"{self.path}/{listed[-1].folder}")

    def replace(self, df: DataFrame, partition_by: Sequence[str] = ()) -> int:
        """Write all rows, then list them; gives the version. If the job fails, the version before stays.

        Of overwrites that run side by side each gets a number, and the last to be listed is what stands.
        """
        folder = f"rows-{uuid.uuid4().hex}"
        write_parquet(df, f"{self.path}/{folder}", partition_by, mode="errorifexists")
        order = [*[f for f in df.schema if f.name not in partition_by], *[df.schema[c] for c in partition_by]]
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in order]).json()
        history = self.history()
        number = history[-1].number + 1 if history else 0
        while not create_new(self.spark, f"{self.list}/{number:020d}.json", json.dumps(
                {"version": number, "folder": folder, "schema": schema}) + "\n"):
            number += 1
        return number

    def sweep(self, keep: int = 2) -> int:
        """Remove all but the last ``keep`` versions, and what failed overwrites left. Not while one runs."""
        history = self.history()
        kept = {v.folder for v in history[-max(keep, 1):]}
        for old in history[:-max(keep, 1)]:
            files, path = self._files(f"{self.list}/{old.number:020d}.json")
            files.delete(path, False)
        files, root = self._files(self.path)
        gone = [s.getPath() for s in files.listStatus(root) if s.getPath().getName().startswith("rows-") and s.getPath().getName() not in kept]
        for path in gone:
            files.delete(path, True)
        return len(gone)
