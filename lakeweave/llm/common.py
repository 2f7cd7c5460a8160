"""Helpers of the operators: stored steps, running totals, packed columns."""

from __future__ import annotations

import ctypes
import functools
import math
import os
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeweave.session import scratch_dir

#: Words are runs of anything but ASCII white space; ``bytes.split()`` cuts at the same bytes.
WORD = "[^\\x20\\x09-\\x0D]+"


#: Bytes of an Arrow batch between Spark and its workers, where the session has left them at their default of 64 MB.
BATCH_BYTES, DEFAULT_BYTES = 8 << 20, 64 << 20


def reach_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, also if it is not installed.

    On a cluster install the package on the executors or pass it with ``--py-files``. Batches of texts are held by Spark
    and by the worker at once, several times in a chain of steps: the session's bound on their bytes is lowered.
    """
    bound = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(bound, "1") in (f"{DEFAULT_BYTES}b", str(DEFAULT_BYTES), "64MB", "64m"):
        spark.conf.set(bound, str(BATCH_BYTES))
    home = str(Path(__file__).resolve().parents[2])
    own = spark.sparkContext.environment
    paths = own.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep)
    if home not in paths:
        own["PYTHONPATH"] = os.pathsep.join([home, *filter(None, paths)])


def named(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def stored(df: DataFrame, purpose: str, steps: list[str] | None = None) -> DataFrame:
    """Cut the lineage: write to the shared scratch folder and read back. ``steps`` gets the path, for ``dropped``."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    if steps is not None:
        steps.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(spark: SparkSession, steps: list[str]) -> None:
    """Remove stored steps once what was made of them is stored itself, so that nothing reads them again."""
    for path in steps:
        path = spark._jvm.org.apache.hadoop.fs.Path(path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    steps.clear()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def pieces(df: DataFrame, text: str, piece_bytes: int) -> int:
    """How many pieces of about ``piece_bytes`` the column makes, and at least one per shuffle partition."""
    total = df.agg(F.sum(F.octet_length(named(text)))).first()[0] or 0
    return max(shuffle_partitions(df.sparkSession), math.ceil(total / piece_bytes))


def byte_values(column: pa.Array) -> list[bytes]:
    """Strings as UTF-8 bytes, null as no bytes."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column in one array, and where each value starts; null is empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]] if len(offsets) else data[:0], offsets - (offsets[0] if len(offsets) else 0)


def sliced(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most_bytes`` of a string or binary column, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(column).cast(pa.large_binary())
        offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset:values.offset + len(values) + 1]
        start = 0
        while start < len(values):
            end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + most_bytes, "right")) - 1)
            yield batch.slice(start, end - start)
            start = end


def trim() -> None:
    """Give memory that a step no longer needs back to the system; workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    give_back = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if give_back is not None:
        give_back(0)


@functools.cache
def keep_memory(block_bytes: int = 32 << 20, free_bytes: int = 64 << 20) -> bool:
    """Let this worker use freed arrays again instead of giving each back to the system; true if the C library can.

    Arrays of a few MB that are made and dropped all the time are else mapped anew, page by page. ``trim`` gives back.
    """
    bound = getattr(ctypes.CDLL(None), "mallopt", None)
    # M_MMAP_THRESHOLD and M_TRIM_THRESHOLD of glibc.
    return bound is not None and bool(bound(-3, block_bytes)) and bool(bound(-1, free_bytes))


@functools.cache
def one_thread() -> bool:
    """Matrix products of this worker on one thread; true if numpy's library has such a switch.

    Tasks fill the cores already. Further threads of the library take CPU time while they wait for small products.
    """
    for path in Path(np.__file__).parent.parent.glob("numpy.libs/*openblas*"):
        library = ctypes.CDLL(str(path))
        for name in ("scipy_openblas_set_num_threads64_", "scipy_openblas_set_num_threads", "openblas_set_num_threads64_", "openblas_set_num_threads"):
            if hasattr(library, name):
                getattr(library, name)(1)
                return True
    return False


def arrow_schema(fields: str) -> pa.Schema:
    """``"id long, ids binary"`` as an Arrow schema."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
             "binary": pa.binary(), "boolean": pa.bool_(), "short": pa.int16()}
    return pa.schema([(n, kinds[k]) for n, k in (field.split() for field in fields.split(","))])


def with_columns(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[pa.RecordBatch, list[pa.Array]]]],
                 new: T.StructType) -> DataFrame:
    """Add columns made from Arrow batches; a column of the same name is replaced.

    ``function`` sees the columns as ``c0``, ``c1`` and so on and gives back
    batches, cut as it likes, each with the arrays to add.
    """
    inner = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    added = [f"n{j}" for j in range(len(new))]
    schema = T.StructType([*inner.schema.fields, *[T.StructField(a, f.dataType) for a, f in zip(added, new)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, arrays in function(batches):
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], [*batch.schema.names, *added])

    return inner.mapInArrow(run, schema).select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(df.columns) if c not in new.names],
        *[F.col(a).alias(f.name) for a, f in zip(added, new)])


def running_totals(df: DataFrame, order: Sequence[str], weights: dict[str, str], purpose: str) -> DataFrame:
    """Add the exclusive running total of integer columns over the whole table in the given order.

    ``weights`` maps a new column to the column it sums. The rows are dealt out
    by range, summed within each range, and shifted by the totals of the ranges
    before it; only one row per range is gathered. Rows that tie in ``order``
    stand in any sequence, so give an order that is total up to equal rows.
    """
    at = {c: f"c{i}" for i, c in enumerate(df.columns)}
    keys = [F.col(at[c]) for c in order]
    dealt = df.toDF(*at.values()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    new = T.StructType([T.StructField(f"t{i}", T.LongType()) for i in range(len(weights) + 1)])
    sources = [f"c{df.columns.index(c)}" for c in weights.values()]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[pa.Array]]]:
        before = [0] * len(sources)
        here = TaskContext.get().partitionId()
        for batch in batches:
            arrays = [pa.array(np.full(batch.num_rows, here, np.int64))]
            for i, source in enumerate(sources):
                values = batch.column(source).to_numpy(zero_copy_only=False).astype(np.int64)
                ends = np.cumsum(values) + before[i]
                arrays.append(pa.array(ends - values))
                before[i] = int(ends[-1]) if len(ends) else before[i]
            yield batch, arrays

    local = stored(with_columns(dealt, add, new), purpose)
    ends = local.groupBy("t0").agg(*[F.max(F.col(f"t{i + 1}") + F.col(c)).alias(f"s{i}") for i, c in enumerate(sources)])
    earlier = Window.orderBy("t0").rowsBetween(Window.unboundedPreceding, -1)
    shifts = ends.select("t0", *[F.coalesce(F.sum(f"s{i}").over(earlier), F.lit(0)).alias(f"s{i}") for i in range(len(sources))])
    # One row per range: as small as the number of partitions.
    return local.join(F.broadcast(shifts), "t0").select(
        *[F.col(c).alias(name) for name, c in at.items()],
        *[(F.col(f"t{i + 1}") + F.col(f"s{i}")).alias(name) for i, name in enumerate(weights)])
