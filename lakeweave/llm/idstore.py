"""Token ids in raw binary files, reached by document key through a minimal perfect hash.

A store is a folder. ``shard-000007.ids`` holds the ids of a run of documents in
ascending key order, each with its end id: a header (magic, id width, number of
documents, number of ids), the ids, the keys, and where each document ends.
``shards`` lists the files with the number of ids before each. ``index`` has one
row per bucket of keys: the bit arrays of a minimal perfect hash and, by its
slot, a fingerprint of the key, the shard and the row in the shard. So a key is
found with a few probes, and keys that are not in the store are refused by the
fingerprint but for one in 2**32, and then by the key in the file.

Files are written under a name of their own and then renamed, so that a task
that runs again replaces what it wrote. They go through ``pyarrow.fs``, which
takes local paths, HDFS and object stores.

Null texts have no ids but the end id. Null keys come first. Rows that share a
key stand next to each other, ordered by text; the key leads to all of them.
An empty table gives an empty store.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeweave.llm.bpe import Words, words_of_file
from lakeweave.llm.common import arrow_schema, byte_values, named, pieces

MAGIC = np.uint32(0x31534449)
HEAD = 4
LEVEL_SPACE = 1.6
NULL_KEY = -(1 << 63)


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, with or without a scheme."""
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1))
    return fs.LocalFileSystem(), path


# Files

def ids_of_texts(texts: pa.Array, words: Words, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts behind one another, each with its end id, and how many each has.

    The words of the texts are numbered together, so that each distinct one is encoded once and ids are dealt out by number.
    """
    split = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
    numbered = split.flatten().dictionary_encode()
    distinct = words.encode(byte_values(numbered.dictionary), remember=True)
    pool = np.frombuffer(b"".join(distinct), words.width)
    sizes = np.fromiter(map(len, distinct), np.int64, len(distinct)) // words.width.itemsize
    firsts = np.cumsum(sizes) - sizes
    number = numbered.indices.to_numpy()
    counts = sizes[number]
    ends = np.cumsum(counts)
    # Each word takes the ids from its first one on; every text before it has put one end id between.
    bounds = split.offsets.to_numpy() - split.offsets[0].as_py()
    per_text = np.diff(np.concatenate([np.zeros(1, np.int64), ends])[bounds])
    ids = pool[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(firsts[number] - (ends - counts), counts)]
    ids = np.insert(ids, np.cumsum(per_text), words.width.type(end_id))
    return ids, per_text + 1


def write_shard(folder: str, number: int, width: np.dtype, keys: list[int], sizes: list[int], ids: list[bytes]) -> None:
    system, base = opened(folder)
    system.create_dir(base, recursive=True)
    name = f"{base}/shard-{number:06d}.ids"
    own = f"{base}/.{uuid.uuid4().hex}.part"
    ends = np.cumsum(np.array(sizes, np.int64))
    head = np.array([MAGIC, width.itemsize, len(keys), 0], "<u4").tobytes() + np.array([ends[-1]], "<i8").tobytes()
    with system.open_output_stream(own) as out:
        out.write(head)
        for part in ids:
            out.write(part)
        out.write(np.array(keys, "<i8").tobytes())
        out.write(ends.astype("<i8").tobytes())
    system.move(own, name)


class Shard:
    """One file, read in parts; only the keys and ends are held."""

    def __init__(self, folder: str, number: int):
        system, base = opened(folder)
        self.file = system.open_input_file(f"{base}/shard-{number:06d}.ids")
        head = self.file.read_at(4 * HEAD + 8, 0)
        magic, itemsize, docs, _ = np.frombuffer(head, "<u4", HEAD).tolist()
        if magic != int(MAGIC):
            raise ValueError(f"shard {number} of {folder} is not an id file")
        self.width = np.dtype(f"<u{itemsize}")
        self.n_ids = int(np.frombuffer(head, "<i8", 1, 4 * HEAD)[0])
        self.body = len(head)
        after = self.body + self.n_ids * itemsize
        self.keys = np.frombuffer(self.file.read_at(8 * docs, after), "<i8")
        self.ends = np.frombuffer(self.file.read_at(8 * docs, after + 8 * docs), "<i8")

    def span(self, row: int) -> tuple[int, int]:
        return (int(self.ends[row - 1]) if row else 0), int(self.ends[row])

    def ids(self, row: int) -> bytes:
        """The ids of a document as little-endian unsigned 32-bit integers."""
        first, end = self.span(row)
        size = self.width.itemsize
        raw = self.file.read_at((end - first) * size, self.body + first * size)
        return np.frombuffer(raw, self.width).astype("<u4").tobytes()

    def close(self) -> None:
        self.file.close()


# Minimal perfect hash

def mixed(keys: np.ndarray, level: int) -> np.ndarray:
    """A hash of 64-bit keys for each level; the finalizer of splitmix64."""
    x = keys.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & (2 ** 64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys, 63) >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    """Slots 0 to n - 1 for n distinct keys, from a cascade of bit arrays.

    On each level the keys that no other key meets take their bit; the others go
    on to the next level, which is smaller. A slot is the rank of the bit.
    """

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.before = np.cumsum([0, *[int(x.sum()) for x in levels]])
        self.ranks = [np.cumsum(x) - x for x in levels]

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        levels, rest = [], keys
        while len(rest):
            if len(levels) == 62:
                raise ValueError("keys are not distinct")
            size = max(8, int(len(rest) * LEVEL_SPACE))
            at = (mixed(rest, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone.astype(np.int64))
            rest = rest[~alone[at]]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 where a foreign key meets no bit."""
        found = np.full(len(keys), -1, np.int64)
        for level, bits in enumerate(self.levels):
            open_ = np.flatnonzero(found < 0)
            at = (mixed(keys[open_], level) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at] == 1
            found[open_[hit]] = self.before[level] + self.ranks[level][at[hit]]
        return found

    def packed(self) -> tuple[list[int], bytes]:
        return [len(x) for x in self.levels], b"".join(np.packbits(x.astype(np.uint8)).tobytes() for x in self.levels)

    @classmethod
    def unpacked(cls, sizes: list[int], bits: bytes) -> PerfectHash:
        levels, at = [], 0
        for size in sizes:
            own = -(-size // 8)
            levels.append(np.unpackbits(np.frombuffer(bits, np.uint8, own, at), count=size).astype(np.int64))
            at += own
        return cls(levels)


# Writing

def write_store(docs: DataFrame, folder: str, vocabulary: str, end_id: int, doc_id: str = "doc_id", text: str = "text",
                shard_bytes: int = 32 << 20, bucket_keys: int = 1 << 16) -> None:
    """Encode every text, append ``end_id``, and write files, list and index below ``folder``.

    Shards are ranges of the key, so a shard is one task's sorted rows. They are
    made of ids only: a distinct word of a batch is encoded once, and remembered.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(named(doc_id).cast("long"), F.lit(NULL_KEY)).alias("key"), named(text).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    n = pieces(rows, "text", shard_bytes)
    dealt = rows.repartitionByRange(n, "key", "tie").sortWithinPartitions("key", "tie")
    files = f"{folder.rstrip('/')}/files"
    listed = arrow_schema("key long,shard int,row long,n_ids long")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = words_of_file(vocabulary)
        keys, sizes, ids = [], [], []
        number = TaskContext.get().partitionId()
        for batch in batches:
            if batch.num_rows:
                found, counts = ids_of_texts(batch.column("text"), words, end_id)
                keys.extend(batch.column("key").to_pylist())
                sizes.extend(counts.tolist())
                ids.append(found.tobytes())
        if keys:
            write_shard(files, number, words.width, keys, sizes, ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array([number] * len(keys), pa.int32()),
                 pa.array(range(len(keys)), pa.int64()), pa.array(sizes, pa.int64())], schema=listed)

    dealt.mapInArrow(write, "key long, shard int, row long, n_ids long").write.parquet(f"{folder}/rows")
    kept = spark.read.parquet(f"{folder}/rows")

    per_shard = kept.groupBy("shard").agg(F.count("*").alias("docs"), F.sum("n_ids").alias("n_ids"),
                                        F.min("key").alias("first_key"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    # One row per file.
    per_shard.withColumn("start", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0))).write.parquet(f"{folder}/shards")

    first = kept.groupBy("key").agg(F.min(F.struct("shard", "row")).alias("at"), F.count("*").alias("copies"))
    buckets = max(1, -(-kept.count() // bucket_keys))
    keyed = first.select("key", "at.shard", "at.row", "copies", bucket_of(buckets).alias("bucket"))
    keyed.groupBy("bucket").applyInPandas(
        index_bucket, "bucket int, buckets int, sizes array<int>, bits binary, prints binary, shards binary, "
                      "rows binary, copies binary").withColumn("buckets", F.lit(buckets)).write.parquet(f"{folder}/index")


def bucket_of(buckets: int):
    return F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int")


def index_bucket(table: pd.DataFrame) -> pd.DataFrame:
    keys = table["key"].to_numpy(np.int64)
    hashed = PerfectHash.of(keys)
    order = np.argsort(hashed.slots(keys))
    sizes, bits = hashed.packed()
    return pd.DataFrame([{
        "bucket": int(table["bucket"].iloc[0]), "buckets": 0, "sizes": sizes, "bits": bits,
        "prints": fingerprints(keys)[order].astype("<u4").tobytes(),
        "shards": table["shard"].to_numpy("<i4")[order].tobytes(),
        "rows": table["row"].to_numpy("<i8")[order].tobytes(),
        "copies": table["copies"].to_numpy("<i8")[order].tobytes()}])


# Reading

def locate(spark: SparkSession, folder: str, keys: DataFrame, key: str) -> DataFrame:
    """``key``, ``shard``, ``row`` and ``copies`` of each distinct key that the index knows."""
    index = spark.read.parquet(f"{folder}/index")
    top = index.agg(F.max("buckets")).first()[0]
    wanted = keys.select(F.coalesce(named(key).cast("long"), F.lit(NULL_KEY)).alias("key")).distinct()
    wanted = wanted.withColumn("bucket", bucket_of(top or 1))

    def probe(asked: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"key": pd.Series(dtype="int64"), "shard": pd.Series(dtype="int32"),
                              "row": pd.Series(dtype="int64"), "copies": pd.Series(dtype="int64")})
        if asked.empty or own.empty:
            return empty
        entry, known = own.iloc[0], asked["key"].to_numpy(np.int64)
        slots = PerfectHash.unpacked(list(entry["sizes"]), entry["bits"]).slots(known)
        prints = np.frombuffer(entry["prints"], "<u4")
        fits = slots >= 0
        fits[fits] = prints[slots[fits]] == fingerprints(known[fits])
        at = slots[fits]
        return pd.DataFrame({"key": known[fits], "shard": np.frombuffer(entry["shards"], "<i4")[at],
                             "row": np.frombuffer(entry["rows"], "<i8")[at],
                             "copies": np.frombuffer(entry["copies"], "<i8")[at]})

    return wanted.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInPandas(
        probe, "key long, shard int, row long, copies long")


def fetch(spark: SparkSession, folder: str, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key``, ``start`` (ids of all documents before it) and ``ids`` of the documents with these keys.

    Every distinct key is looked up once; unknown keys give no row, a key of several documents gives each.
    """
    found = locate(spark, folder, keys, key)
    shards = spark.read.parquet(f"{folder}/shards").select("shard", "docs", "start", "first_key")
    files = f"{folder.rstrip('/')}/files"
    # A key whose documents pass the end of a file goes on in the next ones, which then begin with it.
    spread = found.join(F.broadcast(shards), "shard")
    inside = spread.select("key", "shard", "start", F.explode(F.sequence(
        "row", F.least(F.col("row") + F.col("copies"), F.col("docs")) - 1)).alias("row"))
    beyond = spread.filter(F.col("row") + F.col("copies") > F.col("docs")).select("key", F.col("shard").alias("left_shard"))
    later = beyond.join(F.broadcast(shards), (F.col("first_key") == F.col("key"))
                        & (F.col("shard") > F.col("left_shard"))).select(
        "key", "shard", "start", F.lit(-1).cast("long").alias("row"))
    wanted = inside.unionByName(later)
    n = max(1, spark.read.parquet(f"{folder}/shards").count())
    dealt = wanted.repartition(n, "shard").sortWithinPartitions("shard", "row")
    made = arrow_schema("key long,start long,ids binary")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number, out, size = None, None, [], 0
        for batch in batches:
            for asked, at, start, row in zip(*[batch.column(c).to_pylist() for c in ("key", "shard", "start", "row")]):
                if at != number:
                    if shard:
                        shard.close()
                    shard, number = Shard(files, at), at
                for own in ([row] if row >= 0 else np.flatnonzero(shard.keys == asked).tolist()):
                    if shard.keys[own] == asked:
                        ids = shard.ids(own)
                        out.append((asked, start + shard.span(own)[0], ids))
                        size += len(ids)
                if size > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), made)], schema=made)
                    out, size = [], 0
        if shard:
            shard.close()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), made)], schema=made)

    ids = dealt.mapInArrow(read, "key long, start long, ids binary")
    return ids.select(F.when(F.col("key") != NULL_KEY, F.col("key")).alias(key), "start", "ids")
