"""The prefix trie of conversations, by truncation peeling from the longest down.

A conversation is a chain of marks, one a turn: 16 bytes of a running SHA-256 of
roles and texts up to this turn, and four bytes for the words of its text. A node
is a distinct chain, so that taking the last mark off a node gives its parent. The
descent starts with the chains of most marks. At each depth the conversations that
end there meet the nodes that are left of the depth below: both are grouped by
their chain, and the group is a node with its members, its children, its leaves
and the tokens saved in its subtree, summed as it is found. Every depth is stored
once and read once by the next. Groupings combine on the map side, so a chain that
a third of all conversations begin with is one row per task.

Equal conversations are one chain with a count from the start. A chain that shares
its first 8, 16, 32 and so on turns with no other chain is truncated there at once,
and its own nodes below are written out in its task: the rounds are at most twice as
many as the turns that two different conversations share, however long they are.

Texts are read once, for their marks; chains are what is shuffled. Null roles and
texts are empty. Turns of one conversation that tie stand in order of their
digests, repeated rows are turns of their own. Rows without a conversation id belong
to no conversation and are left out. An empty table has no node.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeweave.llm.common import WORD, arrow_schema, named, stored
from lakeweave.session import scratch_dir

#: Bytes of a turn in a chain: its key, and its words.
KEY, MARK = 16, 20
#: Own tails are looked for from this depth on, at its doubles.
SHORTEST = 8
#: A parent is looked up under so many keys at most, those of its children.
SALTS = 64
#: Ids of conversations that end at one node travel in pieces of so many.
PIECE = 4096


def conversations(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv`` and ``turns``, the digest and words of each of its turns in order, as hex text."""
    who, said = [F.coalesce(named(c).cast("string"), F.lit("")) for c in (role, text)]
    digest = F.sha2(F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, said), 256)
    words = F.lpad(F.hex(F.regexp_count(said, F.lit(WORD)).cast("long")), 8, "0")
    marks = turns.filter(named(conv_id).isNotNull()).select(
        named(conv_id).cast("long").alias("conv"), named(turn).alias("turn"), digest.alias("digest"), words.alias("words"))
    inside = F.sort_array(F.collect_list(F.struct("turn", "digest", "words")))
    return marks.groupBy("conv").agg(F.transform(inside, lambda t: F.concat(F.substring(t.digest, 1, 2 * KEY), t.words)).alias("turns"))


def shared_starts(convs: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """``conv`` and ``turns``: the first ``h`` turns of the conversation whose id is the last multiple of ``every``, then its
    own turns after its first ``h``; ``h`` is the unsigned CRC-32 of the decimal id modulo ``most``."""
    taken = (F.crc32(F.col("conv").cast("string").cast("binary")) % most).cast("int")
    first = convs.filter(F.col("conv") % every == 0).select(F.col("conv").alias("base"), F.slice("turns", 1, most - 1).alias("start"))
    both = convs.withColumn("base", F.col("conv") - F.col("conv") % every).join(first, "base", "left").withColumn("h", taken)
    start = F.slice(F.coalesce("start", F.array().cast("array<string>")), F.lit(1), F.col("h"))
    own = F.slice("turns", F.col("h") + 1, F.size("turns"))
    return both.select("conv", F.concat(start, own).alias("turns"))


def chains_of(convs: DataFrame) -> DataFrame:
    """``conv`` and ``chain``, from ``conv`` and ``turns``."""
    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for turns in batch.column("turns").to_pylist():
                key, marks = b"", []
                for turn in turns:
                    key = sha256(key + bytes.fromhex(turn[:2 * KEY])).digest()[:KEY]
                    marks += [key, bytes.fromhex(turn[2 * KEY:])]
                out.append(b"".join(marks))
            yield pa.RecordBatch.from_arrays([batch.column("conv"), pa.array(out, pa.binary())], ["conv", "chain"])

    return convs.select("conv", "turns").mapInArrow(chain, "conv long, chain binary")


def key_of(chain: Column, above: int = 0) -> Column:
    """The key of a chain, or of the node so many turns above it; empty for the root."""
    length = F.octet_length(chain)
    return F.when(length > above * MARK, F.substring(chain, length - (above + 1) * MARK + 1, F.lit(KEY))).otherwise(F.lit(b""))


def salt(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(SALTS)).cast("int")


def salt_bit(key: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), salt(key))


def truncated(chains: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What is left of each distinct chain once its own tail is off, and the nodes of these tails.

    The first has ``chain``, ``conv`` (the smallest), ``n_convs``, and of the tail ``n_children`` (0 or 1), ``n_leaves``,
    ``saved`` and ``salts``, and is stored by ``depth``; the second has the columns of ``peel``.
    """
    spark = chains.sparkSession
    kinds = stored(chains.groupBy("chain").agg(F.min("conv").alias("conv"), F.count("*").alias("n_convs")).withColumn(
        "depth", F.expr(f"octet_length(chain) div {MARK}").cast("int")), "chains")
    deepest = kinds.agg(F.max("depth")).first()[0] or 0
    cuts = [SHORTEST << i for i in range(1 + deepest.bit_length()) if SHORTEST << i < max(deepest, SHORTEST + 1)]
    starts = kinds.filter(F.col("depth") > SHORTEST).select(
        "conv", F.explode(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < F.col("depth"))).alias("cut"), "chain")
    starts = starts.select("conv", "cut", F.expr(f"substring(chain, (cut - 1) * {MARK} + 1, {KEY})").alias("key"))
    # One chain has one smallest conversation, so that this names it.
    single = starts.groupBy("key").agg(F.count("*").alias("n"), F.min("conv").alias("conv"), F.min("cut").alias("cut")).filter("n = 1")
    left = kinds.join(single.groupBy("conv").agg(F.min("cut").alias("cut")), "conv", "left")

    def tails(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chain, conv, n, depth, cut in zip(*[batch.column(c).to_pylist() for c in ("chain", "conv", "n_convs", "depth", "cut")]):
                marks = np.frombuffer(chain, np.uint8).reshape(depth, MARK)
                keys = [k.tobytes() for k in marks[cut - 1:, :KEY]]
                words = marks[cut:, KEY:].copy().view(">u4")[:, 0].astype(np.int64)
                saved = (n - 1) * np.cumsum(words[::-1])[::-1]
                rows = depth - cut
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[1:], pa.binary()), pa.array(keys[:-1], pa.binary()), pa.array(np.arange(cut + 1, depth + 1, dtype=np.int32)),
                     pa.array(np.full(rows, conv)), pa.array(np.full(rows, n)), pa.array(np.arange(rows)[::-1] > 0).cast(pa.int64()),
                     pa.array(np.ones(rows, np.int64)), pa.array(saved), pa.array([*keys[2:], None], pa.binary())],
                    ["key", "above", "depth", "conv", "n_convs", "n_children", "n_leaves", "saved", "next"])

    left = stored(left, "cut")
    own = left.filter("cut IS NOT NULL").mapInArrow(
        tails, "key binary, above binary, depth int, conv long, n_convs long, n_children long, n_leaves long, saved long, next binary")
    own = stored(own.withColumn("salts", F.when(F.col("next").isNull(), F.lit(0).cast("long")).otherwise(salt_bit(F.col("next")))).drop("next"), "tails")
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    top = own.join(left.select("conv", (F.col("cut") + 1).alias("depth")), ["conv", "depth"], "left_semi").select("conv", "saved", "key")
    whole = left.join(top, "conv", "left")
    cut = F.col("cut").isNotNull()
    whole = whole.select(
        F.when(cut, F.expr(f"substring(chain, 1, cut * {MARK})")).otherwise(F.col("chain")).alias("chain"), "conv", "n_convs",
        F.when(cut, one).otherwise(zero).alias("n_children"), F.when(cut, one).otherwise(zero).alias("n_leaves"),
        F.coalesce("saved", zero).alias("saved"), F.when(cut, salt_bit(F.col("key"))).otherwise(zero).alias("salts"),
        F.coalesce("cut", "depth").alias("depth"))
    path = scratch_dir(spark, "starts")
    whole.write.partitionBy("depth").parquet(path)
    return spark.read.schema(whole.schema).parquet(path), own


def peel(starts: DataFrame) -> DataFrame:
    """The nodes of truncated chains: ``key``, ``above`` (the key of the parent), ``depth``, ``conv`` (the smallest member),
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved`` and ``salts``, a bit for each salt that its children have."""
    spark = starts.sparkSession
    deepest = starts.agg(F.max("depth")).first()[0]
    root, below = scratch_dir(spark, "trie"), None
    sums = ["n_convs", "n_children", "n_leaves", "saved"]
    columns = ["chain", "conv", *sums, "salts"]
    for depth in range(-1 if deepest is None else deepest, -1, -1):
        nodes = starts.filter(F.col("depth") == depth).select(columns)
        if below is not None:
            nodes = nodes.unionByName(below.select(
                F.substring("chain", 1, depth * MARK).alias("chain"), "conv", "n_convs", F.lit(1).cast("long").alias("n_children"),
                "n_leaves", "saved", salt_bit(F.col("key")).alias("salts")))
        nodes = nodes.groupBy("chain").agg(F.min("conv").alias("conv"), *[F.sum(c).alias(c) for c in sums], F.bit_or("salts").alias("salts"))
        words = F.conv(F.hex(F.substring("chain", -4, 4)), 16, 10).cast("long")
        nodes = nodes.withColumns({
            "n_leaves": F.greatest("n_leaves", F.lit(1).cast("long")), "saved": F.col("saved") + ((F.col("n_convs") - 1) * words if depth else 0),
            "key": key_of(F.col("chain")), "above": key_of(F.col("chain"), 1) if depth else F.lit(None).cast("binary")})
        nodes.write.parquet(f"{root}/depth={depth}")
        below = spark.read.schema(nodes.schema).parquet(f"{root}/depth={depth}")
    if below is None:
        return spark.createDataFrame([], "key binary, above binary, depth int, conv long, n_convs long, n_children long, n_leaves long, saved long, salts long")
    every = spark.read.schema(T.StructType([*below.schema, T.StructField("depth", T.IntegerType())])).parquet(root)
    return every.select("key", "above", "depth", "conv", *sums, "salts")


def end_digests(chains: DataFrame) -> DataFrame:
    """``key`` and ``ends``, the SHA-256 of the ids of the conversations that end there, ascending, with commas.

    Ids are sorted over ranges and travel in pieces; the pieces of a node run through one digest, one after another.
    """
    made = arrow_schema("key binary,first long,ids string"), arrow_schema("key binary,ends string")

    def table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids = None, []
        for batch in batches:
            out = []
            for own, conv in zip(batch.column("key").to_pylist(), batch.column("conv").to_pylist()):
                if own != key or len(ids) == PIECE:
                    if ids:
                        out.append((key, ids[0], ",".join(map(str, ids))))
                    key, ids = own, []
                ids.append(conv)
            yield table(out, made[0])
        if ids:
            yield table([(key, ids[0], ",".join(map(str, ids)))], made[0])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            found = []
            for own, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
                if own != key:
                    if state is not None:
                        found.append((key, state.hexdigest()))
                    key, state = own, sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            yield table(found, made[1])
        if state is not None:
            yield table([(key, state.hexdigest())], made[1])

    ordered = chains.select(key_of(F.col("chain")).alias("key"), "conv").repartitionByRange("key", "conv").sortWithinPartitions("key", "conv")
    packed = ordered.mapInArrow(pieces, "key binary, first long, ids string")
    return packed.repartition("key").sortWithinPartitions("key", "first").mapInArrow(digests, "key binary, ends string")


def trie(convs: DataFrame) -> DataFrame:
    """One row per distinct start of the conversations (``conv``, ``turns``), from the root without turns.

    ``conv_id`` is the smallest member, ``parent_conv_id`` that of the parent (null for the root), ``n_convs`` the members,
    ``n_leaves`` the childless nodes of the subtree with its top, ``saved_tokens`` the words that the subtree does not repeat.
    A parent of very many children is looked up under the salts that its children have, so that no key is hot.
    """
    chains = stored(chains_of(convs), "chains")
    starts, tails = truncated(chains)
    nodes = peel(starts).unionByName(tails)
    parents = nodes.filter("n_children > 0").select(
        F.col("key").alias("above"), F.col("conv").alias("parent_conv_id"),
        F.explode(F.filter(F.sequence(F.lit(0), F.lit(SALTS - 1)), lambda i: F.call_function("getbit", F.col("salts"), i) == 1)).alias("salt"))
    placed = nodes.drop("salts").withColumn("salt", F.when(F.col("above").isNotNull(), salt(F.col("key"))))
    joined = placed.join(parents, ["above", "salt"], "left").join(end_digests(chains), "key", "left")
    return joined.select(
        F.col("conv").alias("conv_id"), F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.lit(sha256().hexdigest())).alias("ends_sha256"), "key")
