"""Merkle trees over the rows of a table, kept as append logs in postorder.

The rows of a tree are its leaves, in a stated order. Eight consecutive nodes
of a level become one of the next (the last run may be shorter, even one node),
until one is left. Aligned blocks of ``8 ** BLOCK_LEVELS`` leaves are built
apart: a builder reads its leaves in order and appends each node to its log when
the node is complete, so that it holds eight open nodes a level and its log is in
postorder. The roots of the blocks are the leaves of the next tier of blocks,
and so on; a tree has one block in its last tier.

No log keeps an index. Before leaf ``e`` of a block ``e // 8**j`` nodes of level
``j`` are complete, and a node of level ``l`` is complete ``l`` entries after its
last leaf, so its place in the log is ``sum(e // 8**j for j) + l``. Proofs read
the siblings of a row and of its ancestors at these places, block by block.

The digest of a node is the SHA-256 of the digests of its children as hex text.
A tree of one leaf has this leaf as its root, an empty table has no tree. Rows
that tie in the order stand in any sequence, so give an order that is total up
to equal rows; equal rows are leaves of their own with proofs of their own.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeweave.llm.common import named, running_totals, stored, trim, with_columns

FANOUT = 8
#: Levels of a block: 512 leaves and 73 nodes above them.
BLOCK_LEVELS = 3
BLOCK = FANOUT ** BLOCK_LEVELS
DIGEST = 32


def joined(nodes: bytes) -> bytes:
    """The digest above nodes that lie end to end."""
    return sha256(nodes.hex().encode()).digest()


def levels_of(leaves: int) -> int:
    """Levels above the leaves of a tree."""
    levels = 0
    while leaves > 1:
        leaves, levels = -(-leaves // FANOUT), levels + 1
    return levels


def places(level: int, nodes: np.ndarray, leaves: int) -> np.ndarray:
    """Where the log of a block of so many leaves has these nodes of a level."""
    last = np.minimum((nodes + 1) * FANOUT ** level, leaves) - 1
    place = last + level
    while last.any():
        last = last // FANOUT
        place = place + last
    return place


def append_log(leaves: Iterator[bytes], count: int, levels: int) -> bytes:
    """All nodes of a block in the order in which they are complete."""
    log, open_ = [], [bytearray() for _ in range(levels + 1)]
    for number, node in enumerate(leaves, 1):
        log.append(node)
        open_[0] += node
        for level in range(levels):
            if number < count and len(open_[level]) < FANOUT * DIGEST:
                break
            node = joined(bytes(open_[level]))
            open_[level].clear()
            log.append(node)
            open_[level + 1] += node
    return b"".join(log)


def leaf(*values: Column) -> Column:
    """The digest of a row's values, as hex text: ``-`` for null, else the count of bytes, ``:`` and the value."""
    parts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts]), 256)


def placed(rows: DataFrame, tree: str, order: Sequence[str]) -> DataFrame:
    """Add ``at``, the place of a row in its tree from 0, and ``n``, the rows of the tree. ``tree`` holds no null."""
    numbered = running_totals(rows.withColumn("one", F.lit(1)), [tree, *order], {"place": "one"}, "leaves").drop("one")
    sizes = numbered.groupBy(tree).agg(F.count("*").alias("n"), F.min("place").alias("first"))
    return numbered.join(sizes, tree).withColumn("at", F.col("place") - F.col("first")).drop("place", "first")


def build(rows: DataFrame) -> list[DataFrame]:
    """The logs of the trees of ``rows`` (``tree`` string, ``at``, ``n``, ``digest`` binary), tier by tier.

    A row of a log is one block: ``tree``, ``block``, ``n`` (nodes that the tier has below it in the whole tree),
    ``root`` and ``log``, digests end to end.
    """
    def append(block: pa.Table) -> pa.Table:
        block = block.sort_by("at")
        n = block["n"][0].as_py()
        levels = min(levels_of(n), BLOCK_LEVELS)
        log = append_log(iter(block["digest"].to_pylist()), block.num_rows, levels)
        return pa.table({"tree": block["tree"].slice(0, 1), "block": block["block"].slice(0, 1), "n": block["n"].slice(0, 1),
                         "root": pa.array([log[-DIGEST:]], pa.binary()), "log": pa.array([log], pa.binary())})

    tiers = []
    while True:
        blocks = rows.select("tree", F.expr(f"at div {BLOCK}").alias("block"), "at", "n", "digest").groupBy("tree", "block")
        tiers.append(stored(blocks.applyInArrow(append, "tree string, block long, n long, root binary, log binary"), "log"))
        above = tiers[-1].filter(F.col("n") > BLOCK)
        if above.isEmpty():
            return tiers
        rows = above.select("tree", F.col("block").alias("at"), F.expr(f"(n + {BLOCK - 1}) div {BLOCK}").alias("n"),
                            F.col("root").alias("digest"))


def roots(tiers: list[DataFrame]) -> DataFrame:
    """``tree`` and ``root``."""
    ends = [tier.filter(F.col("n") <= BLOCK).select("tree", "root") for tier in tiers]
    for end in ends[1:]:
        ends[0] = ends[0].unionByName(end)
    return ends[0]


def siblings(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """Rows (``tree``, ``at``, more) with ``path`` and ``tops`` read from the blocks above them.

    ``path`` is, level by level up to the outermost root, how many siblings stand left and right (a byte each) and
    their digests; ``tops`` are the roots above, the outermost first.
    """
    more = [f for f in rows.schema.fields if f.name not in ("tree", "at")]
    kept = ["tree", "at", *[f.name for f in more]]
    schema = T.StructType([rows.schema["tree"], rows.schema["at"], *more, T.StructField("path", T.BinaryType()), T.StructField("tops", T.BinaryType())])

    def read(items: pa.Table, block: pa.Table) -> pa.Table:
        if not items.num_rows or not block.num_rows:
            return pa.table({**{c: items[c].slice(0, 0) for c in kept}, "path": pa.array([], pa.binary()), "tops": pa.array([], pa.binary())})
        n, number, log, above, tops = [block[c][0].as_py() for c in ("n", "block", "log", "path", "tops")]
        leaves = min(n - number * BLOCK, BLOCK)
        digests = np.frombuffer(log, np.uint8).reshape(-1, DIGEST)
        runs = []
        for level in range(min(levels_of(n), BLOCK_LEVELS)):
            nodes = np.arange(-(-leaves // FANOUT ** level))
            runs.append((FANOUT ** level, len(nodes), digests[places(level, nodes, leaves)].tobytes()))
        paths = []
        for at in (items["at"].to_numpy() % BLOCK).tolist():
            path = []
            for width, count, nodes in runs:
                own = at // width
                first = own - own % FANOUT
                last = min(first + FANOUT, count)
                path += [bytes((own - first, last - own - 1)), nodes[first * DIGEST:own * DIGEST], nodes[(own + 1) * DIGEST:last * DIGEST]]
            paths.append(b"".join(path) + above)
        return pa.table({**{c: items[c] for c in kept}, "path": pa.array(paths, pa.binary()),
                         "tops": pa.array([tops] * len(paths), pa.binary())})

    items = rows.select(*kept, F.expr(f"at div {BLOCK}").alias("block"))
    return items.groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block")).applyInArrow(read, schema)


def known_paths(tiers: list[DataFrame], given: DataFrame) -> DataFrame:
    """The lowest blocks with the ``path`` from their root up and ``tops``; ``given`` has both of each whole tree."""
    lower = None
    for tier in reversed(tiers):
        ends = tier.filter(F.col("n") <= BLOCK).join(given, "tree").withColumn("tops", F.concat("tops", "root"))
        ends = ends.select("tree", "block", "n", "log", "path", "tops")
        if lower is not None:
            inner = tier.filter(F.col("n") > BLOCK).select("tree", F.col("block").alias("at"), "n", "log")
            ends = ends.unionByName(siblings(inner, lower).withColumnRenamed("at", "block"))
        lower = stored(ends, "paths")
    return lower


def follow(df: DataFrame, digest: str, path: str, root: str, proof: str) -> DataFrame:
    """Add the root that a digest (hex text) and a path lead to, and the SHA-256 of all siblings of the path, as hex text."""
    own, way = df.columns.index(digest), df.columns.index(path)

    def climb(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[pa.Array]]]:
        for batch in batches:
            roots, proofs = [], []
            for node, steps in zip(batch.column(own).to_pylist(), batch.column(way).to_pylist()):
                node, at, parts = bytes.fromhex(node), 0, []
                while at < len(steps):
                    left, right = at + 2 + steps[at] * DIGEST, at + 2 + (steps[at] + steps[at + 1]) * DIGEST
                    parts.append(steps[at + 2:right])
                    node, at = joined(steps[at + 2:left] + node + steps[left:right]), right
                roots.append(node.hex())
                proofs.append(joined(b"".join(parts)).hex())
            yield batch, [pa.array(roots, pa.string()), pa.array(proofs, pa.string())]
        trim()

    return with_columns(df, climb, T.StructType([T.StructField(root, T.StringType()), T.StructField(proof, T.StringType())]))


def prove(rows: DataFrame, digest: str = "leaf", by: str = "lang", order: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Add ``path``, ``subroot`` and ``root`` to rows that have a leaf digest as hex text.

    The rows of one value of ``by`` (null is a value) are a tree, in ``order`` and then by digest, nulls first; the
    roots of these trees, in bytewise order of ``by``, null first, are the leaves of the tree above.
    """
    inner = rows.select(
        F.struct(*[named(c) for c in rows.columns]).alias("row"), *[named(c).alias(f"o{i}") for i, c in enumerate(order)],
        F.when(named(by).isNull(), "0").otherwise(F.concat(F.lit("1"), named(by).cast("string"))).alias("tree"),
        F.unhex(named(digest)).alias("digest"))
    # The digests are stored first: ranges are sampled from them, and texts are read once.
    leaves = stored(placed(stored(inner, "digests"), "tree", [*[f"o{i}" for i in range(len(order))], "digest"]), "placed")
    tiers = build(leaves)
    crown = roots(tiers).select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("root").alias("digest"))
    crown = stored(placed(crown, "tree", ["name"]), "subroots")
    top = build(crown)
    nothing = F.lit(b"")
    whole = roots(top).select("tree", nothing.alias("path"), nothing.alias("tops"))
    given = siblings(crown.select("tree", "at", "name"), known_paths(top, whole))
    given = stored(given.select(F.col("name").alias("tree"), "path", "tops"), "subroot_paths")
    found = siblings(leaves.select("tree", "at", "row"), known_paths(tiers, given))
    new = ["path", "subroot", "root"]
    return found.select(*[F.col("row").getField(c).alias(c) for c in rows.columns if c not in new], "path",
                        F.lower(F.hex(F.substring("tops", DIGEST + 1, DIGEST))).alias("subroot"),
                        F.lower(F.hex(F.substring("tops", 1, DIGEST))).alias("root"))
