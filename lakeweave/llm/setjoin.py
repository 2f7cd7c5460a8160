"""Similarity join of documents on word shingles, exact, with prefix lists and groups.

Shingles are put in one order, the rarest first, so that two sets as similar as
asked share one of their first few (prefix filter). Lists of these shingles hold
their sets by size and by position of the shingle. Size and position bound the
overlap of two entries: lists are in order of size, so an entry is done past the
largest that fits; positions are tested on each pair up to there. Counts of
shingles in a fixed number of bins bound it again, before whole sets are compared.

Sets that are equal are one set from the start. The others are compared in two
rounds. First each entry of a list meets the first entry of its list and its
neighbour only: near copies of one text are joined by a few comparisons each.
What such a set is linked with follows for the others of its group, so in the
second round two entries meet only if they are not yet in one group. No link
that would join two groups is left out, and no group is compared pair by pair.

Texts without words have an empty set and link with nothing; they and null
texts are groups of their own. Texts of fewer words than a shingle are one
shingle. Equal rows are in one group. Rows that share an id count as linked. A
null id counts as smaller than all others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeweave.llm.common import arrow_schema, dropped, named, shuffle_partitions, sliced, stored, trim, utf8
from lakeweave.llm.components import contract
from lakeweave.llm.shingles import mix, shingles
from lakeweave.llm.wordblocks import pack_rows, unpack_rows

BINS = 128
NO_ID = -(1 << 63)
SLICE = 2 << 20


def frequent(docs: DataFrame, words: int, most: int) -> np.ndarray:
    """Up to ``most`` frequent shingles, the rarer first. Only the order of the search rests on them.

    Every batch counts the shingles of its different sets and names those of at
    least two, at most ``most`` of them.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, seen = [], set()
            for part in sliced([batch], "text", SLICE):
                found, owner = shingles(*utf8(part.column("text")), words)
                sizes = np.bincount(owner, minlength=part.num_rows)
                ends = np.cumsum(sizes)
                total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(found), dtype=np.uint64)])
                marks = list(zip((total[ends] - total[ends - sizes]).tolist(), sizes.tolist()))
                fresh = np.array([m not in seen and not seen.add(m) for m in marks], bool)
                parts.append(found[fresh[owner]])
            if parts:
                values, counts = np.unique(np.concatenate(parts), return_counts=True)
                often = np.flatnonzero(counts >= 2)
                often = often[np.argsort(-counts[often], kind="stable")[:most]]
                yield pa.RecordBatch.from_arrays([pa.array(values[often].view(np.int64)), pa.array(counts[often])], ["shingle", "n"])
        trim()

    top = docs.select("text").mapInArrow(count, "shingle long, n long").groupBy("shingle").agg(
        F.sum("n").alias("n")).orderBy(F.desc("n"), "shingle").limit(most)
    return top.toArrow()["shingle"].to_numpy()[::-1].view(np.uint64)


def signatures(docs: DataFrame, common: np.ndarray, words: int, pct: int) -> DataFrame:
    """For every row: size, two sums that tell its set, its first shingles in search order, and its bins."""
    order = np.argsort(common)
    values, ranks = common[order], order.astype(np.uint64)
    made = arrow_schema("id long,n long,s1 long,s2 long,prefix binary,bins binary")

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", SLICE):
            found, owner = shingles(*utf8(batch.column("text")), words)
            rows = batch.num_rows
            sizes = np.bincount(owner, minlength=rows)
            ends = np.cumsum(sizes)
            sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(found ^ salt), dtype=np.uint64)])
                    for salt in (np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F))]
            sums = [(s[ends] - s[ends - sizes]).view(np.int64) for s in sums]
            bins = np.bincount(owner * BINS + (found % np.uint64(BINS)).astype(np.int64), minlength=rows * BINS)
            bins = np.minimum(bins, 255).astype(np.uint8).reshape(rows, BINS)
            keys = found >> np.uint64(1)
            if len(values):
                at = np.minimum(np.searchsorted(values, found), len(values) - 1)
                often = values[at] == found
                keys[often] = np.uint64(1 << 63) | ranks[at[often]]
            keys = keys[np.lexsort((keys, owner))]
            first = sizes - -(-sizes * pct // 100) + 1
            prefix = [keys[e - n:e - n + min(k, n)].tobytes() for e, n, k in zip(ends.tolist(), sizes.tolist(), first.tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sizes.astype(np.int64)), pa.array(sums[0]), pa.array(sums[1]),
                 pa.array(prefix, pa.binary()), pa.array([b.tobytes() for b in bins], pa.binary())], schema=made)
        trim()

    return docs.mapInArrow(sign, "id long, n long, s1 long, s2 long, prefix binary, bins binary")


def least_overlap(m: np.ndarray, n: np.ndarray, pct: int) -> np.ndarray:
    """The overlap from which sets of m and n shingles are as similar as asked."""
    return -(-pct * (m + n) // (100 + pct))


def candidates(sets: DataFrame, pct: int, every_pair: bool, list_entries: int = 250_000, leaders: int = 2) -> DataFrame:
    """Pairs ``a`` < ``b`` of nodes of different ``root`` that may be similar.

    ``sets`` has ``node``, ``n``, ``prefix`` and ``root``. Without ``every_pair``
    an entry of a list meets its neighbour and the ``leaders`` of the list only.
    """
    entries = sets.agg(F.sum(F.octet_length("prefix") / 8)).first()[0] or 0
    buckets = max(shuffle_partitions(sets.sparkSession), int(entries // list_entries) + 1)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "prefix", SLICE):
            prefix = [np.frombuffer(p, np.uint64) for p in batch.column("prefix").to_pylist()]
            sizes = np.array([len(p) for p in prefix], np.int64)
            if not sizes.sum():
                continue
            keys = np.concatenate(prefix)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            place = np.arange(len(keys)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            bucket = (mix(keys) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            columns = [keys.view(np.int64), *[batch.column(c).to_numpy()[owner] for c in ("node", "root", "n")], place]
            starts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
            packed = [pack_rows(pa.RecordBatch.from_arrays([pa.array(c[own]) for c in columns], ["key", "node", "root", "n", "place"]))
                      for own in np.split(order, starts[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(bucket[order[starts]], pa.int32()), pa.array(packed, pa.binary())],
                                             ["bucket", "entries"])
        trim()

    def meet(table: pa.Table) -> pa.Table:
        rows = pa.Table.from_batches([unpack_rows(p) for p in table["entries"].to_pylist()])
        key, node, root, n, place = [c.to_numpy() for c in rows.columns]
        order = np.lexsort((node, place, n, key))
        key, node, root, n, place = key[order], node[order], root[order], n[order], place[order]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        start = np.flatnonzero(new)
        run = np.cumsum(new) - 1
        found = []

        def add(i: np.ndarray, j: np.ndarray) -> None:
            m, k = n[i], n[j]
            fits = (root[i] != root[j]) & (m * 100 >= k * pct) & (k * 100 >= m * pct)
            fits &= 1 + np.minimum(m - place[i] - 1, k - place[j] - 1) >= least_overlap(m, k, pct)
            i, j = i[fits], j[fits]
            found.append(np.stack([np.minimum(node[i], node[j]), np.maximum(node[i], node[j])], axis=1))

        if every_pair:
            at, step = np.arange(len(key)), 1
            while True:
                at = at[at + step < len(key)]
                # Lists are in order of size: past the largest that fits, an entry is done.
                at = at[(run[at + step] == run[at]) & (n[at] * 100 >= n[at + step] * pct)]
                if not len(at):
                    break
                add(at, at + step)
                step += 1
        else:
            later = np.flatnonzero(~new)
            add(later - 1, later)
            # The sets with the fewest rarer shingles come before their edited copies.
            lead = np.lexsort((node, n, place, run))
            for step in range(leaders):
                at = start[run] + step
                at = np.flatnonzero((at < len(key)) & (run[np.minimum(at, len(key) - 1)] == run))
                add(lead[start[run[at]] + step], at)
        pairs = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)
        del rows, found
        trim()
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    asked = sets.select("node", "root", "n", "prefix").mapInArrow(pack, "bucket int, entries binary")
    return asked.groupBy("bucket").applyInArrow(meet, "a long, b long").distinct()


def bounded(pairs: DataFrame, sets: DataFrame, pct: int) -> DataFrame:
    """The pairs whose bins leave room for the overlap that is asked."""
    bins = sets.select("node", "n", "bins")
    joined = pairs.join(bins.select(F.col("node").alias("a"), F.col("n").alias("m"), F.col("bins").alias("x")), "a").join(
        bins.select(F.col("node").alias("b"), F.col("n").alias("k"), F.col("bins").alias("y")), "b")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m, k = batch.column("m").to_numpy(), batch.column("k").to_numpy()
            x, y = [np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, BINS).astype(np.int16) for c in "xy"]
            apart = np.abs(x - y).sum(axis=1, dtype=np.int64)
            fits = (m + k - apart) // 2 >= least_overlap(m, k, pct)
            yield batch.select(["a", "b"]).filter(pa.array(fits))

    return joined.mapInArrow(keep, "a long, b long")


def linked(pairs: DataFrame, docs: DataFrame, words: int, pct: int, most_broadcast: int) -> DataFrame:
    """The pairs whose sets, made again from the texts, are as similar as asked; they are stored, the sets are not kept."""
    steps: list[str] = []
    nodes = stored(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "nodes", steps)
    # Ids are eight bytes each: up to the bound they go to every task, beyond it both sides are shuffled.
    asked = F.broadcast(nodes) if nodes.count() <= most_broadcast else nodes
    texts = docs.join(asked, "id", "left_semi")

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", SLICE):
            found, owner = shingles(*utf8(batch.column("text")), words)
            ends = np.cumsum(np.bincount(owner, minlength=batch.num_rows))
            sets = [found[s:e].tobytes() for s, e in zip([0, *ends[:-1].tolist()], ends.tolist())]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sets, pa.binary())], ["id", "set"])
        trim()

    sets = stored(texts.select("id", "text").mapInArrow(made, "id long, set binary"), "sets", steps)
    joined = pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("x")), "a").join(
        sets.select(F.col("id").alias("b"), F.col("set").alias("y")), "b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fits = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                fits.append(100 * common >= pct * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(fits, pa.bool_()))
        trim()

    found = stored(joined.mapInArrow(compare, "a long, b long"), "links")
    dropped(docs.sparkSession, steps)
    return found


def groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3, pct: int = 90,
           most_frequent: int = 1 << 18, most_broadcast: int = 1 << 20) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id``, the smallest id reachable by links, for every row.

    ``most_frequent`` bounds the shingles that get a place in the order by
    frequency, ``most_broadcast`` the ids that are sent to every task. The result
    is stored; the larger steps before it are gone by then.
    """
    spark, steps = docs.sparkSession, []
    docs = docs.select(F.coalesce(named(doc_id).cast("long"), F.lit(NO_ID)).alias("id"), named(text).alias("text"))
    common = frequent(docs, words, most_frequent)
    rows = stored(signatures(docs, common, words, pct), "signatures", steps)
    own = ["s1", "s2", "n"]
    classes = rows.filter("n > 0").groupBy(*own).agg(F.min(F.struct("id", "prefix", "bins")).alias("first"))
    sets = stored(classes.select(*own, F.col("first.id").alias("node"), "first.prefix", "first.bins"), "sets", steps)
    # One class each for the rows that share an id.
    ids = rows.filter("n > 0").select("id", *own).join(sets.select(*own, "node"), own).select("id", "node")
    links = ids.filter("id <> node").select(F.col("id").alias("a"), F.col("node").alias("b"))

    first = stored(bounded(candidates(sets.withColumn("root", F.col("node")), pct, False), sets, pct), "pairs")
    near = linked(first, docs, words, pct, most_broadcast)
    roots = contract(near)
    rooted: list[str] = []
    merged = stored(sets.select("node", "n", "prefix").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "merged", rooted)
    second = stored(bounded(candidates(merged, pct, True), sets, pct).join(first, ["a", "b"], "left_anti"), "pairs")
    dropped(spark, rooted)
    if not second.isEmpty():
        near = near.unionByName(linked(second, docs, words, pct, most_broadcast))
    # Rows with one id tie their classes together.
    shared = links.join(links.groupBy("a").agg(F.count_distinct("b").alias("kinds")).filter("kinds > 1").select("a"), "a")
    ties = shared.unionByName(sets.select(F.col("node").alias("a")).join(
        ids.filter("id <> node").select(F.col("id").alias("a"), "node"), "a").select("a", F.col("node").alias("b")))
    found = stored(contract(near.unionByName(ties)), "roots")
    done = rows.join(sets.select(*own, "node"), own, "left").join(found, "node", "left")
    root = F.coalesce("root", "node", "id")
    shown = lambda c: F.when(c != NO_ID, c)
    made = stored(done.select(shown(F.col("id")).alias(doc_id), F.col("n").alias("n_shingles"), shown(root).alias("component_id")), "groups")
    dropped(spark, steps)
    return made
