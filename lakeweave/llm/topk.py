"""Exact top-k search by inner product with MaxScore.

The dimensions are the terms. Within a shard of vectors a term has a largest and
a smallest value, so a query bounds what a term can add. Terms are taken in
order of that bound. The essential ones are traversed for all vectors of the
shard; the others only probe vectors whose sum so far, with the bounds of what
is still to come, can reach the k-th best score. As scores come in, the k-th
best rises and fewer vectors are probed. The best of all shards are merged.

Queries and vectors meet in cells of one block of queries and one shard of
vectors; each side is copied once per block of the other, and a cell has a
bounded number of both.

Vectors that are null or hold null or non-finite components take no part, as
queries or as candidates. Shorter vectors count as filled up with zeros. Equal
vectors tie, and ties go to the smaller id. A vector is never its own answer,
nor are rows that share its id. Fewer than k candidates give all there are.
Rows are candidates: one that is repeated can fill several ranks, and so can its
answers if a query is repeated, as in a join of the two tables.
Scores are 64-bit integers, so components must be small enough for that.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeweave.llm.common import named, stored


def whole_parts(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) for each component, null for vectors that take no part."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(sound, F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))))


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of integers, filled up with zeros to ``width``."""
    column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = values
    return out


class Shard:
    """Vectors by term, with the bounds of each term."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.terms = ids[order], np.ascontiguousarray(vectors[order].T)
        self.low, self.high = self.terms.min(axis=1), self.terms.max(axis=1)

    def best(self, query: np.ndarray, own_id: int, k: int, step: int = 8) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best, by score and then id."""
        most = np.where(query > 0, query * self.high, query * self.low)
        least = np.where(query > 0, query * self.low, query * self.high)
        order = np.argsort(least - most, kind="stable")
        order = order[most[order] != least[order]]
        fixed = int(most.sum() - most[order].sum())
        rest_most = np.concatenate([np.cumsum(most[order][::-1])[::-1], [0]])
        alive = np.flatnonzero(self.ids != own_id)
        if len(alive) <= k:
            scores = query @ self.terms[:, alive]
            return self.ranked(alive, scores, k)
        sums, whole = np.full(len(self.ids), fixed, np.int64), True
        limit = None
        for start in range(0, len(order), step):
            part = order[start:start + step]
            for term in part:
                # Essential terms run over their whole list, the others probe what is left.
                if whole:
                    sums += query[term] * self.terms[term]
                else:
                    sums += query[term] * self.terms[term, alive]
            if whole:
                sums = sums[alive]
                whole = False
            rest = rest_most[min(start + step, len(order))]
            # The k leading so far, scored in full, give a k-th best that no answer falls below.
            lead = np.argpartition(-sums, k - 1)[:k] if len(sums) > k else np.arange(len(sums))
            full = query @ self.terms[:, alive[lead]]
            kth = int(full.min()) if len(lead) == k else None
            limit = kth if limit is None else max(limit, kth) if kth is not None else limit
            if limit is not None:
                keep = sums + rest >= limit
                alive, sums = alive[keep], sums[keep]
        return self.ranked(alive, sums[alive] if whole else sums, k)

    def ranked(self, rows: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((self.ids[rows], -scores))[:k]
        return self.ids[rows[order]], scores[order]


def search(vectors: DataFrame, queries: DataFrame, k: int, vec_id: str = "vec_id", vector: str = "vector",
           shard_rows: int = 8192, query_rows: int = 1024) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score`` of the k best vectors of each query.

    Both tables hold ``vec_id`` and integer components in ``vector``.
    """
    def sound(df: DataFrame) -> DataFrame:
        return df.select(named(vec_id).cast("long").alias("id"), named(vector).cast("array<long>").alias("v")).filter(
            "id IS NOT NULL AND v IS NOT NULL")

    vectors, queries = stored(sound(vectors), "vectors"), stored(sound(queries), "queries")
    sizes = vectors.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("w")).first()
    asked = queries.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("w")).first()
    width = max(sizes["w"] or 0, asked["w"] or 0)
    shards, blocks = max(1, math.ceil(sizes["n"] / shard_rows)), max(1, math.ceil(asked["n"] / query_rows))

    # A salt deals equal ids and equal vectors out like any others.
    dealt = lambda n: F.pmod(F.xxhash64("id", "v", F.monotonically_increasing_id()), F.lit(n)).cast("int")
    left = stored(queries.withColumn("block", dealt(blocks)), "queries").withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    right = stored(vectors.withColumn("shard", dealt(shards)), "vectors").withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def meet(asked: pa.Table, held: pa.Table) -> pa.Table:
        out = []
        if asked.num_rows and held.num_rows and width:
            shard = Shard(held["id"].to_numpy(), matrix(held["v"], width).astype(np.int64))
            for own_id, query in zip(asked["id"].to_pylist(), matrix(asked["v"], width).astype(np.int64)):
                ids, scores = shard.best(query, own_id, k)
                out.append((np.full(len(ids), own_id), ids, scores))
        columns = [np.concatenate(c).astype(np.int64) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 3
        return pa.table(dict(zip(("query_id", "vec_id", "score"), columns)))

    cells = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInArrow(
        meet, "query_id long, vec_id long, score long")
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    # k rows per query row and shard come together.
    best = cells.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
    return best.select("query_id", "rank", F.col("vec_id").alias(vec_id), "score")
