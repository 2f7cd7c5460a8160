"""Shards by jump consistent hashing (Lamping and Veach).

A row's key and the number of shards alone decide its shard; no ring and no
table of shards is kept. With one more shard a row either stays or moves into
the new shard, so one row in ``shards + 1`` moves.

A null key counts as a key of its own. Rows that share a key share a shard, and
equal rows stand next to each other in it. Any number of rows in one shard is
numbered by ranges, not in one task. Texts and further columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeweave.llm.common import named, running_totals


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each 64-bit key among ``shards``, for all keys at once."""
    state = keys.astype(np.uint64)
    shard = np.zeros(len(state), np.int64)
    ahead = np.zeros(len(state), np.int64)
    open_ = np.arange(len(state))
    while len(open_):
        shard[open_] = ahead[open_]
        state[open_] = state[open_] * np.uint64(2862933555777941757) + np.uint64(1)
        step = float(1 << 31) / ((state[open_] >> np.uint64(33)).astype(np.float64) + 1.0)
        ahead[open_] = ((shard[open_] + 1) * step).astype(np.int64)
        open_ = open_[ahead[open_] < shards]
    return shard


def shard_of(key: Column, shards: int) -> Column:
    """Keys are hashed first, so that near ones do not jump alike."""
    if shards < 1:
        raise ValueError("at least one shard is needed")

    @F.pandas_udf("int")
    def jumped(hashes: pd.Series) -> pd.Series:
        return pd.Series(jump(hashes.to_numpy(), shards).astype(np.int32))

    return jumped(F.xxhash64(key))


def assign(df: DataFrame, key: str, shards: int, order: tuple[str, ...] = ()) -> DataFrame:
    """Add ``shard``, ``slot`` (from 0 without gaps in each shard, by key and ``order``) and
    ``grown_shard``, the shard with one more of them; columns of these names are replaced."""
    new = ["shard", "slot", "grown_shard"]
    marked = df.select(F.struct(*[named(c) for c in df.columns]).alias("row"), shard_of(named(key), shards).alias("shard"),
                       shard_of(named(key), shards + 1).alias("grown_shard"), F.lit(1).cast("long").alias("one"),
                       *[named(c).alias(f"o{i}") for i, c in enumerate((key, *order))])
    placed = running_totals(marked, ["shard", *[f"o{i}" for i in range(len(order) + 1)]], {"position": "one"}, "shards")
    sizes = placed.groupBy("shard").agg(F.count("*").alias("rows_in_shard"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    # One row per shard.
    starts = sizes.select("shard", F.coalesce(F.sum("rows_in_shard").over(earlier), F.lit(0)).alias("first"))
    joined = placed.join(F.broadcast(starts), "shard")
    return joined.select(*[F.col("row").getField(c).alias(c) for c in df.columns if c not in new], "shard",
                         (F.col("position") - F.col("first")).alias("slot"), "grown_shard")
