"""Equi-joins to lookups and between keyed tables.

None of these gives a broadcast hint. Spark compares each side with
``spark.sql.autoBroadcastJoinThreshold`` when it plans and again, under AQE, with
its measured size; a larger side is shuffled, and AQE then splits a key that
holds too many rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeweave.operators.dedupe import require_unique
from lakeweave.operators.shape import quoted


def lookup(df: DataFrame, known: DataFrame, left_key: str, right_key: str,
           columns: dict[str, str], drop: Sequence[str] = ()) -> DataFrame:
    """Left join on differently named keys.

    ``columns`` maps the names of ``known`` to the new ones; an unmatched row
    gets nulls. The key of ``known``, and the names in ``drop``, do not remain.
    """
    side = known.select(F.col(right_key).alias("__key"),
                            *[F.col(c).alias(n) for c, n in columns.items()])
    joined = df.join(side, df[left_key] == side["__key"], "left")
    return joined.drop("__key", *drop)


def many_to_one(fact: DataFrame, dimension: DataFrame, fact_key: str, dim_key: str,
                columns: dict[str, str], label: str = "dimension") -> DataFrame:
    """Lookup in a dimension whose key is checked to be unique, so no fact row multiplies."""
    needed = dimension.select(dim_key, *[c for c in columns if c != dim_key])
    return lookup(fact, require_unique(needed, [dim_key], label), fact_key, dim_key, columns)


def attach(readings: DataFrame, metadata: DataFrame, key: str) -> DataFrame:
    """Inner join: readings with the metadata of their source."""
    return readings.join(metadata, key, "inner")


def _keyed(existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys alone, without null ones, which would meet in one shuffle
    partition and match nothing."""
    present = existing.select(*[F.col(quoted(k)) for k in keys])
    for key in keys:
        present = present.filter(F.col(quoted(key)).isNotNull())
    return present


def missing_keys(df: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key does not exist yet."""
    return df.join(_keyed(existing, keys), list(keys), "left_anti")


def unseen(unique: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``missing_keys`` for rows that an aggregate has made unique by ``keys``.

    An anti join would be moved below that aggregate and shuffle every copy of a
    hot key. The outer join stays above it and reuses its partitioning.
    """
    marked = _keyed(existing, keys).withColumn("__seen", F.lit(True))
    joined = unique.join(marked, list(keys), "left").filter(F.col("__seen").isNull())
    return joined.select([F.col(quoted(c)) for c in unique.columns])


def drill_across(parts: Sequence[DataFrame], by: Sequence[str]) -> DataFrame:
    """Aggregates of several facts, side by side on shared keys.

    Each part holds one row per ``by`` and its own measures. A union and a
    second grouping act as a full outer join that also matches null keys, and
    only already aggregated rows are shuffled.
    """
    measures = [(c, p.schema[c].dataType) for p in parts for c in p.columns if c not in by]
    padded = [
        p.select(*by, *[(F.col(quoted(c)) if c in p.columns else F.lit(None).cast(t)).alias(c)
                        for c, t in measures])
        for p in parts
    ]
    merged = padded[0]
    for other in padded[1:]:
        merged = merged.unionByName(other)
    tops = [F.max(quoted(c)).alias(c) for c, _ in measures]
    return merged.groupBy(*by).agg(*tops) if by else merged.agg(*tops)
