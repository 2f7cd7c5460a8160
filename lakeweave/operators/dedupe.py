"""Duplicates: exact rows, rows of one key, and their counts.

Every operator combines on the map side before it shuffles, so copies of a hot
key collapse where they are read and no key's rows meet in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def exact(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def first_by_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key: the smallest by ``order_by``, then by the other columns.

    ``min`` of a struct is a partial aggregate, unlike ``row_number`` over the
    key, and picks the same row on every run, unlike ``dropDuplicates(keys)``.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates()
    ranked = [*order_by, *[c for c in rest if c not in order_by]]
    return (df.groupBy(*keys)
            .agg(F.min(F.struct(*[F.col(f"`{c}`") for c in ranked])).alias("__first"))
            .select([F.col(f"`{c}`") if c in keys else F.col("__first")[c].alias(c)
                     for c in df.columns]))


def key_counts(df: DataFrame, keys: Sequence[str], name: str = "count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one row, and their row counts."""
    return key_counts(df, keys).filter(F.col("count") > 1)


def duplicate_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row, ``duplicates``: the rows beyond the first of each key."""
    counted = key_counts(df, keys, "__n")
    return counted.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("duplicates"))


def require_unique(df: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """The same rows; the query fails where a key occurs twice.

    The check is a scalar subquery in a filter, so it costs no job of its own
    and leaves the rows as they were scanned: a small side keeps its size
    estimate and is broadcast, and AQE can still split a skewed join on it.
    Null keys may repeat, as they join nothing.
    """
    keyed = df.select(*keys)
    for key in keys:
        keyed = keyed.filter(F.col(key).isNotNull())
    shown = F.any_value(F.concat_ws(", ", *[F.col(k).cast("string") for k in keys]))
    failure = F.raise_error(F.concat(F.lit(f"{label}: key occurs more than once: "), F.col("shown")))
    verdict = (repeated_keys(keyed, keys).agg(shown.alias("shown"))
               .select(F.when(F.col("shown").isNull(), F.lit(True)).otherwise(failure.cast("boolean"))))
    return df.filter(verdict.scalar())
