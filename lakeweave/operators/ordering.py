"""Sorted and limited results. A sort with a limit is planned as a top-k, which
keeps k rows per task and never sorts the whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_rows(df: DataFrame, order: Sequence[str], n: int, tie_break: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(*order, *tie_break).limit(n)


def top_groups(df: DataFrame, group: str, n: int = 10, name: str = "count") -> DataFrame:
    """The ``n`` largest groups; equal counts are ordered by the group."""
    counted = df.groupBy(group).agg(F.count(F.lit(1)).alias(name))
    return counted.orderBy(F.desc(name), F.asc(group)).limit(n)
