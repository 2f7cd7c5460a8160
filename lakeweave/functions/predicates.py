"""Row predicates written so that Parquet can skip row groups on them."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def all_positive(*columns: Column) -> Column:
    """All above zero. NaN, which Spark orders above infinity, is not."""
    return reduce(and_, [(c > 0) & (c.cast("double") <= float("inf")) for c in columns])


def years_in(column: Column, years: Iterable[int]) -> Column:
    """``year(column) IN (years)`` as half-open ranges, one per run of years.

    A range on the column itself reaches the scan; a call to ``year`` does not.
    """
    wanted = sorted(set(years))
    if not wanted:
        raise ValueError("no year given")
    runs: list[list[int]] = []
    for year in wanted:
        if runs and year == runs[-1][1] + 1:
            runs[-1][1] = year
        else:
            runs.append([year, year])
    return reduce(or_, [
        (column >= F.lit(f"{first:04d}-01-01")) & (column < F.lit(f"{last + 1:04d}-01-01"))
        for first, last in runs
    ])


def non_negative(number: Column) -> Column:
    """``>= 0`` without NaN, which Spark orders above every number."""
    return (number >= 0) & ~F.isnan(number)


def between_days(column: Column, first: str, last: str, end_inclusive_day: bool = False) -> Column:
    """Timestamp between two days given as text.

    The upper bound is midnight of ``last``, so that day itself is lost but for
    00:00:00; ``end_inclusive_day`` keeps the whole of it.
    """
    if end_inclusive_day:
        return (column >= F.lit(first)) & (column < F.date_add(F.lit(last).cast("date"), 1))
    return (column >= F.lit(first)) & (column <= F.lit(last))


def open_closed(column: Column, low: Column, high: Column) -> Column:
    return (column > low) & (column <= high)


def outside(number: Column, low=None, high=None, strict_low: bool = False) -> Column:
    """Non-null value out of bounds; each bound is optional, null is never outside."""
    parts = []
    if low is not None:
        parts.append(number <= low if strict_low else number < low)
    if high is not None:
        parts.append(number > high)
    if not parts:
        raise ValueError("give at least one bound")
    return F.coalesce(reduce(or_, parts), F.lit(False))
