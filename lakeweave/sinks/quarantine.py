"""Records that do not fit, kept aside with the reason."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeweave.operators.shape import quoted, retype
from lakeweave.session import stored
from lakeweave.sinks.tables import save_table


def _unfit(types: Mapping[str, str]) -> dict[str, Column]:
    return {name: F.col(quoted(name)).isNotNull() & F.col(quoted(name)).try_cast(kind).isNull()
            for name, kind in types.items()}


def split(df: DataFrame, types: Mapping[str, str], keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)``: rows whose values all fit ``types``, typed, and the keys
    of the others with an ``error`` text. Null values fit."""
    tests = _unfit(types)
    any_unfit = reduce(lambda a, b: a | b, tests.values())
    reasons = [F.when(test, F.concat(F.lit(f"{name}: cannot read '"), F.col(quoted(name)).cast("string"),
                                     F.lit(f"' as {types[name]}")))
               for name, test in tests.items()]
    good = retype(df.filter(~any_unfit), types)
    bad = df.filter(any_unfit).select(*keys, F.concat_ws("; ", *reasons).alias("error"))
    return good, bad


def save_errors(bad: DataFrame, table: str, path: str | None = None) -> bool:
    """Write ``<table>_errors`` if there is any bad record. The records are worked out once and stored."""
    bad = stored(bad, "errors")
    if bad.isEmpty():
        return False
    save_table(bad, f"{table}_errors", path=path)
    return True
