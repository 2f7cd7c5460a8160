"""Projection operators. Each one is a single ``select``, so plans stay flat."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def project(df: DataFrame, spec: Mapping[str, tuple[str, str] | str]) -> DataFrame:
    """Select, cast and rename. ``spec`` maps a target name to ``source`` or
    ``(source, type)``; a value that does not fit its type becomes null."""
    columns = []
    for target, source in spec.items():
        name, kind = source if isinstance(source, tuple) else (source, None)
        column = F.col(quoted(name))
        columns.append((column if kind is None else column.try_cast(kind)).alias(target))
    return df.select(columns)


def lower_names(df: DataFrame) -> DataFrame:
    lowered = [c.lower() for c in df.columns]
    if len(set(lowered)) != len(lowered):
        raise ValueError(f"names collide in lower case: {df.columns}")
    return df.toDF(*lowered)


def conform(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Exactly the contract's columns, in its order and types.

    Names match without regard to case, extra columns go, missing ones are added
    as typed nulls (a missing time is a null timestamp, so the union still works).
    """
    present = {}
    for name in df.columns:
        if name.lower() in present:
            raise ValueError(f"names collide in lower case: {df.columns}")
        present[name.lower()] = name
    return df.select([
        (F.col(quoted(present[field.name.lower()])).try_cast(field.dataType)
         if field.name.lower() in present else F.lit(None).cast(field.dataType)).alias(field.name)
        for field in contract
    ])


def retype(df: DataFrame, types: Mapping[str, str | T.DataType]) -> DataFrame:
    return df.withColumns({n: F.col(quoted(n)).try_cast(t) for n, t in types.items()})


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def with_parts(df: DataFrame, source: str, parts: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
    """Derived columns of one source column, e.g. ``{"hour": F.hour}``."""
    return df.withColumns({name: f(F.col(quoted(source))) for name, f in parts.items()})


def for_each_column(df: DataFrame, expression: Callable[[str], Column]) -> DataFrame:
    """The same aggregate over every column, in one pass."""
    return df.agg(*[expression(c).alias(c) for c in df.columns])


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
