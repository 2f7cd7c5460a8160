"""JSON exports: one array for a short result, lines for a whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def json_array(df: DataFrame, order: Sequence[str], limit: int = 100) -> DataFrame:
    """The first ``limit`` rows as one JSON array, dates as text: one row, ``json``.

    The limit is what makes a single document sound; use ``export_lines`` for
    more. Null fields are written, not left out.
    """
    dates = {name for name, kind in df.dtypes if kind in ("date", "timestamp", "timestamp_ntz")}
    record = F.to_json(F.struct(*[
        (F.col(c).cast("string") if c in dates else F.col(c)).alias(c) for c in df.columns
    ]), {"ignoreNullFields": "false"})
    top = df.orderBy(*order).limit(limit).select(*order, record.alias("__json"))
    rows = F.sort_array(F.collect_list(F.struct(*order, "__json")))
    return top.agg(F.concat(F.lit("["), F.array_join(F.transform(rows, lambda r: r["__json"]), ","),
                            F.lit("]")).alias("json"))


def export_json(df: DataFrame, path: str, order: Sequence[str], limit: int = 100) -> None:
    json_array(df, order, limit).write.mode("overwrite").text(path)


def export_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
