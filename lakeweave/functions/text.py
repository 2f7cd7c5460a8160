"""Numbers and ranges as text, in the formats the reports use."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def thousands(number: Column, decimals: int = 0) -> Column:
    return F.format_number(number, decimals)


def currency(number: Column, symbol: str = "$", decimals: int = 2, gap: str = "",
             negative: str = "sign") -> Column:
    """``$1,234.50``; negatives as ``-$1.00`` or, with ``parentheses``, ``($1.00)``."""
    amount = F.concat(F.lit(symbol + gap), F.format_number(F.abs(number), decimals))
    if negative == "parentheses":
        below = F.concat(F.lit("("), amount, F.lit(")"))
    else:
        below = F.concat(F.lit("-"), amount)
    return F.when(number < 0, below).otherwise(amount)


def with_unit(number: Column, decimals: int, unit: str, grouped: bool = False) -> Column:
    """``12.30 mi``, without thousands separators unless ``grouped``."""
    text = F.format_number(number, decimals)
    if not grouped:
        text = F.replace(text, F.lit(","), F.lit(""))
    return F.concat(text, F.lit(unit))


def percent(part: Column, whole: Column, decimals: int = 1) -> Column:
    ratio = F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0))
    return with_unit(ratio, decimals, "%")


def span(low: Column, high: Column, sep: str = " to ") -> Column:
    """``low to high`` from two aggregates; ``N/A`` when there was no row."""
    return F.when(low.isNull() | high.isNull(), F.lit("N/A")).otherwise(
        F.concat(low.cast("string"), F.lit(sep), high.cast("string")))


def truncated(text: Column, limit: int = 900, mark: str = "... [Truncated]") -> Column:
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit(mark))).otherwise(text)
