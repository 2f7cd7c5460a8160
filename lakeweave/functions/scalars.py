"""Scalar column expressions. All stay inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def date_key(day: Column) -> Column:
    """Date or timestamp to the integer ``yyyyMMdd``, by arithmetic instead of text."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def utc_day(time: Column, kind: T.DataType) -> Column:
    """The day a row is stored under. For instants it is the UTC day, so sessions
    in different time zones agree on it."""
    if isinstance(kind, T.TimestampType):
        return F.date_from_unix_date(F.floor(F.unix_seconds(time) / 86400).cast("int"))
    return F.to_date(time)


def strip_text(text: Column, mark: str = "/") -> Column:
    return F.replace(text, F.lit(mark), F.lit(""))


def date_prefix(text: Column) -> Column:
    """The first ten characters; an empty text becomes null."""
    return F.nullif(F.substring(text, 1, 10), F.lit(""))


def nan_to_null(number: Column) -> Column:
    return F.when(~F.isnan(number), number)


def is_missing(column: Column, data_type: str) -> Column:
    """Null, or NaN for floating-point columns, where a NaN also stands for a gap."""
    if data_type in ("double", "float"):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def minutes_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", start, end) / F.lit(60.0)


def weekend_flag(day: Column) -> Column:
    return F.when(F.dayofweek(day).isin(1, 7), 1).otherwise(0)


def month_name(day: Column) -> Column:
    return F.date_format(day, "MMMM")


def day_name(day: Column) -> Column:
    return F.date_format(day, "EEEE")


def iso_utc(instant: Column) -> Column:
    """A timestamp as ISO text in UTC, whatever the session time zone."""
    utc = F.to_utc_timestamp(instant, F.current_timezone())
    return F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def local_clock(instant: Column, zone: str | Column) -> Column:
    """Wall-clock time of an instant in ``zone``.

    Both autumn hours map to one value, so use it for hour and date columns
    only and keep the instant as the key.
    """
    target = zone if isinstance(zone, Column) else F.lit(zone)
    return F.convert_timezone(F.current_timezone(), target, instant.cast("timestamp_ntz"))
