"""Dates, date keys and times of day."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starling.functions.columns import col_of


def parse_day(c: str | Column) -> Column:
    """ISO date or ISO timestamp text to a date; anything else gives NULL.

    The leading year is required because Spark reads a bare time of day as a
    moment of the current day.
    """
    text = col_of(c).cast("string")
    return F.when(text.rlike(r"^\s*\d{4}-"), F.try_to_timestamp(text)).cast("date")


def as_day(c: str | Column, dtype: T.DataType) -> Column:
    """Date of a column of the given type: text is parsed, dates and timestamps are cut."""
    if isinstance(dtype, T.StringType):
        return parse_day(c)
    return col_of(c).cast("date")


def day_key(day: str | Column) -> Column:
    """``yyyyMMdd`` as a long, from a date column."""
    d = col_of(day)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("long")


def date_key(c: str | Column) -> Column:
    """``yyyyMMdd`` of date text; NULL for text that is no date."""
    return day_key(parse_day(c))


def pattern_day(c: str | Column, pattern: str = "d-M-yyyy") -> Column:
    return F.try_to_timestamp(col_of(c), F.lit(pattern)).cast("date")


def years_since(day: str | Column, reference_year: int) -> Column:
    """Calendar years between a date and the given year."""
    return F.lit(reference_year) - F.year(col_of(day))


def seconds_of_day(c: str | Column) -> Column:
    """``HH:mm`` or ``HH:mm:ss`` text to seconds; other text gives NULL."""
    text = col_of(c)
    part = lambda i: F.regexp_extract(text, r"^(\d{1,2}):(\d{2})(?::(\d{2}))?$", i)
    seconds = F.coalesce(part(3).try_cast("int"), F.lit(0))
    return part(1).try_cast("int") * 3600 + part(2).try_cast("int") * 60 + seconds


def duration_seconds(start: str | Column, end: str | Column) -> Column:
    """Seconds from start to end, the end being at most one midnight later."""
    return F.pmod(seconds_of_day(end) - seconds_of_day(start), F.lit(86400))
