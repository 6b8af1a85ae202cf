"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import col

OPEN_START = "1900-01-01 00:00:00"
OPEN_END = "9999-12-31 00:00:00"
EPOCH_BOUNDS = (-62_135_596_800, 253_402_300_799)


def local_datetime(c: Column | str) -> Column:
    """Zone-less time from text, NULL when unreadable."""
    return F.trim(col(c)).try_cast("timestamp_ntz")


def utc_from_epoch(c: Column | str) -> Column:
    """Epoch seconds to UTC time; NULL outside the years 1 to 9999, as for microseconds taken for seconds."""
    seconds = col(c)
    return F.when(seconds.between(*EPOCH_BOUNDS), F.timestamp_seconds(seconds))


def date_key(c: Column | str) -> Column:
    """``yyyymmdd`` as a number."""
    d = F.to_date(col(c))
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("bigint")


def date_from_key(c: Column | str) -> Column:
    """Date of a ``yyyymmdd`` number, NULL when it names no day."""
    return F.try_to_date(col(c).cast("string"), "yyyyMMdd")


def open_start() -> Column:
    return F.lit(OPEN_START).cast("timestamp_ntz")


def open_end() -> Column:
    """End of an interval that still holds."""
    return F.lit(OPEN_END).cast("timestamp_ntz")


def lookback(newest: Column | str, days: int = 7) -> Column:
    """First day still open for late records."""
    return F.date_sub(col(newest), days)


def calendar_attributes(d: Column | str) -> list[Column]:
    """The twelve columns of a calendar row."""
    d = col(d)
    dow = F.dayofweek(d)
    return [
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).cast("bigint").alias("year_num"),
        F.quarter(d).cast("bigint").alias("quarter_num"),
        F.concat(F.lit("Quarter "), F.quarter(d).cast("string")).alias("quarter_name"),
        F.month(d).cast("bigint").alias("month_num"),
        F.date_format(d, "MMMM").alias("full_month_name"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        F.dayofmonth(d).cast("bigint").alias("day_of_month"),
        dow.cast("bigint").alias("day_of_week"),
        F.date_format(d, "EEEE").alias("full_day_name"),
        dow.isin(1, 7).alias("is_weekend"),
    ]


def hour_slice(c: Column | str) -> Column:
    """Number of the calendar hour a time falls in; grows with time.

    Used to cut one key's history into pieces. Works on dates and on both
    timestamp types, and depends on the calendar only.
    """
    d = F.to_date(col(c))
    return F.datediff(d, F.lit("1970-01-01").cast("date")) * 24 + F.hour(col(c))
