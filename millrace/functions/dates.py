"""Dates and times that arrive as text or epoch milliseconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_FORMAT = "yyyy-MM-dd"
DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
VOID_PARTITION = "9999/12/30"  # fixed value: partition of rows without a date


def parse_date(c: Column, fmt: str = DATE_FORMAT) -> Column:
    """The first characters as a calendar date, else null."""
    return F.try_to_timestamp(F.substring(F.trim(c), 1, len(fmt)), F.lit(fmt)).cast("date")


def parse_datetime(c: Column, fmt: str = DATETIME_FORMAT) -> Column:
    return F.try_to_timestamp(F.substring(F.trim(c), 1, len(fmt)), F.lit(fmt))


def is_valid_date(c: Column) -> Column:
    return parse_date(c).isNotNull()


def is_valid_datetime(c: Column) -> Column:
    return parse_datetime(c).isNotNull()


def reformat_date(c: Column, to_format: str, from_format: str = DATE_FORMAT) -> Column:
    parsed = F.try_to_timestamp(F.substring(F.trim(c), 1, len(from_format)), F.lit(from_format))
    return F.date_format(parsed, to_format)


def millis_to_text(c: Column, fmt: str = DATETIME_FORMAT) -> Column:
    return F.date_format(F.timestamp_millis(c), fmt)


def local_text_to_millis(c: Column, offset: str = "+08:00", fmt: str = DATETIME_FORMAT) -> Column:
    """Wall-clock text of a fixed offset to epoch milliseconds."""
    return F.unix_millis(F.to_utc_timestamp(F.to_timestamp(c, fmt), offset))


def month_of(c: Column) -> Column:
    """yyyyMM of yyyyMMdd text."""
    return F.substring(c, 1, 6)


def date_partition(c: Column) -> Column:
    """yyyy/MM/dd of date or datetime text; blank goes to the void partition; other text fails."""
    day = parse_date(c)
    return (
        F.when(c.isNull() | (F.trim(c) == ""), F.lit(VOID_PARTITION))
        .when(day.isNotNull(), F.date_format(day, "yyyy/MM/dd"))
        .otherwise(F.raise_error(F.concat(F.lit("not a date or datetime: "), c)).cast("string"))
    )


def window_start(c: Column, size: str, offset: str | None = None) -> Column:
    """Start of the tumbling window [start, start + size) that holds the timestamp."""
    return (F.window(c, size, size, offset) if offset else F.window(c, size))["start"]
