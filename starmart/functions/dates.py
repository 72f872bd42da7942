"""One date rule for the fact and for DimTime."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, StringType

# ISO calendar date from year 1 on, alone or followed by a time of day.
ISO_DATE = r"^ *(?!0000)\d{4}-\d{2}-\d{2}([ T].*)?$"


def _readable(text: Column) -> Column:
    """The pattern shuts out partial dates such as ``2016``, which a cast would
    fill up with an invented month and day; the cast shuts out impossible dates
    and wrong times of day."""
    return text.rlike(ISO_DATE) & text.try_cast("timestamp_ntz").isNotNull()


def _digits(text: Column) -> Column:
    """``2016-07-04`` of a readable text."""
    return F.substring(F.ltrim(text), 1, 10)


def parse_date(value: Column, data_type: DataType) -> Column:
    """Calendar date of a date, timestamp or text column; unusable text gives NULL.

    Text may mix ``2016-07-04`` and ``2023-08-29 09:23:46``. Years have one to
    four digits: a timestamp beyond has no YYYYMMDD key and counts as unusable.
    """
    if isinstance(data_type, StringType):
        return F.when(_readable(value), _digits(value).cast("date"))
    day = value.cast("date")
    first, last = (F.lit(text).cast("date") for text in ("0001-01-01", "9999-12-31"))
    return F.when(day.between(first, last), day)


def date_key(day: Column) -> Column:
    """YYYYMMDD as int; NULL stays NULL."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def key_of(value: Column, data_type: DataType) -> Column:
    """``date_key(parse_date(...))``; text is tested once and its digits are taken as they are."""
    if isinstance(data_type, StringType):
        return F.when(_readable(value), F.replace(_digits(value), F.lit("-")).cast("int"))
    return date_key(parse_date(value, data_type))


def with_date_key(headers: DataFrame, column: str) -> DataFrame:
    """Headers with the ``DateKey`` of a date column.

    Made before lines are joined: once per header, and an int instead of a
    timestamp or text goes through the shuffle.
    """
    return headers.withColumn("DateKey", key_of(F.col(column), headers.schema[column].dataType))


def calendar_columns(day: Column) -> dict[str, Column]:
    """The DimTime attributes of a date column."""
    return {
        "DateKey": date_key(day),
        "FullDate": day,
        "DayOfMonth": F.dayofmonth(day),
        "DayOfWeek": F.date_format(day, "EEEE"),
        "Month": F.month(day),
        "Quarter": F.quarter(day),
        "Year": F.year(day),
    }
