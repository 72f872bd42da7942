"""Filters on the fact."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Selection:
    """What a user has picked: sources by name and a range of days; None leaves that open."""

    sources: Collection[str] | None = None
    first: date | None = None
    last: date | None = None

    def covers(self, names: Collection[str], first: date | None, last: date | None) -> bool:
        """Whether nothing of the named sources between two days is left out."""
        everyone = self.sources is None or set(names) <= set(self.sources)
        early = self.first is None or (first is not None and self.first <= first)
        late = self.last is None or (last is not None and self.last >= last)
        return everyone and early and late


def as_key(day: date) -> int:
    return day.year * 10000 + day.month * 100 + day.day


def filter_sales(
    fact: DataFrame,
    source_ids: Sequence[int] | None = None,
    first: date | None = None,
    last: date | None = None,
) -> DataFrame:
    """Sales of the given sources between two dates, both included.

    The range works on DateKey, so DimTime is not joined. A given range leaves
    out lines without a date; without a range they stay.
    """
    if source_ids is not None:
        fact = fact.where(F.col("SourceSystemID").isin(list(source_ids)))
    if first is not None:
        fact = fact.where(F.col("DateKey") >= as_key(first))
    if last is not None:
        fact = fact.where(F.col("DateKey") <= as_key(last))
    return fact


def _as_date(key: Column) -> Column:
    """The date of a YYYYMMDD key."""
    month_day = key % 10000
    return F.make_date(
        (key / 10000).cast("int"), (month_day / 100).cast("int"), (month_day % 100).cast("int")
    )


def date_bounds(fact: DataFrame) -> DataFrame:
    """First and last date on which something was sold.

    The key is monotone in the date, so its bounds are found without DimTime.
    """
    return fact.agg(
        _as_date(F.min("DateKey")).alias("MinDate"), _as_date(F.max("DateKey")).alias("MaxDate")
    )
