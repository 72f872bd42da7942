"""Measures: exact decimals, and NULL instead of a failed job for unusable input."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DataType, NumericType

from starmart.schema import MONEY

# Decimal(18,2) and bigint hold numbers ten times this size.
SAFE_SIZE = 1e15

# Factors of this precision multiply exactly; larger ones have no more than two places.
_FACTORS = ("decimal(20,6)", "decimal(17,6)")
_LARGE_FACTORS = ("decimal(18,2)", "decimal(19,0)")


def quantity(raw: Column) -> Column:
    """Whole units; a fraction is cut off, see ``is_whole``. ``10.0`` counts as 10."""
    return F.coalesce(raw.try_cast("bigint"), raw.try_cast("decimal(38,10)").try_cast("bigint"))


def is_whole(raw: Column) -> Column:
    """Whether a number has no fraction; NULL for what is no number."""
    number = raw.try_cast("decimal(38,10)")
    return number == F.floor(number)


def money(raw: Column) -> Column:
    return raw.try_cast(MONEY)


def line_amount(price: Column, units: Column) -> Column:
    """Line price times quantity, both as delivered (to six places); only the product is rounded.

    Discounts, freight and header totals have no part in it.
    """
    products = [
        price.try_cast(of_price) * units.try_cast(of_units)
        for of_price, of_units in (_FACTORS, _LARGE_FACTORS)
    ]
    return F.coalesce(*[p.try_cast(MONEY) for p in products])


def surely_fits(numbers: list[Column], types: list[DataType]) -> Column:
    """Whether numbers are of ordinary size, by a comparison of doubles; never NULL.

    A cheap way past the exact test (a conversion to decimal, dear on every line
    of a large fact). Text, NULL, NaN and sizes near the limit are not sure.
    """
    if not all(isinstance(t, NumericType) for t in types):
        return F.lit(False)
    small = [F.abs(n.cast("double")) < SAFE_SIZE for n in numbers]
    return F.coalesce(reduce(Column.__and__, small), F.lit(False))
