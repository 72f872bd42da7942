"""Rows carried whole, so that no column's name can meet one that an operator uses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def named(column: str) -> Column:
    """A column by its very name, dots and backticks included."""
    return F.col("`" + column.replace("`", "``") + "`")


def packed(columns: Sequence[str]) -> Column:
    """Some columns as one struct named ``row``; ``select("row.*")`` brings them back."""
    return F.struct(*[named(c).alias(c) for c in columns]).alias("row")


def others(columns: Sequence[str], *made: str) -> list[str]:
    """The columns but for those that an operator makes, whatever their case."""
    taken = {m.lower() for m in made}
    return [c for c in columns if c.lower() not in taken]
