"""Canonical identifiers and names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DataType, NumericType


def canonical_key(prefix: str, native: Column, data_type: DataType) -> Column:
    """``PREFIX:<native id>``; NULL stays NULL.

    Numeric ids go through bigint so that an id read as 5.0 gives ``PREFIX:5``.
    Text ids are taken as they are. ``concat`` (not ``concat_ws``) is what
    keeps NULL from turning into a bare prefix.
    """
    if isinstance(data_type, NumericType):
        native = native.cast("bigint")
    return F.concat(F.lit(f"{prefix}:"), native.cast("string"))


def strip(text: Column) -> Column:
    """Remove white space of any kind at both ends (``trim`` removes blanks only)."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def person_name(first: Column, last: Column) -> Column:
    """First and last name joined by a blank; a NULL part counts as empty."""
    empty = F.lit("")
    joined = F.concat(strip(F.coalesce(first, empty)), F.lit(" "), strip(F.coalesce(last, empty)))
    return strip(joined)


def line_key(*columns: str) -> Column:
    """One text for a key of several columns; a NULL part is empty and keeps its place."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return F.array_join(F.array(*parts), "|")
