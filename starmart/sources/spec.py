"""What one source system contributes to the star, as data.

A spec is the source-to-target mapping: for each target table the source rows
and one column expression per target attribute. An attribute with no entry is
NULL for that source.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql.types import DataType

from starmart.sources.raw import RawZone


@dataclass(frozen=True)
class Lookup:
    """Rows joined on the left for some attributes; ``lookups`` hang on the joined rows."""

    rows: DataFrame
    on: Column
    rules: dict[str, Column]
    lookups: tuple[Lookup, ...] = ()

    def targets(self) -> set[str]:
        return set(self.rules).union(*[x.targets() for x in self.lookups])


@dataclass(frozen=True)
class Mapped:
    """Source rows (after the source's own joins) and the target expressions on them.

    ``lookups`` bring further attributes. One whose attributes nobody asks for is
    left out of the plan: Spark has to keep a left join, as its key may repeat.
    """

    rows: DataFrame
    rules: dict[str, Column]
    lookups: tuple[Lookup, ...] = ()

    def targets(self) -> set[str]:
        """All attributes there are, those of lookups among them."""
        return set(self.rules).union(*[x.targets() for x in self.lookups])

    def evaluated(self, only: Collection[str] | None = None) -> tuple[DataFrame, dict[str, DataType]]:
        """The rules (all, or ``only`` some) as columns named after their targets, and their types."""
        rows, rules = self.rows, dict(self.rules)
        pending = list(self.lookups)
        while pending:
            lookup = pending.pop(0)
            if only is None or lookup.targets() & set(only):
                rows = rows.join(lookup.rows, lookup.on, "left")
                rules.update(lookup.rules)
                pending += lookup.lookups
        df = rows.select(
            *[rule.alias(target) for target, rule in rules.items() if only is None or target in only]
        )
        return df, {f.name: f.dataType for f in df.schema.fields}


@dataclass(frozen=True)
class HeaderSales:
    """Lines and headers before their join, for reports on what only headers say.

    ``lines`` maps line rows to ``Quantity`` and ``UnitPrice`` or ``Amount``,
    ``headers`` maps header rows to ``DateKey`` and ``CustomerID``; both bring
    ``HeaderKey``, on which they meet.
    """

    lines: Mapped
    headers: Mapped


@dataclass(frozen=True)
class ForeignKey:
    table: str
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class SourceSpec:
    """Mapping of one source system.

    ``customers``, ``employees`` and ``products`` map to the dimension's
    attributes with *native* ids; prefixes are added by the builders, so that
    dimension and fact cannot differ. ``dates`` maps headers to ``OrderDate``.
    ``sales`` maps joined lines to ``Matched`` (header and customer were found: always so
    in the inner join, for its second argument "left" all lines are kept), ``LineKey``, ``OrderDate`` as delivered, its
    ``DateKey`` (see ``with_date_key``), ``CustomerID``, ``EmployeeID``,
    ``ProductID``, ``Quantity`` and ``UnitPrice``, or ``Amount`` where the source
    stores the amount of the line. ``header_sales`` gives the same lines and headers
    apart, where there are headers. ``header_customer`` names the header table and
    its column that ``sales`` maps to ``CustomerID``, where lines get it from there.
    ``lines`` gives the line rows before any join, to count what the joins lose.
    """

    system_id: int
    name: str
    prefix: str
    customers: Callable[[RawZone], Mapped]
    employees: Callable[[RawZone], Mapped]
    products: Callable[[RawZone], Mapped]
    dates: Callable[[RawZone], Mapped]
    sales: Callable[..., Mapped]
    lines: Callable[[RawZone], DataFrame]
    line_key: tuple[str, ...]
    header_sales: Callable[[RawZone], HeaderSales] | None = None
    header_customer: tuple[str, str] | None = None
    tables: tuple[str, ...] = ()
    primary_keys: dict[str, tuple[str, ...]] = field(default_factory=dict)
    foreign_keys: tuple[ForeignKey, ...] = ()


@dataclass(frozen=True)
class Source:
    """A spec bound to the raw tables it reads."""

    spec: SourceSpec
    raw: RawZone


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
