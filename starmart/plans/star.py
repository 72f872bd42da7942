"""The star as a set of lazy DataFrames."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starmart.operators import dims, fact
from starmart.operators.filters import date_bounds, filter_sales
from starmart.schema import STAR_TABLES
from starmart.sources.spec import Source


@dataclass(eq=False)
class Star:
    """Tables of the star over a list of sources; each plan is made when first asked for."""

    spark: SparkSession
    sources: Sequence[Source]

    @cached_property
    def fact_sales(self) -> DataFrame:
        return fact.fact_sales(self.sources)

    def named_sales(self, *attributes: str) -> DataFrame:
        """The fact with some attributes of its customers, NULL where there is none."""
        customers = dims.dim_customer(self.sources, ("CustomerID", *attributes))
        return fact.named_sales(self.sources, customers)

    @cached_property
    def header_sales(self) -> DataFrame:
        """Sums per header: the fact for reports on source, date and customer."""
        return fact.header_sales(self.sources)

    @cached_property
    def dim_time(self) -> DataFrame:
        return dims.dim_time(self.sources)

    @cached_property
    def dim_customer(self) -> DataFrame:
        return dims.dim_customer(self.sources)

    @cached_property
    def dim_employee(self) -> DataFrame:
        return dims.dim_employee(self.sources)

    @cached_property
    def dim_product(self) -> DataFrame:
        return dims.dim_product(self.sources)

    @cached_property
    def dim_source_system(self) -> DataFrame:
        return dims.dim_source_system(self.spark, self.sources)

    def source_ids(self, names: Sequence[str]) -> list[int]:
        """Ids of the named sources, from the specs: a literal list prunes whole sources."""
        by_name = {s.spec.name: s.spec.system_id for s in self.sources}
        return [by_name[name] for name in names]

    def sales(
        self,
        source_names: Sequence[str] | None = None,
        first: date | None = None,
        last: date | None = None,
    ) -> DataFrame:
        """The fact, limited to some sources and an inclusive range of dates."""
        ids = None if source_names is None else self.source_ids(source_names)
        return filter_sales(self.fact_sales, ids, first, last)

    def date_bounds(self) -> DataFrame:
        """First and last date of the fact (see ``filters.date_bounds``)."""
        return date_bounds(fact.sold_dates(self.sources))

    def sales_on(self, days: Column) -> DataFrame:
        """The fact on days that meet a condition on DimTime, such as a quarter; lines without a date are left out."""
        # Bounded by the calendar.
        chosen = F.broadcast(self.dim_time.where(days).select("DateKey"))
        return self.fact_sales.join(chosen, "DateKey", "left_semi")

    def tables(self, only: Mapping[str, Collection[str]] | None = None) -> dict[str, DataFrame]:
        """All tables by name; of the members in ``only`` just the named columns.

        Such a member table is planned without lookups for the columns left out.
        """
        some = only or {}
        customers, employees, products = (some.get(x) for x in ("DimCustomer", "DimEmployee", "DimProduct"))
        frames = (
            self.fact_sales,
            self.dim_time,
            self.dim_customer if customers is None else dims.dim_customer(self.sources, customers),
            self.dim_employee if employees is None else dims.dim_employee(self.sources, employees),
            self.dim_product if products is None else dims.dim_product(self.sources, products),
            self.dim_source_system,
        )
        return dict(zip(STAR_TABLES, frames, strict=True))

    def create_views(self) -> None:
        """Temp views under the table names, for ad-hoc ``spark.sql``."""
        for name, df in self.tables().items():
            df.createOrReplaceTempView(name)
