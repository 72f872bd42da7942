"""Writing and reading the star and the raw zone as Parquet.

Each source writes below ``<table>/SourceSystemID=<id>`` only, so a source can
be loaded, reloaded after a failure or added on its own schedule, and what other
sources have published is not touched.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from starmart.operators.dims import (
    calendar,
    customers_of,
    dates_of,
    dim_source_system,
    employees_of,
    products_of,
)
from starmart.operators.fact import HEADER_COLUMNS, sales_of
from starmart.operators.filters import date_bounds, filter_sales
from starmart.operators.quality import quarantine, violations
from starmart.plans.footers import bounds, footers
from starmart.plans.star import Star
from starmart.schema import (
    DIM_CUSTOMER,
    DIM_EMPLOYEE,
    DIM_PRODUCT,
    DIM_SOURCE_SYSTEM,
    DIM_TIME,
    FACT_SALES,
)
from starmart.sources.spec import Source

PARTITION = "SourceSystemID"
_DATE_KEY = StructType([*[f for f in FACT_SALES.fields if f.name == "DateKey"], StructField("Year", IntegerType())])


def _write(df: DataFrame, path: str, table: str, system_id: int, *partitions: str) -> None:
    """Files of advisory size: AQE merges small shuffle partitions and splits large ones.

    A year that holds most of a source is written by many tasks.
    """
    target = f"{path}/{table}/{PARTITION}={system_id}"
    balanced = df.drop(PARTITION).hint("rebalance", *partitions)
    balanced.write.mode("overwrite").partitionBy(*partitions).parquet(target)


def publish_source(spark: SparkSession, source: Source, path: str) -> None:
    """(Re)write everything one source contributes to the star."""
    system_id = source.spec.system_id
    sales = sales_of(source).withColumn("Year", (F.col("DateKey") / 10000).cast("int"))
    _write(sales, path, "FactSales", system_id, "Year")
    _write(calendar(dates_of(source)), path, "DimTime", system_id)
    _write(customers_of(source), path, "DimCustomer", system_id)
    _write(employees_of(source), path, "DimEmployee", system_id)
    _write(products_of(source), path, "DimProduct", system_id)
    _write(dim_source_system(spark, [source]), path, "DimSourceSystem", system_id)


def publish(star: Star, path: str) -> None:
    for source in star.sources:
        publish_source(star.spark, source, path)


class PublishedStar(Star):
    """The star as published under a path; same tables, read from Parquet."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        super().__init__(spark, ())
        self.path = path

    def _read(self, table: str, schema: StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/{table}").select(*schema.names)

    @cached_property
    def _partitioned_sales(self) -> DataFrame:
        stored = StructType([*FACT_SALES.fields, StructField("Year", IntegerType())])
        return self.spark.read.schema(stored).parquet(f"{self.path}/FactSales")

    @cached_property
    def fact_sales(self) -> DataFrame:
        return self._partitioned_sales.select(*FACT_SALES.names)

    @cached_property
    def header_sales(self) -> DataFrame:
        """The published lines, whose headers are joined already, one by one."""
        return self.fact_sales.select(*HEADER_COLUMNS, F.lit(1).cast("bigint").alias("Lines"))

    def tables(self, only: Mapping[str, Collection[str]] | None = None) -> dict[str, DataFrame]:
        some = only or {}
        return {name: df.select(*some.get(name, df.columns)) for name, df in super().tables().items()}

    @cached_property
    def dim_time(self) -> DataFrame:
        """Each source publishes its dates; a date that several share is one member."""
        return self._read("DimTime", DIM_TIME).distinct()

    @cached_property
    def dim_customer(self) -> DataFrame:
        return self._read("DimCustomer", DIM_CUSTOMER)

    @cached_property
    def dim_employee(self) -> DataFrame:
        return self._read("DimEmployee", DIM_EMPLOYEE)

    @cached_property
    def dim_product(self) -> DataFrame:
        return self._read("DimProduct", DIM_PRODUCT)

    @cached_property
    def dim_source_system(self) -> DataFrame:
        return self._read("DimSourceSystem", DIM_SOURCE_SYSTEM)

    def source_ids(self, names: Sequence[str]) -> list[int]:
        """Looked up in DimSourceSystem: one row per named source comes to the driver."""
        members = self.dim_source_system.where(F.col("SourceSystemName").isin(list(names)))
        by_name = {row.SourceSystemName: row.SourceSystemID for row in members.collect()}
        return [by_name[name] for name in names]

    def sales(
        self,
        source_names: Sequence[str] | None = None,
        first: date | None = None,
        last: date | None = None,
    ) -> DataFrame:
        """The filtered fact; sources and years outside the filter are not read."""
        rows = self._partitioned_sales
        if first is not None:
            rows = rows.where(F.col("Year") >= first.year)
        if last is not None:
            rows = rows.where(F.col("Year") <= last.year)
        ids = None if source_names is None else self.source_ids(source_names)
        return filter_sales(rows, ids, first, last).select(*FACT_SALES.names)

    def sales_on(self, days: Column) -> DataFrame:
        """The fact on days that meet a condition on DimTime; of other years no file is read.

        The days that are found bring their years, and these prune the folders while the
        query runs.
        """
        chosen = F.broadcast(self.dim_time.where(days).select("DateKey", "Year"))
        return self._partitioned_sales.join(chosen, ["DateKey", "Year"]).select(*FACT_SALES.names)

    def _fact_folders(self) -> list[str]:
        return [f"{self.path}/FactSales"]

    def _footer_bounds(self) -> DataFrame:
        """low, high and n of the fact's DateKey; lines without a date lie in folders of their own."""
        return bounds(self.spark, self._fact_folders(), _DATE_KEY, "DateKey", "Year IS NOT NULL")

    def date_bounds(self) -> DataFrame:
        """From the files' footers: no row of the fact is read, and one row comes to the driver."""
        low = high = None
        if self._fact_folders():
            with footers(self.spark):
                low, high, _ = self._footer_bounds().first()
        return date_bounds(self.spark.createDataFrame([(low, None), (high, None)], _DATE_KEY))

    def fact_rows(self) -> int:
        """Rows of the fact, from the files' footers."""
        if not self._fact_folders():
            return 0
        with footers(self.spark):
            return self._footer_bounds().first()["n"]


def retain_raw(source: Source, path: str, load: str) -> None:
    """Keep a source's tables as delivered, all columns of the files, under the given load.

    Loads are kept side by side, so a mapping can be checked or run again.
    """
    for table in source.spec.tables:
        target = f"{path}/{source.spec.name}/{table}/load={load}"
        source.raw.delivered(table).write.mode("overwrite").parquet(target)


def retain_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """Keep a raw table bucketed and sorted by a join key.

    Lines and headers bucketed alike join without a shuffle, run after run.
    """
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def log_violations(source: Source, path: str, load: str) -> None:
    """Keep the findings on one load of a source, by rule."""
    target = f"{path}/{PARTITION}={source.spec.system_id}/load={load}"
    findings = violations(source).drop(PARTITION).hint("rebalance", "Rule")
    findings.write.mode("overwrite").partitionBy("Rule").parquet(target)


def write_quarantine(source: Source, path: str, load: str) -> None:
    """Keep the lines of one load that could not be loaded, with raw values and reason."""
    _, rejected = quarantine(source)
    target = f"{path}/{PARTITION}={source.spec.system_id}/load={load}"
    rejected.drop(PARTITION).hint("rebalance").write.mode("overwrite").parquet(target)
