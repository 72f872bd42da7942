"""Access to source-aligned raw tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcSplit:
    """How a live table is read in parallel: a numeric column cut into ranges."""

    column: str
    lower: int
    upper: int
    partitions: int


@dataclass(frozen=True)
class RawZone:
    """Named raw tables. ``read`` turns a table name into a lazy DataFrame."""

    read: Callable[[str], DataFrame]
    #: Reads a table with every column it was delivered with, where ``read`` may leave some out.
    read_whole: Callable[[str], DataFrame] | None = None
    _opened: dict[str, DataFrame] = field(default_factory=dict, repr=False, compare=False)

    def table(self, name: str) -> DataFrame:
        """The table; its files are listed and its schema read once per zone."""
        if name not in self._opened:
            self._opened[name] = self.read(name)
        return self._opened[name]

    def delivered(self, name: str) -> DataFrame:
        """The table with the columns and types of its files, whatever was declared."""
        return self.table(name) if self.read_whole is None else self.read_whole(name)

    def replacing(self, **tables: DataFrame) -> RawZone:
        """The same zone with some tables replaced."""
        return RawZone(
            lambda name: tables[name] if name in tables else self.table(name),
            lambda name: tables[name] if name in tables else self.delivered(name),
        )

    @classmethod
    def parquet(
        cls,
        spark: SparkSession,
        root: str,
        suffix: str = ".parquet",
        schemas: Mapping[str, str] | None = None,
    ) -> RawZone:
        """Files named after their table. Declared schemas spare a look into the files."""

        def path(name: str) -> str:
            return f"{root.rstrip('/')}/{name}{suffix}"

        def read(name: str) -> DataFrame:
            reader = spark.read
            if schemas and name in schemas:
                reader = reader.schema(schemas[name])
            return reader.parquet(path(name))

        return cls(read, lambda name: spark.read.parquet(path(name)))

    @classmethod
    def frames(cls, tables: Mapping[str, DataFrame]) -> RawZone:
        return cls(lambda name: tables[name])

    @classmethod
    def jdbc(
        cls,
        spark: SparkSession,
        url: str,
        splits: Mapping[str, JdbcSplit],
        properties: Mapping[str, str] | None = None,
    ) -> RawZone:
        """Live tables. A table without a split is read by one task, so name one for each big table."""

        def read(name: str) -> DataFrame:
            props = dict(properties or {})
            split = splits.get(name)
            if split is None:
                return spark.read.jdbc(url, name, properties=props)
            return spark.read.jdbc(
                url,
                name,
                column=split.column,
                lowerBound=split.lower,
                upperBound=split.upper,
                numPartitions=split.partitions,
                properties=props,
            )

        return cls(read)
