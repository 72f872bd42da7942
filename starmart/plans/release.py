"""The star published in one step: releases of loads that readers see whole or not at all.

A load is what one source contributes, written to a folder of its own that nobody
reads yet. A manifest names the current load of every source; it is written under a
draft's name and becomes the next numbered one by a single rename that fails if the
number is taken. So a reader sees all tables of a release or of the one before, a
load that fails in between changes nothing, and a reader that has opened a release
keeps it, as older loads stay until they are cleared.

The delivered lines of a source are joined once. Loaded, rejected and lost lines
are written side by side, split by status, and counted on the way.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from functools import cached_property

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import DecimalType, IntegerType, LongType, StringType, StructField, StructType

from starmart import files
from starmart.operators.dims import calendar, customers_of, dates_of, dim_source_system, employees_of, products_of
from starmart.operators.fact import HEADER_COLUMNS
from starmart.operators.quality import delivered_lines
from starmart.plans.publish import PARTITION, PublishedStar
from starmart.plans.stability import key_changes, stability, store_keys
from starmart.schema import FACT_SALES
from starmart.sources.spec import Source, union_all

#: Text columns of the stored lines that only lines not loaded fill.
_RAW_COLUMNS = ("Reason", "LineKey", "RawDate", "RawQuantity", "RawPrice")
#: Columns of the folders' names.
_FOLDERS = ("Status", "Year")


def _numbers(spark: SparkSession, path: str) -> list[int]:
    found = files.names_in(spark, f"{path}/manifests")
    return sorted(int(name[1:]) for name in found if name[:1] == "v" and name[1:].isdigit())


def manifest(spark: SparkSession, path: str, version: int | None = None) -> dict:
    """A release's manifest, by default the latest: its version and per source id its name, load and line counts."""
    if version is None:
        numbers = _numbers(spark, path)
        if not numbers:
            return {"version": 0, "sources": {}}
        version = numbers[-1]
    return json.loads(files.read_text(spark, f"{path}/manifests/v{version:08d}"))


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of all releases that can be opened."""
    return _numbers(spark, path)


def _folder(path: str, load: str) -> str:
    return f"{path}/loads/{load}"


def _write_members(df: DataFrame, folder: str, table: str, system_id: int) -> None:
    df.drop(PARTITION).hint("rebalance").write.parquet(f"{folder}/{table}/{PARTITION}={system_id}")


def _write_summary(spark: SparkSession, folder: str, system_id: int) -> None:
    """Sums per day and customer of a load, made from its stored lines.

    Sums and counts can be added up further, so reports on source, date and customer
    need no line. They are as new as the load: no other source's are touched.
    """
    stored = StructType([*[f for f in FACT_SALES.fields if f.name != PARTITION], StructField("Year", IntegerType())])
    lines = spark.read.schema(stored).parquet(f"{folder}/Lines/{PARTITION}={system_id}/Status=loaded")
    sums = lines.groupBy("Year", "DateKey", "CustomerID").agg(
        F.sum("SalesQuantity").alias("SalesQuantity"),
        F.sum("SalesAmount").alias("SalesAmount"),
        F.count(F.lit(1)).alias("Lines"),
    )
    target = f"{folder}/Summary/{PARTITION}={system_id}"
    sums.hint("rebalance", "Year").write.partitionBy("Year").parquet(target)


def write_load(source: Source, path: str) -> dict:
    """Write all that a source contributes to a new folder; returns its entry of the manifest."""
    spec, load = source.spec, uuid.uuid4().hex
    folder = _folder(path, load)
    lines = delivered_lines(source).withColumn("Year", (F.col("DateKey") / 10000).cast("int"))
    spark = lines.sparkSession
    seen = Observation()
    counts = {
        "delivered": F.count(F.lit(1)),
        **{status: F.count_if(F.col("Status") == status) for status in ("loaded", "rejected", "lost")},
        # Sums of cents, so that a later run can be held against them.
        "amount": F.sum(F.when(F.col("Status") == "loaded", F.col("SalesAmount"))).cast("string"),
    }
    # Counted after the shuffle: tasks of the last stage count once, however often they are tried.
    balanced = lines.drop(PARTITION).hint("rebalance", *_FOLDERS)
    watched = balanced.observe(seen, *[column.alias(name) for name, column in counts.items()])
    target = f"{folder}/Lines/{PARTITION}={spec.system_id}"
    watched.write.partitionBy(*_FOLDERS).parquet(target)
    _write_summary(spark, folder, spec.system_id)
    _write_members(calendar(dates_of(source)), folder, "DimTime", spec.system_id)
    _write_members(customers_of(source), folder, "DimCustomer", spec.system_id)
    _write_members(employees_of(source), folder, "DimEmployee", spec.system_id)
    _write_members(products_of(source), folder, "DimProduct", spec.system_id)
    _write_members(dim_source_system(spark, [source]), folder, "DimSourceSystem", spec.system_id)
    store_keys(source, folder)
    return {"name": spec.name, "load": load, "lines": seen.get}


def _announce(spark: SparkSession, path: str, change: Callable[[dict[str, dict]], dict[str, dict]]) -> int:
    """Make the next manifest from the latest one's sources; tried again if another writer was first."""
    while True:
        current = manifest(spark, path)
        version = current["version"] + 1
        text = json.dumps({"version": version, "sources": change(current["sources"])}, indent=1)
        draft = f"{path}/manifests/draft-{uuid.uuid4().hex}"
        if files.put_if_absent(spark, f"{path}/manifests/v{version:08d}", text, draft):
            return version


def release(spark: SparkSession, sources: Sequence[Source], path: str) -> int:
    """(Re)load some sources and publish them together; sources not named stay as they are.

    Returns the version. If anything fails before the last step, readers go on with
    the release before.
    """
    entries = {str(s.spec.system_id): write_load(s, path) for s in sources}
    return _announce(spark, path, lambda current: {**current, **entries})


def withdraw(spark: SparkSession, path: str, system_id: int) -> int:
    """A release without a source; its loads stay readable in the versions before."""
    return _announce(spark, path, lambda current: {k: v for k, v in current.items() if k != str(system_id)})


def clear(spark: SparkSession, path: str, keep: int = 2, idle_hours: float = 24) -> list[str]:
    """Delete loads that none of the last ``keep`` releases names, and the manifests before those.

    A load that is not named may be one being written: it goes only if nothing has
    changed in its folder for ``idle_hours``. Returns the loads that went.
    """
    if keep < 1:
        raise ValueError("the latest release has to stay")
    numbers = _numbers(spark, path)
    kept = numbers[-keep:]
    named = {e["load"] for n in kept for e in manifest(spark, path, n)["sources"].values()}
    for number in numbers[: -len(kept)] if kept else []:
        files.delete(spark, f"{path}/manifests/v{number:08d}")
    gone = []
    for load in files.names_in(spark, f"{path}/loads"):
        folder = _folder(path, load)
        if load not in named and files.age_in_seconds(spark, folder) >= idle_hours * 3600:
            files.delete(spark, folder)
            gone.append(load)
    return gone


class ReleasedStar(PublishedStar):
    """One release of the star, the latest by default; the same release however long it is read."""

    def __init__(self, spark: SparkSession, path: str, version: int | None = None) -> None:
        super().__init__(spark, path)
        self.manifest = manifest(spark, path, version)
        self.version = self.manifest["version"]

    @cached_property
    def _loads(self) -> dict[int, str]:
        return {int(k): _folder(self.path, e["load"]) for k, e in self.manifest["sources"].items()}

    def _scan(self, table: str, schema: StructType, below: str = "") -> DataFrame:
        """The loads' files of one table; the source is a column of the folders' names, as below them."""
        parts = [
            self.spark.read.schema(schema)
            .option("basePath", f"{folder}/{table}")
            .parquet(f"{folder}/{table}/{PARTITION}={system_id}{below}")
            for system_id, folder in self._loads.items()
        ]
        return union_all(parts) if parts else self.spark.createDataFrame([], schema)

    def _read(self, table: str, schema: StructType) -> DataFrame:
        stored = StructType([*[f for f in schema.fields if f.name != PARTITION], StructField(PARTITION, IntegerType())])
        return self._scan(table, stored).select(*schema.names)

    @cached_property
    def _lines(self) -> DataFrame:
        stored = StructType(
            [
                *[f for f in FACT_SALES.fields if f.name != PARTITION],
                *[StructField(c, StringType()) for c in _RAW_COLUMNS],
                StructField(PARTITION, IntegerType()),
                StructField("Status", StringType()),
                StructField("Year", IntegerType()),
            ]
        )
        return self._scan("Lines", stored)

    @cached_property
    def _partitioned_sales(self) -> DataFrame:
        return self._lines.where(F.col("Status") == "loaded").select(*FACT_SALES.names, "Year")

    @cached_property
    def _summary(self) -> DataFrame:
        stored = StructType(
            [
                *[f for f in FACT_SALES.fields if f.name in ("DateKey", "CustomerID")],
                StructField("SalesQuantity", LongType()),
                StructField("SalesAmount", DecimalType(28, 2)),
                StructField("Lines", LongType()),
                StructField(PARTITION, IntegerType()),
                StructField("Year", IntegerType()),
            ]
        )
        return self._scan("Summary", stored)

    @cached_property
    def header_sales(self) -> DataFrame:
        """The stored sums per day and customer: reports on source, date and customer read no line."""
        return self._summary.select(*HEADER_COLUMNS, "Lines")

    @cached_property
    def not_loaded(self) -> DataFrame:
        """Lines that were delivered and are not in the fact, as delivered, with ``Status`` and ``Reason``."""
        keys = ("CustomerID", "ProductID")
        return self._lines.where(F.col("Status") != "loaded").select(PARTITION, "Status", *_RAW_COLUMNS, *keys)

    def _fact_folders(self) -> list[str]:
        return [f"{folder}/Lines/{PARTITION}={k}/Status=loaded" for k, folder in self._loads.items()]

    def source_ids(self, names: Sequence[str]) -> list[int]:
        """From the manifest."""
        by_name = {e["name"]: int(k) for k, e in self.manifest["sources"].items()}
        return [by_name[name] for name in names]

    def stored_volume(self) -> DataFrame:
        """Lines by status per source, counted in what is stored: the footers and folder names tell."""
        count = {"loaded": "FactRows", "rejected": "Rejected", "lost": "LostInJoins"}
        sums = self._lines.groupBy(PARTITION).agg(
            F.count(F.lit(1)).alias("SourceLines"),
            *[F.count_if(F.col("Status") == status).alias(name) for status, name in count.items()],
        )
        return sums.join(F.broadcast(self.dim_source_system), PARTITION).select(
            PARTITION, "SourceSystemName", "SourceLines", "LostInJoins", "Rejected", "FactRows"
        )

    def observed_volume(self) -> DataFrame:
        """The same as counted while the lines were written; nothing is read but the manifest."""
        rows = [
            (int(k), e["name"], *[e["lines"][c] for c in ("delivered", "lost", "rejected", "loaded")])
            for k, e in self.manifest["sources"].items()
        ]
        columns = f"{PARTITION} int, SourceSystemName string, SourceLines bigint, LostInJoins bigint, Rejected bigint, FactRows bigint"
        return self.spark.createDataFrame(rows, columns)

    def _load_before(self, system_id: int, other: ReleasedStar) -> tuple[str | None, str | None]:
        return other._loads.get(system_id), self._loads.get(system_id)

    def key_changes_since(self, other: ReleasedStar, system_id: int) -> DataFrame:
        """Ids of a source that came, went or changed since another release (see ``stability``)."""
        return key_changes(self.spark, *self._load_before(system_id, other))

    def stability_since(self, other: ReleasedStar, system_id: int) -> DataFrame:
        return stability(self.spark, *self._load_before(system_id, other))
