"""Data-quality rules. They report; nothing is patched, and nothing is deduplicated."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from starmart.functions import is_whole, line_key
from starmart.operators.dims import customers_of, dates_of, employees_of, calendar, products_of
from starmart.operators.fact import sales_of, staged_sales
from starmart.schema import STAR_TABLES
from starmart.sources.spec import ForeignKey, Source, union_all

#: What key usage reads of the members.
MEMBER_KEYS = {"DimCustomer": ("CustomerID",), "DimEmployee": ("EmployeeID", "ReportsTo"), "DimProduct": ("ProductID",)}
FACT_KEYS = ("DateKey", "CustomerID", "EmployeeID", "ProductID", "SourceSystemID")


def _unpivot(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    """One row per listed column; all values must share a type."""
    return df.unpivot(list(ids), list(columns), name, value)


def key_nulls(fact: DataFrame) -> DataFrame:
    """NULLs in each key column of the fact, per source: one pass."""
    columns = [k for k in FACT_KEYS if k != "SourceSystemID"]
    counts = fact.groupBy("SourceSystemID").agg(
        F.count("*").alias("FactRows"), *[F.count_if(F.col(k).isNull()).alias(k) for k in columns]
    )
    return _unpivot(counts, ["SourceSystemID", "FactRows"], columns, "KeyColumn", "NullRows")


def duplicate_lines(source: Source) -> DataFrame:
    """Line keys that occur more than once in the source. A finding, not a reason to drop lines."""
    keys = source.spec.line_key
    repeated = source.spec.lines(source.raw).groupBy(*keys).agg(F.count("*").alias("Copies"))
    return repeated.where(F.col("Copies") > 1).select(
        F.lit(source.spec.system_id).alias("SourceSystemID"),
        line_key(*keys).alias("LineKey"),
        "Copies",
    )


def _uses(fact: DataFrame) -> DataFrame:
    """ForeignKey, KeyValue, Use (rows of the fact) and Define (none) of the fact's five keys.

    One grouping set per key: keys are counted in their own types, one row per value and
    task, and become text only then.
    """
    counted = fact.groupingSets([[F.col(k)] for k in FACT_KEYS], *FACT_KEYS).agg(
        F.count(F.lit(1)).alias("Use"), *[F.grouping(k).alias(f"not_{k}") for k in FACT_KEYS]
    )
    name = F.coalesce(*[F.when(F.col(f"not_{k}") == 0, F.lit(k)) for k in FACT_KEYS])
    return counted.select(
        name.alias("ForeignKey"),
        F.coalesce(*[F.col(k).cast("string") for k in FACT_KEYS]).alias("KeyValue"),
        "Use",
        F.lit(0).cast("bigint").alias("Define"),
    )


def key_usage(
    fact: DataFrame,
    dim_time: DataFrame,
    dim_customer: DataFrame,
    dim_employee: DataFrame,
    dim_product: DataFrame,
    dim_source_system: DataFrame,
) -> DataFrame:
    """For every key value of the five foreign keys and ReportsTo: rows that use it, rows that define it.

    Uses and definitions are stacked and grouped, so the fact is read once, no
    join takes place, and a hot key costs one row per task. NULL keys refer to
    nothing and are left out; DimTime and DimSourceSystem have none, so no test
    is pushed into the making of their rows.
    """
    given = F.col("KeyValue").isNotNull()
    used = _uses(fact).where(given)

    def role(foreign_key: str, column: str, use: int) -> Column:
        return F.struct(
            F.lit(foreign_key).alias("ForeignKey"),
            F.col(column).cast("string").alias("KeyValue"),
            F.lit(use).cast("bigint").alias("Use"),
            F.lit(1 - use).cast("bigint").alias("Define"),
        )

    def defined(dim: DataFrame, column: str) -> DataFrame:
        return dim.select(role(column, column, 0).alias("role")).select("role.*")

    # An employee defines an id for both foreign keys and uses that of the manager: one scan for all three.
    roles = F.array(
        role("EmployeeID", "EmployeeID", 0), role("ReportsTo", "EmployeeID", 0), role("ReportsTo", "ReportsTo", 1)
    )
    stacked = union_all(
        [
            used,
            defined(dim_time, "DateKey"),
            defined(dim_customer, "CustomerID").where(given),
            dim_employee.select(F.explode(roles).alias("role")).select("role.*").where(given),
            defined(dim_product, "ProductID").where(given),
            defined(dim_source_system, "SourceSystemID"),
        ]
    )
    return (
        stacked.groupBy("ForeignKey", "KeyValue")
        .agg(F.sum("Use").alias("UsingRows"), F.sum("Define").alias("DefiningRows"))
    )


def orphans(usage: DataFrame) -> DataFrame:
    """Key values that are used and nowhere defined."""
    return usage.where((F.col("UsingRows") > 0) & (F.col("DefiningRows") == 0)).select(
        "ForeignKey", "KeyValue", "UsingRows"
    )


def key_consistency(usage: DataFrame) -> DataFrame:
    """Per foreign key and id namespace: whether fact and dimension write the same ids.

    The namespace is the source prefix; keys without one have an empty one.
    """
    has_prefix = F.instr("KeyValue", ":") > 0
    namespace = F.when(has_prefix, F.substring_index("KeyValue", ":", 1)).otherwise("")
    used, defined = F.col("UsingRows") > 0, F.col("DefiningRows") > 0
    return usage.groupBy("ForeignKey", namespace.alias("Namespace")).agg(
        F.count_if(used).alias("UsedKeys"),
        F.count_if(defined).alias("DefinedKeys"),
        F.count_if(used & defined).alias("SharedKeys"),
        F.count_if(used & ~defined).alias("OrphanKeys"),
        F.count_if(F.col("DefiningRows") > 1).alias("RepeatedMembers"),
        F.sum("UsingRows").alias("UsingRows"),
    )


def date_fault() -> Column:
    """Reason why a staged line has no date, NULL if it has one."""
    missing = F.col("RawDate").isNull() | F.col("RawDate").rlike(r"^\s*$")
    return F.when(
        F.col("DateKey").isNull(),
        F.when(missing, F.lit("date missing")).otherwise(F.lit("date not readable")),
    )


def bad_dates(source: Source) -> DataFrame:
    """Lines that stay in the fact with a NULL DateKey."""
    staged = staged_sales(source).withColumn("Reason", date_fault())
    return staged.where(F.col("Reason").isNotNull()).select(
        "SourceSystemID", "LineKey", "RawDate", "Reason"
    )


def measure_fault() -> Column:
    """First reason why a staged line's measures are unusable, NULL if they are usable."""
    units = F.col("RawQuantity")
    price = F.col("RawPrice").try_cast("decimal(18,2)")
    return (
        F.when(units.isNull(), "quantity missing")
        .when(F.col("SalesQuantity").isNull(), "quantity not a number")
        .when(F.col("RawPrice").isNull(), "price missing")
        .when(price.isNull() | F.col("SalesAmount").isNull(), "price not a number")
        .when(~is_whole(units), "quantity not whole")
        .when(F.col("SalesQuantity") <= 0, "quantity not positive")
        .when(price < 0, "price negative")
    )


def bad_measures(source: Source) -> DataFrame:
    """Lines with an unusable quantity or price, and whether they could be loaded at all."""
    staged = staged_sales(source).withColumn("Reason", measure_fault())
    return staged.where(F.col("Reason").isNotNull()).select(
        "SourceSystemID",
        "LineKey",
        "RawQuantity",
        "RawPrice",
        "Reason",
        F.col("Usable").alias("Loaded"),
    )


def triage(source: Source) -> DataFrame:
    """Every joined line of the source with ``Status`` loaded or rejected, and the reason.

    Only a measure that is no number keeps a line out of the fact.
    """
    status = F.when(F.col("Usable"), "loaded").otherwise("rejected")
    reason = F.when(~F.col("Usable"), measure_fault())
    return staged_sales(source).withColumns({"Status": status, "Reason": reason})


def delivered_lines(source: Source) -> DataFrame:
    """Every delivered line with its fact columns, ``Status`` and ``Reason``: one join for all that becomes of lines.

    Status: loaded, rejected (a measure is no number) or lost (no header, or no
    customer). Raw values are kept of lines that are not loaded. A line that finds
    several headers is as many rows, as in the fact.
    """
    status = F.when(~F.col("Matched"), "lost").when(F.col("Usable"), "loaded").otherwise("rejected")
    reason = F.when(~F.col("Matched"), "no header or customer").when(~F.col("Usable"), measure_fault())
    staged = staged_sales(source, "left").withColumns({"Status": status, "Reason": reason})
    loaded = F.col("Status") == "loaded"
    raw = [F.when(~loaded, F.col(c)).alias(c) for c in ("LineKey", "RawDate", "RawQuantity", "RawPrice")]
    return staged.select(*STAR_TABLES["FactSales"].names, "Status", "Reason", *raw)


def quarantine(source: Source) -> tuple[DataFrame, DataFrame]:
    """The lines that load, and the lines that cannot with their raw values and reason."""
    lines = triage(source)
    loaded = lines.where(F.col("Status") == "loaded").select(*STAR_TABLES["FactSales"].names)
    rejected = lines.where(F.col("Status") == "rejected").select(
        "SourceSystemID",
        "LineKey",
        "RawDate",
        "RawQuantity",
        "RawPrice",
        "CustomerID",
        "ProductID",
        "Reason",
    )
    return loaded, rejected


def violations(source: Source) -> DataFrame:
    """All findings on a source's lines in one shape, to be logged: rule, line and reason.

    Dates and measures are judged in one pass over the lines; a line with both
    faults gives two findings.
    """
    spec_id = F.lit(source.spec.system_id).alias("SourceSystemID")
    faults = F.array(
        F.struct(F.lit("date").alias("Rule"), date_fault().alias("Reason")),
        F.struct(F.lit("measure").alias("Rule"), measure_fault().alias("Reason")),
    )
    lines = staged_sales(source).select("LineKey", F.explode(faults).alias("fault"))
    judged = lines.select("fault.Rule", spec_id, "LineKey", "fault.Reason")
    repeated = duplicate_lines(source).select(
        F.lit("duplicate line").alias("Rule"),
        "SourceSystemID",
        "LineKey",
        F.concat("Copies", F.lit(" copies")).alias("Reason"),
    )
    return judged.where(F.col("Reason").isNotNull()).unionByName(repeated)


def source_volume(sources: Sequence[Source]) -> DataFrame:
    """Lines delivered and lines loaded per source.

    What is missing was lost in the inner joins (no header, no customer) or
    rejected for an unusable measure.
    """
    per_source = []
    for source in sources:
        spec = source.spec
        delivered = spec.lines(source.raw).agg(F.count("*").alias("SourceLines"))
        joined = staged_sales(source).agg(
            F.count("*").alias("JoinedLines"), F.count_if(F.col("Usable")).alias("FactRows")
        )
        both = delivered.unionByName(joined, allowMissingColumns=True)  # two rows
        counts = both.agg(*[F.max(c).alias(c) for c in ("SourceLines", "JoinedLines", "FactRows")])
        per_source.append(
            counts.select(
                F.lit(spec.system_id).alias("SourceSystemID"),
                F.lit(spec.name).alias("SourceSystemName"),
                "SourceLines",
                (F.col("SourceLines") - F.col("JoinedLines")).alias("LostInJoins"),
                (F.col("JoinedLines") - F.col("FactRows")).alias("Rejected"),
                "FactRows",
            )
        )
    return union_all(per_source)


def foreign_key_usage(source: Source, key: ForeignKey) -> DataFrame:
    """How well one declared foreign key of a source holds on its data.

    Child rows are counted per key value and parents marked, again without a join.
    """
    def side(table: str, columns: Sequence[str], use: int) -> DataFrame:
        named = [F.col(c).cast("string").alias(f"k{i}") for i, c in enumerate(columns)]
        return source.raw.table(table).select(*named, F.lit(use).alias("Use"))

    names = [f"k{i}" for i in range(len(key.columns))]
    both = side(key.table, key.columns, 1).unionByName(side(key.parent, key.parent_columns, 0))
    filled = both.dropna(subset=names).groupBy(*names)
    usage = filled.agg(F.sum("Use").alias("Rows"), F.sum(1 - F.col("Use")).alias("Parents"))
    orphan = (F.col("Rows") > 0) & (F.col("Parents") == 0)
    return usage.agg(
        F.lit(source.spec.name).alias("SourceSystem"),
        F.lit(f"{key.table}({','.join(key.columns)})").alias("ForeignKey"),
        F.lit(f"{key.parent}({','.join(key.parent_columns)})").alias("References"),
        F.coalesce(F.sum("Rows"), F.lit(0)).alias("ChildRows"),
        F.count_if(F.col("Rows") > 0).alias("ChildKeys"),
        F.count_if(orphan).alias("OrphanKeys"),
        F.coalesce(F.sum(F.when(orphan, F.col("Rows"))), F.lit(0)).alias("OrphanRows"),
    )


def source_foreign_keys(sources: Sequence[Source]) -> DataFrame:
    """Every declared foreign key of every source, verified on the data."""
    return union_all(foreign_key_usage(s, k) for s in sources for k in s.spec.foreign_keys)


_CONTRIBUTIONS = {
    "FactSales": (sales_of, "sales"),
    "DimTime": (lambda s: calendar(dates_of(s)), "dates"),
    "DimCustomer": (customers_of, "customers"),
    "DimEmployee": (employees_of, "employees"),
    "DimProduct": (products_of, "products"),
}


def attribute_coverage(sources: Sequence[Source]) -> DataFrame:
    """Per source and target column: rows, filled rows and whether the mapping's promise holds.

    A column the source does not map must be empty, one the contract declares
    not-NULL must be filled in every row, any other may be either.
    """
    reports = []
    for source in sources:
        for table, (build, mapping) in _CONTRIBUTIONS.items():
            schema = STAR_TABLES[table]
            rules = getattr(source.spec, mapping)(source.raw).targets()
            derived = table in ("FactSales", "DimTime")
            counts = build(source).agg(
                F.count("*").alias("RowCount"),
                *[F.count(c).alias(c) for c in schema.names],
            )
            long = _unpivot(counts, ["RowCount"], schema.names, "TargetColumn", "FilledRows")
            unmapped = [] if derived else [n for n in schema.names if n not in rules]
            required = [f.name for f in schema.fields if not f.nullable]
            rule = (
                F.when(F.col("TargetColumn").isin(unmapped), "unmapped")
                .when(F.col("TargetColumn").isin(required), "required")
                .otherwise("optional")
            )
            holds = (
                F.when(F.col("Rule") == "unmapped", F.col("FilledRows") == 0)
                .when(F.col("Rule") == "required", F.col("FilledRows") == F.col("RowCount"))
                .otherwise(True)
            )
            reports.append(
                long.withColumn("Rule", rule).select(
                    F.lit(source.spec.name).alias("SourceSystemName"),
                    F.lit(table).alias("TargetTable"),
                    "TargetColumn",
                    "Rule",
                    "RowCount",
                    "FilledRows",
                    holds.alias("Holds"),
                )
            )
    return union_all(reports)


def fingerprint(fact: DataFrame, suffix: str = "Before") -> DataFrame:
    """Rows, amount and an order-independent checksum of the rows of each source."""
    row = F.xxhash64(*STAR_TABLES["FactSales"].names).cast("decimal(20,0)")
    return fact.groupBy("SourceSystemID").agg(
        F.count("*").alias(f"Rows{suffix}"),
        F.sum("SalesAmount").alias(f"Amount{suffix}"),
        F.sum(row).alias(f"Checksum{suffix}"),
    )


def history_check(before: DataFrame, after: DataFrame, dim_source_system: DataFrame) -> DataFrame:
    """Facts per source before and after a change, e.g. a new source: known sources must not move.

    ``before`` is the ``fingerprint`` of the fact, stored before the change.

    ``HistoryUnchanged`` is NULL for a source that was not there before.
    """
    joined = fingerprint(after, "After").join(before, "SourceSystemID", "left")
    named = joined.join(F.broadcast(dim_source_system), "SourceSystemID", "left")
    same = (F.col("RowsBefore") == F.col("RowsAfter")) & (
        F.col("ChecksumBefore") == F.col("ChecksumAfter")
    )
    return named.select(
        "SourceSystemID",
        "SourceSystemName",
        F.coalesce("RowsBefore", F.lit(0)).alias("RowsBefore"),
        "RowsAfter",
        F.coalesce("AmountBefore", F.lit(0)).alias("AmountBefore"),
        "AmountAfter",
        same.alias("HistoryUnchanged"),
    )
