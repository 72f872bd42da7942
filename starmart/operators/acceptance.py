"""Acceptance of the star's totals against documented figures."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from starmart.operators.bi import totals_rollup
from starmart.operators.filters import Selection, date_bounds

TOLERANCE = 0.01

# The documented SalesAmount totals of the two original systems.
DOCUMENTED_TOTALS = {
    "Chinook": 2328.60,
    "Northwind": 448475298.72,
    "Combined": 448477627.32,
}


def check_totals(
    fact: DataFrame,
    dim_source_system: DataFrame,
    documented: DataFrame,
    tolerance: float = TOLERANCE,
    selection: Selection | None = None,
) -> DataFrame:
    """Documented (``Label``, ``Documented``) next to computed totals; a missing total counts 0.

    ``fact`` is the whole fact. The figures are of all of it, so a ``selection``
    that leaves sources or days out has nothing to be held against: no rows. To
    find that out, one row per source and the two days come to the driver.
    """
    if selection is not None:
        names = [r.SourceSystemName for r in dim_source_system.select("SourceSystemName").collect()]
        if not selection.covers(names, *date_bounds(fact).first()):
            documented = documented.limit(0)
    computed = totals_rollup(fact, dim_source_system).select(
        "Label", F.col("SalesAmount").alias("Computed")
    )
    both = documented.join(computed, "Label", "left").select(
        "Label",
        F.col("Documented").cast("decimal(38,2)").alias("Documented"),
        F.coalesce("Computed", F.lit(0)).cast("decimal(38,2)").alias("Computed"),
    )
    difference = F.col("Computed") - F.col("Documented")
    allowed = F.lit(str(tolerance)).cast("decimal(18,6)")
    return both.withColumn("Difference", difference).withColumn(
        "Matches", F.abs("Difference") <= allowed
    )


def assert_documented_totals(
    fact: DataFrame,
    dim_source_system: DataFrame,
    documented: Mapping[str, float] = DOCUMENTED_TOTALS,
    tolerance: float = TOLERANCE,
) -> dict[str, float]:
    """Computed totals by label; raises AssertionError that names every mismatch.

    Brings one row per documented label to the driver.
    """
    expected = fact.sparkSession.createDataFrame(
        [(label, str(total)) for label, total in documented.items()],
        "Label string, Documented string",
    )
    found = check_totals(fact, dim_source_system, expected, tolerance).collect()
    off = sorted((r for r in found if not r.Matches), key=lambda r: r.Label)
    if off:
        listed = "; ".join(f"{r.Label} is {r.Computed} instead of {r.Documented}" for r in off)
        raise AssertionError(f"{len(off)} of {len(found)} totals are off by more than {tolerance}: {listed}")
    return {r.Label: float(r.Computed) for r in found}
