"""Employees and their managers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starmart.operators.joins import lookup
from starmart.scratch import discard, stored


def employee_manager(dim_employee: DataFrame) -> DataFrame:
    """Each employee with the manager's name and title; NULL where there is no manager."""
    managers = dim_employee.select(
        F.col("EmployeeID").alias("ManagerID"),
        F.col("EmployeeName").alias("ManagerName"),
        F.col("Title").alias("ManagerTitle"),
    )
    staff = dim_employee.select("EmployeeID", "EmployeeName", "Title", "ReportsTo")
    return lookup(staff, managers, "ReportsTo", "ManagerID")


def self_reports(dim_employee: DataFrame) -> DataFrame:
    """Employees who are their own manager: a finding; the roll-up takes them as the head of their team."""
    return dim_employee.where(F.col("EmployeeID") == F.col("ReportsTo")).select(
        "EmployeeID", "EmployeeName"
    )


def _doubled(state: DataFrame) -> DataFrame:
    """From everyone's sums over the levels within some reach, and who stands that far above, twice the reach."""
    below = (
        state.where(F.col("Above").isNotNull())
        .groupBy(F.col("Above").alias("Manager"))
        .agg(F.sum("Amount").alias("MoreAmount"), F.sum("People").alias("MorePeople"))
    )
    further = state.select(F.col("EmployeeID").alias("Middle"), F.col("Above").alias("Further"))
    joined = state.join(below, F.col("EmployeeID") == F.col("Manager"), "left")
    joined = joined.join(further, F.col("Above") == F.col("Middle"), "left")
    return stored(
        joined.select(
            "EmployeeID",
            F.col("Further").alias("Above"),
            (F.col("Amount") + F.coalesce("MoreAmount", F.lit(0))).cast("decimal(38,2)").alias("Amount"),
            (F.col("People") + F.coalesce("MorePeople", F.lit(0))).cast("bigint").alias("People"),
        )
    )


def manager_rollup(fact: DataFrame, dim_employee: DataFrame) -> DataFrame:
    """Sales of each employee and of everyone below them, at any depth.

    Every employee has one pointer to the superior 2**k levels up and the sums over
    the 2**k levels from themself down; a round doubles both, so a hierarchy of n
    levels takes log2(n) rounds of one row per employee. Rounds are tables in the
    shared folder, the one before is deleted. Jobs run while this is built.

    Who reports to themself or to nobody known heads a team. Raises ValueError if
    someone still has a superior further up than there are employees: such people
    stand in a cycle or below one.
    """
    own = (
        fact.where(F.col("EmployeeID").isNotNull())
        .groupBy("EmployeeID")
        .agg(F.sum("SalesAmount").alias("Amount"))
    )
    staff = stored(
        dim_employee.join(own, "EmployeeID", "left").select(
            "EmployeeID",
            "EmployeeName",
            F.when(F.col("ReportsTo") != F.col("EmployeeID"), F.col("ReportsTo")).alias("ReportsTo"),
            F.coalesce("Amount", F.lit(0)).cast("decimal(38,2)").alias("OwnAmount"),
        )
    )
    members = staff.count()
    state = stored(
        staff.select(
            "EmployeeID",
            F.col("ReportsTo").alias("Above"),
            F.col("OwnAmount").alias("Amount"),
            F.lit(1).cast("bigint").alias("People"),
        )
    )
    reach = 1
    while not state.where(F.col("Above").isNotNull()).isEmpty():
        if reach > members:
            some = [r.EmployeeID for r in state.where(F.col("Above").isNotNull()).orderBy("EmployeeID").take(5)]
            raise ValueError(f"the employee hierarchy is cyclic; in a cycle or below one: {', '.join(some)}")
        before, state = state, _doubled(state)
        discard(before)
        reach *= 2
    sums = state.select("EmployeeID", "Amount", "People")
    return staff.join(sums, "EmployeeID").select(
        "EmployeeID",
        "EmployeeName",
        (F.col("People") - 1).alias("PeopleBelow"),
        F.col("OwnAmount"),
        F.col("Amount").alias("TeamAmount"),
    )
