import random
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from starmart import RawZone, Source, Star
from starmart.operators.narrate import describe_fact_rows, nth_fact_row
from starmart.plans.catalogue import QUERIES
from starmart.schema import FACT_SALES
from starmart.sources import testdata
from tests.test_oracle import ROOT

#: The fact's columns, all of which may be NULL.
FACT_SALES_LAX = StructType([StructField(f.name, f.dataType) for f in FACT_SALES.fields])


def narrate(star, fact):
    return describe_fact_rows(
        fact, star.dim_customer, star.dim_employee, star.dim_product, star.dim_time, star.dim_source_system
    )


def sentences(star, condition):
    return [r.Sentence for r in narrate(star, star.fact_sales.where(condition)).collect()]


def test_documented_sentence(star):
    assert sentences(star, "ProductID = 'NORTHWIND:11' and DateKey = 20160704") == [
        "On July 4, 2016, one Northwind sales line item recorded customer Paul Henriot purchasing "
        "12 unit(s) of Queso Cabrales for a SalesAmount of 168.00, with the order attributed to "
        "Steven Buchanan (Sales Manager)."
    ]


def test_employee_without_title(star):
    (sentence,) = sentences(star, "DateKey = 20230829")
    assert sentence.startswith("On August 29, 2023, one Northwind")
    assert "customer an unknown customer purchasing" in sentence
    assert sentence.endswith("attributed to Michael.")


def test_missing_date_product_and_employee(star):
    (sentence,) = sentences(star, "CustomerID = 'NORTHWIND:NONAM'")
    assert sentence == (
        "On <NA>, one Northwind sales line item recorded customer an unknown customer purchasing "
        "2 unit(s) of an unknown product for a SalesAmount of 2,469.00."
    )


def test_unknown_employee_and_source(star):
    lost = star.fact_sales.where("EmployeeID = 'NORTHWIND:9'").withColumn("SourceSystemID", F.lit(9))
    (row,) = narrate(star, lost).collect()
    assert "one an unknown source sales line item" in row.Sentence
    assert row.Sentence.endswith("for a SalesAmount of 2.00.")


def test_date_that_is_not_in_dim_time_shows_the_key(star):
    fact = star.fact_sales.where("DateKey = 20161001").withColumn("DateKey", F.lit(20991231))
    (row,) = narrate(star, fact).collect()
    assert row.Sentence.startswith("On 20991231, one")


def test_every_row_has_one_sentence_without_broadcasts(star, no_broadcast):
    made = narrate(star, star.fact_sales)
    assert made.count() == star.fact_sales.count() == 10
    assert made.where(F.col("Sentence").isNull()).count() == 0


def test_nth_row(star):
    ordered = star.fact_sales.orderBy(*star.fact_sales.columns).collect()
    assert nth_fact_row(star.fact_sales, 0).collect() == [ordered[0]]
    assert nth_fact_row(star.fact_sales, 7).collect() == [ordered[7]]
    assert nth_fact_row(star.fact_sales, 10).collect() == []


@pytest.mark.parametrize("few", [1, 4])
def test_nth_row_is_found_by_counts_of_every_column(spark, few):
    """Ties in the leading columns, NULLs, texts with a common start and equal rows."""
    rng = random.Random(few)
    rows = [
        (
            rng.choice((None, 20200101, 20200102)),
            rng.choice((None, "A:1", "A:10", "A:2é", "A:2\U0001f600", f"A:{rng.randrange(5000)}")),
            rng.choice((None, "A:7")),
            rng.choice(("P:1", "P:", "P:11")),
            rng.choice((1, 2)),
            rng.choice((1, -5, 10**12)),
            Decimal(rng.choice((0, 1, 99999))) / 100,
        )
        for _ in range(300)
    ]
    rows += [rows[0]] * 20
    fact = spark.createDataFrame(rows, FACT_SALES_LAX)
    ordered = fact.orderBy(*fact.columns).collect()
    for n in [0, 1, 17, 150, 299, 319, *rng.sample(range(320), 6)]:
        assert nth_fact_row(fact, n, few).collect() == [ordered[n]]
    assert nth_fact_row(fact, 320, few).collect() == []


def test_nth_row_is_found_without_a_sort_of_the_fact(star):
    plan = nth_fact_row(star.fact_sales, 3)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "TakeOrderedAndProject" in plan


def test_names_found_per_header_are_those_found_per_line(spark, no_broadcast):
    """Repeated members and headers, lines without a header, headers without a customer or a known one."""
    customers = [(1, "Ann"), (1, "Anna"), (2, None), (3, "Cy")]
    orders = [(10, 1), (10, 3), (11, 2), (12, None), (13, 99), (14, 3)]
    tables = {
        "customer": [(k, name, 0, 0.0, "m") for k, name in customers],
        "supplier": [(1, "Sue", 0, 0.0)],
        "part": [(1, "pin", "b", "t", 1, 1.0), (1, "pin", "b", "t", 1, 1.0)],
        "orders": [(k, c, "O", 1.0, datetime(2020, 1, k), "p") for k, c in orders],
        "lineitem": [
            (k, p, s, n, q, 2.5, 0.0, 0.0, "N", "O", None)
            for n, (k, p, s, q) in enumerate(
                [(10, 1, 1, 1.0), (10, 2, None, 2.0), (11, 1, 1, 1.0), (12, 1, 1, 3.0), (13, 1, 1, 1.0), (99, 1, 1, 1.0), (14, 1, 1, None)]
            )
        ],
        "events": [(k, datetime(2020, 2, 1), u, "purchase", 1.5, '{"k": 1}') for k, u in enumerate([1, 2, 3, 98, None])],
        "nation": [(0, "N", 0)],
        "region": [(0, "R")],
    }
    raw = RawZone.frames({t: spark.createDataFrame(rows, testdata.RAW_SCHEMAS[t]) for t, rows in tables.items()})
    both = Star(spark, [Source(testdata.ORDERS, raw), Source(testdata.EVENTS, raw)])
    named = both.named_sales("CustomerName")
    assert named.columns == [*FACT_SALES.names, "CustomerName"]
    plain, fewer = narrate(both, both.fact_sales), narrate(both, named)
    assert fewer.schema == plain.schema
    rows = sorted(map(str, plain.collect()))
    assert len(rows) > 10 and sorted(map(str, fewer.collect())) == rows


def _joins(tree):
    own = [tree] if tree.nodeName() == "Join" else []
    children = tree.children()
    return own + [j for k in range(children.size()) for j in _joins(children.apply(k))]


def test_no_line_is_joined_with_customers_where_headers_are(spark, no_broadcast):
    found = QUERIES["fact_narrative"](spark, ROOT)
    joins = _joins(found._jdf.queryExecution().optimizedPlan())
    customers = [x for x in joins if "coalesce(CustomerID" in x.condition().toString()]
    # The headers of one source and the lines of the other, which has none.
    assert len(customers) == 2
    assert not any("l_quantity" in x.toString() for x in customers)
