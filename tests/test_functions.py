from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from starmart.functions.dates import key_of
from starmart.functions import canonical_key, date_key, is_whole, line_amount, line_key, parse_date, person_name, quantity, strip


def values(spark, rows, ddl, *columns):
    df = spark.createDataFrame(rows, ddl).select(*columns)
    return [tuple(r) if len(columns) > 1 else r[0] for r in df.collect()]


def key(spark, rows, ddl):
    df = spark.createDataFrame(rows, ddl)
    made = df.select(canonical_key("P", F.col("id"), df.schema["id"].dataType))
    return [r[0] for r in made.collect()]


def test_canonical_key_keeps_null_and_drops_fraction_of_whole_numbers(spark):
    assert key(spark, [(5,), (None,)], "id int") == ["P:5", None]
    assert key(spark, [(5.0,), (None,)], "id double") == ["P:5", None]
    assert key(spark, [(Decimal("5"),)], "id decimal(10,0)") == ["P:5"]
    assert key(spark, [("VINET",), ("",), (None,)], "id string") == ["P:VINET", "P:", None]


@pytest.mark.parametrize(
    "first, last, name",
    [
        ("Ana", "Silva", "Ana Silva"),
        (" Ana\t", "\nSilva ", "Ana Silva"),
        (None, "Silva", "Silva"),
        ("Ana", None, "Ana"),
        ("Ana Maria", "da  Silva", "Ana Maria da  Silva"),
        ("  ", None, ""),
        (None, None, ""),
    ],
)
def test_person_name(spark, first, last, name):
    made = person_name(F.col("f"), F.col("l"))
    assert values(spark, [(first, last)], "f string, l string", made) == [name]


@pytest.mark.parametrize(
    "text, day",
    [
        ("2016-07-04", date(2016, 7, 4)),
        ("2023-08-29 09:23:46", date(2023, 8, 29)),
        ("2023-08-29T09:23:46.123", date(2023, 8, 29)),
        ("2024-02-29", date(2024, 2, 29)),
        ("  2024-02-28", date(2024, 2, 28)),
        ("2016-07-04T23:30:00+05:00", date(2016, 7, 4)),
        ("2023-02-29", None),
        ("2016-07-04 25:00:00", None),
        ("2016-07-04 junk", None),
        ("0000-01-01", None),
        ("0001-01-01", date(1, 1, 1)),
        ("2016", None),
        ("2016-07", None),
        ("07/04/2016", None),
        ("20160704", None),
        ("12:30:00", None),
        ("junk", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_date_text(spark, text, day):
    made = parse_date(F.col("d"), StringType()), key_of(F.col("d"), StringType())
    key = None if day is None else int(day.strftime("%Y%m%d"))
    assert values(spark, [(text,)], "d string", *made) == [(day, key)]


def test_parse_date_of_typed_columns(spark):
    rows = [(date(2016, 7, 4), datetime(2016, 7, 4, 23, 59))]
    df = spark.createDataFrame(rows, "a date, b timestamp_ntz")
    parsed = df.select(*[parse_date(F.col(f.name), f.dataType) for f in df.schema.fields])
    assert tuple(parsed.first()) == (date(2016, 7, 4), date(2016, 7, 4))


def test_years_beyond_four_digits_are_unusable(spark):
    df = spark.sql("SELECT make_date(12345, 6, 7) AS d, timestamp_ntz '+294247-01-10 00:00:00' AS t")
    keys = df.select(*[key_of(F.col(f.name), f.dataType) for f in df.schema.fields])
    assert tuple(keys.first()) == (None, None)


def test_date_key(spark):
    made = date_key(F.col("d"))
    rows = [(date(2016, 7, 4),), (date(1999, 12, 31),), (None,)]
    assert values(spark, rows, "d date", made) == [20160704, 19991231, None]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(days=st.lists(st.dates(min_value=date(1000, 1, 1)), min_size=1, max_size=200))
def test_date_key_orders_like_the_date(spark, days):
    rows = [(i, d.isoformat()) for i, d in enumerate(days)]
    df = spark.createDataFrame(rows, "i int, d string")
    from_text = key_of(F.col("d"), StringType())
    from_date = date_key(parse_date(F.col("d"), StringType()))
    made = df.select("i", from_text.alias("t"), from_date.alias("d")).collect()
    expected = {i: int(d.strftime("%Y%m%d")) for i, d in enumerate(days)}
    assert {r.i: r.t for r in made} == {r.i: r.d for r in made} == expected


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts=st.lists(st.text(alphabet=" \t\nab", max_size=6), min_size=1, max_size=100))
def test_strip_removes_all_white_space_at_the_ends(spark, texts):
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "i int, t string").select("i", strip(F.col("t")).alias("t"))
    assert {r.i: r.t for r in df.collect()} == {i: t.strip() for i, t in rows}


def test_line_amount_is_exact_and_never_fails(spark):
    rows = [("0.10", "3"), ("14.00", "12"), ("free", "1"), ("1", "two"), (None, "1"), ("1", None)]
    made = values(spark, rows, "p string, q string", line_amount(F.col("p"), F.col("q")))
    assert made == [Decimal("0.30"), Decimal("168.00"), None, None, None, None]


@pytest.mark.parametrize("form", ["double", "string", "decimal(12,4)"])
def test_only_the_product_is_rounded(spark, form):
    rows = [(9.95, 2.5), (0.995, 10.0), (14.0, 12.0), (1e14, 3.0), (1e12, 0.5)]
    df = spark.createDataFrame(rows, "p double, q double").select("p", F.col("q").cast(form).alias("q"))
    made = df.select(line_amount(F.col("p"), F.col("q")), quantity(F.col("q")), is_whole(F.col("q"))).collect()
    assert [r[0] for r in made][:4] == [Decimal(x) for x in ("24.88", "9.95", "168.00", "300000000000000.00")]
    assert made[4][0] == Decimal("500000000000.00")
    assert [r[1] for r in made] == [2, 10, 12, 3, 0]
    assert [r[2] for r in made] == [False, True, True, True, False]


def test_quantities_of_text(spark):
    made = values(spark, [("10.0",), ("2.5",), ("two",), (None,)], "q string", quantity(F.col("q")))
    assert made == [10, 2, None, None]


def test_line_keys_keep_the_place_of_null(spark):
    made = values(spark, [(1, None), (None, 1), (1, 1)], "a int, b int", line_key("a", "b"))
    assert made == ["1|", "|1", "1|1"]


def test_line_amount_of_floats_is_a_decimal(spark):
    made = values(spark, [(0.1, 3.0)], "p double, q double", line_amount(F.col("p"), F.col("q")))
    assert made == [Decimal("0.30")]
    assert values(spark, [(float("nan"), 1.0)], "p double, q double", line_amount(F.col("p"), F.col("q"))) == [None]
