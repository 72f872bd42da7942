from dataclasses import replace
from pathlib import Path

import pytest

from starmart import RawZone, Source
from starmart.operators import keyfinder, profile, quality
from starmart.sources import testdata
from starmart.sources.spec import ForeignKey
from starmart.sources.testdata import ORDERS


@pytest.fixture(scope="module")
def source(spark):
    tables = {
        "orders": spark.createDataFrame(
            [(i, f"c{i % 5}", None if i % 3 else i % 4, i / 7) for i in range(500)], "id int, customer string, rep short, amount double"
        ),
        "lines": spark.createDataFrame([(i // 3, i % 3, i % 50) for i in range(1200)], "order_id long, line int, part long"),
        "customers": spark.createDataFrame([(f"c{i}", i) for i in range(6)], "code string, boss int"),
        "parts": spark.createDataFrame([(i, None if i == 0 else f"p{i}") for i in range(49)], "part_id long, name string"),
        "empty": spark.createDataFrame([], "a int, b string"),
        "measures": spark.createDataFrame([(1.0,), (2.0,)], "x double"),
    }
    spec = replace(
        ORDERS,
        tables=tuple(tables),
        primary_keys={"orders": ("id",), "lines": ("line", "order_id")},
        foreign_keys=(ForeignKey("lines", ("order_id",), "orders", ("id",)), ForeignKey("lines", ("part",), "parts", ("part_id",))),
    )
    return Source(spec, RawZone.frames(tables))


def test_keys_that_hold_are_found(source):
    made = keyfinder.discovered_keys(source).collect()
    found = {(r.TableName, r.KeyColumns, r.References): r.Declared for r in made}
    assert len(found) == len(made)
    keys = {k[:2]: v for k, v in found.items() if k[2] is None}
    # A column with a NULL is no key, nor is a fraction; a table without rows has none.
    assert keys == {
        ("orders", "id"): True, ("lines", "order_id,line"): True, ("lines", "order_id,part"): False,
        ("customers", "code"): False, ("customers", "boss"): False, ("parts", "part_id"): False,
    }
    assert found["lines", "order_id", "orders(id)"] is True
    assert found["orders", "customer", "customers(code)"] is False
    assert found["orders", "rep", "parts(part_id)"] is False
    # Part 49 is in no part.
    assert ("lines", "part", "parts(part_id)") not in found
    assert ("lines", "part", "orders(id)") in found


def exact(source):
    """All references by sets of values."""
    tables = {n: source.raw.delivered(n) for n in source.spec.tables}
    values, unique = {}, set()
    for name, df in tables.items():
        for f in df.schema.fields:
            kind = keyfinder._kind(f.dataType)
            if kind:
                own = [r[0] for r in df.select(f.name).collect()]
                values[name, f.name, kind] = {x for x in own if x is not None}
                if own and len(set(own)) == len(own) and None not in own:
                    unique.add((name, f.name, kind))
    return {
        (a[0], a[1], f"{b[0]}({b[1]})")
        for a, v in values.items() for b in unique if a != b and v and a[2] == b[2] and v <= values[b]
    }


@pytest.mark.parametrize("bits", [62, 3])
def test_references_are_those_of_all_values(source, monkeypatch, bits):
    monkeypatch.setattr(keyfinder, "BITS", bits)
    made = keyfinder.discovered_keys(source, pairs_of_columns=False).where("References IS NOT NULL").collect()
    assert {(r.TableName, r.KeyColumns, r.References) for r in made} == exact(source)


def test_declared_keys_that_hold_are_found(spark):
    root = "/root/testdata/sf0.001"
    if not Path(root).exists():
        pytest.skip("the driver's tables are not here")
    (source,) = testdata.sources(spark, root, ORDERS)
    made = keyfinder.discovered_keys(source).where("Declared").collect()
    found = {(r.TableName, r.KeyColumns, r.References) for r in made}
    held = profile.pk_uniqueness(source).where("IsPrimaryKey").collect()
    keys = {(r.TableName, r.KeyColumns, None) for r in held}
    usage = quality.source_foreign_keys([source]).where("OrphanRows = 0").collect()
    names = {f"{f.table}({f.columns[0]})": (f.table, f.columns[0]) for f in ORDERS.foreign_keys}
    assert found == keys | {(*names[r.ForeignKey], r.References) for r in usage}
