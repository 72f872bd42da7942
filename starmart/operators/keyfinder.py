"""Keys found in the data, for tables that come without any declared.

One pass per table makes a sketch of every column that could be a key or refer to
one. The sketches nominate: a column with about as many values as rows may be
unique, one whose values add next to nothing to those of a unique column may refer
to it. Only what is nominated is confirmed exactly, all of it together: values are
grouped with the columns they stand in as bits of one number, and which columns lie
within which follows from the few numbers there are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ByteType, DataType, IntegerType, LongType, ShortType, StringType

from starmart.sources.spec import Source, union_all

#: Kinds of columns that can be keys; a column refers to one of its own kind only.
_KINDS: tuple[tuple[str, tuple[type[DataType], ...]], ...] = (
    ("number", (ByteType, ShortType, IntegerType, LongType)),
    ("text", (StringType,)),
)
#: The sketches' size (2 ** LG registers, a standard error of 1.6 percent) and how far an estimate may be off.
LG, SLACK = 12, 0.1
#: Columns that one number has bits for.
BITS = 62


@dataclass(frozen=True)
class Candidate:
    """A column that could take part in a key."""

    table: str
    column: str
    kind: str
    rows: int
    filled: int
    sketch: bytearray | None
    distinct: float

    @property
    def may_be_unique(self) -> bool:
        return self.rows > 0 and self.filled == self.rows and self.distinct >= (1 - SLACK) * self.rows


def _kind(data_type: DataType) -> str | None:
    return next((name for name, types in _KINDS if isinstance(data_type, types)), None)


def _value(column: str, kind: str) -> Column:
    return F.col(column).cast("bigint" if kind == "number" else "string")


def candidates(name: str, df: DataFrame) -> list[Candidate]:
    """Counts and a sketch of every column of a table that could be a key: one pass, one row to the driver."""
    kinds = {f.name: _kind(f.dataType) for f in df.schema.fields}
    columns = [c for c, kind in kinds.items() if kind]
    if not columns:
        return []
    sums = [F.count(F.lit(1)).alias("rows")]
    for k, c in enumerate(columns):
        sketch = F.hll_sketch_agg(_value(c, kinds[c]), LG)
        sums += [F.count(c).alias(f"filled_{k}"), sketch.alias(f"sketch_{k}")]
    made = df.agg(*sums)
    made = made.select("*", *[F.hll_sketch_estimate(f"sketch_{k}").alias(f"distinct_{k}") for k in range(len(columns))])
    r = made.first()
    return [
        Candidate(name, c, kinds[c], r.rows, r[f"filled_{k}"], r[f"sketch_{k}"], r[f"distinct_{k}"] or 0)
        for k, c in enumerate(columns)
    ]


def _nominated(spark: SparkSession, found: Sequence[Candidate]) -> list[tuple[int, int]]:
    """(child, parent) by position: the child's values hardly add to the parent's, as sketches tell."""
    parents = [i for i, c in enumerate(found) if c.may_be_unique]
    pairs = [
        (i, j) for i, c in enumerate(found) for j in parents if i != j and c.kind == found[j].kind and c.filled
    ]
    if not pairs:
        return []
    # One row per pair of columns.
    rows = [(i, j, found[i].sketch, found[j].sketch) for i, j in pairs]
    df = spark.createDataFrame(rows, "i int, j int, child binary, parent binary")
    both = df.select("i", "j", F.hll_sketch_estimate(F.hll_union("child", "parent")).alias("both"))
    return [(r.i, r.j) for r in both.collect() if r.both <= (1 + SLACK) * found[r.j].distinct + 1]


def _repeated(tables: Mapping[str, DataFrame], keys: Sequence[tuple[str, tuple[str, ...]]]) -> set[int]:
    """Positions of those column lists in which some value stands twice: each counted exactly."""
    if not keys:
        return set()
    checks = []
    for k, (table, columns) in enumerate(keys):
        copies = tables[table].groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
        checks.append(copies.agg(F.max("n").alias("most")).select(F.lit(k).alias("k"), "most"))
    return {r.k for r in union_all(checks).collect() if (r.most or 0) > 1}


def _inclusions(
    tables: Mapping[str, DataFrame], found: Sequence[Candidate], pairs: Sequence[tuple[int, int]]
) -> set[tuple[int, int]]:
    """The pairs of which every value of the child stands in the parent.

    Every value meets once, with a bit for each column that holds it; there are at
    most as many different numbers as values, and in fact as there are ways in which
    columns overlap. Pairs are checked in groups of columns that share a number's bits.
    """
    holds: set[tuple[int, int]] = set()
    left = list(pairs)
    while left:
        group: list[int] = []
        now = []
        for i, j in left:
            more = [x for x in (i, j) if x not in group]
            if len(group) + len(more) <= BITS:
                group += more
                now.append((i, j))
        left = [p for p in left if p not in set(now)]
        bit = {x: k for k, x in enumerate(group)}
        by_table: dict[str, list[int]] = {}
        for x in group:
            by_table.setdefault(found[x].table, []).append(x)
        parts = []
        for table, columns in by_table.items():
            entries = F.array(
                *[
                    F.struct(
                        F.lit(found[x].kind).alias("kind"),
                        _value(found[x].column, found[x].kind).cast("string").alias("value"),
                        F.lit(1 << bit[x]).cast("bigint").alias("bits"),
                    )
                    for x in columns
                ]
            )
            parts.append(tables[table].select(F.inline(entries)).where("value IS NOT NULL"))
        by_value = union_all(parts).groupBy("kind", "value").agg(F.bit_or("bits").alias("bits"))
        patterns = [r.bits for r in by_value.select("bits").distinct().collect()]
        for i, j in now:
            if not any(p >> bit[i] & 1 and not p >> bit[j] & 1 for p in patterns):
                holds.add((i, j))
    return holds


def discovered_keys(source: Source, pairs_of_columns: bool = True) -> DataFrame:
    """TableName, KeyColumns, References, Declared: keys and references that hold on a source's data.

    A key is a column of whole numbers or text, or (where ``pairs_of_columns``) a pair of
    them none of which is one by itself, that is filled and different in every row;
    its References is NULL. A reference is such a column, with some value, all of whose
    values stand in a key of one column and the same kind; the key may be in the same table.
    Declared tells whether the source's spec names it. A table without rows has neither.
    Only sketches, counts and patterns of columns come to the driver.
    """
    spec = source.spec
    tables = {name: source.raw.delivered(name) for name in spec.tables}
    found = [c for name, df in tables.items() for c in candidates(name, df)]
    spark = next(iter(tables.values())).sparkSession
    likely = [i for i, c in enumerate(found) if c.may_be_unique]
    off = _repeated(tables, [(found[i].table, (found[i].column,)) for i in likely])
    single = {i for k, i in enumerate(likely) if k not in off}

    keys = [(found[i].table, (found[i].column,)) for i in sorted(single)]
    if pairs_of_columns:
        keys += _paired_keys(tables, found, single)
    references = _inclusions(tables, found, [(i, j) for i, j in _nominated(spark, found) if j in single])

    declared_keys = {(t, frozenset(k)) for t, k in spec.primary_keys.items()}
    declared = {(f.table, f.columns, f.parent, f.parent_columns) for f in spec.foreign_keys}
    rows = [(t, ",".join(k), None, (t, frozenset(k)) in declared_keys) for t, k in keys]
    for i, j in sorted(references):
        child, parent = found[i], found[j]
        named = (child.table, (child.column,), parent.table, (parent.column,)) in declared
        rows.append((child.table, child.column, f"{parent.table}({parent.column})", named))
    return spark.createDataFrame(
        [(spec.name, *r) for r in rows],
        "SourceSystem string, TableName string, KeyColumns string, References string, Declared boolean",
    )


def _paired_keys(
    tables: Mapping[str, DataFrame], found: Sequence[Candidate], single: set[int]
) -> list[tuple[str, tuple[str, ...]]]:
    """Pairs of columns that are a key together, none by itself: sketched per table, then counted."""
    likely: list[tuple[str, tuple[str, ...]]] = []
    for name, df in tables.items():
        own = [c for i, c in enumerate(found) if c.table == name and i not in single and c.rows and c.filled == c.rows]
        pairs = [
            (a, b)
            for a, b in combinations(own, 2)
            # Together they have no more values than the product of what each has.
            if a.distinct * b.distinct * (1 + SLACK) ** 2 >= a.rows
        ]
        if not pairs:
            continue
        sums = [
            F.hll_sketch_estimate(F.hll_sketch_agg(F.xxhash64(a.column, b.column), LG)).alias(f"p{k}")
            for k, (a, b) in enumerate(pairs)
        ]
        r = df.agg(*sums).first()
        likely += [
            (name, (a.column, b.column)) for k, (a, b) in enumerate(pairs) if r[f"p{k}"] >= (1 - SLACK) * a.rows
        ]
    off = _repeated(tables, likely)
    return [key for k, key in enumerate(likely) if k not in off]
