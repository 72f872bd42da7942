"""Secrets in texts, told apart by who owns them across the corpus.

The base patterns find assignments, access keys and long hex strings. The values
of other long tokens are weighed corpus-wide: hashed, and counted by distinct
repositories (different texts of a source) and owners (sources). A value that many
owners have is a copied example; one that stays with few is likely live, in however
many of their texts it is, and such tokens become spans of their own.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from starmart.scratch import stored

# The base kinds, in this order, each with its pattern and least length.
ASSIGN = re.compile(
    r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LENGTH, ACCESS_LENGTH = 12, 18
KINDS = ("assign", "access", "hex", "opaque")

#: Tokens that may be credentials of no known form: long, with letters of both cases and digits.
OPAQUE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}(?![A-Za-z0-9+/_=-])")
LEAST_ENTROPY = 3.5
#: A value in more owners than this is a copied example.
MOST_OWNERS = 2
SALTS = 16
SLICE = 256

_SCHEMA = (
    "doc_id bigint, source string, text_hash bigint, n_assign bigint, n_access bigint, n_hex bigint, "
    "found array<struct<kind:string,start:int,end:int,value_hash:string>>"
)


def _opaque(token: str) -> bool:
    kinds = any(map(str.isdigit, token)) + any(map(str.islower, token)) + any(map(str.isupper, token))
    if kinds < 3:
        return False
    n = len(token)
    return -sum(c / n * math.log2(c / n) for c in Counter(token).values()) >= LEAST_ENTROPY


def candidates(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) of the base matches and of opaque tokens that touch none of them."""
    found = [
        ("assign", *m.span(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LENGTH
    ]
    found += [
        ("access", *m.span(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LENGTH
    ]
    found += [("hex", *m.span(), m[0]) for m in HEX.finditer(text)]
    base = sorted((start, end) for _, start, end, _ in found)
    tokens = [(*m.span(), m[0]) for m in OPAQUE.finditer(text) if _opaque(m[0])]
    at = reach = 0
    for start, end, token in tokens:
        while at < len(base) and base[at][0] < end:
            reach = max(reach, base[at][1])
            at += 1
        if reach <= start:
            found.append(("opaque", start, end, token))
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "source", "text_hash", "n_assign", "n_access", "n_hex", "found"]
    kind = pa.struct(
        [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("value_hash", pa.string())]
    )
    for whole in batches:
        for at in range(0, whole.num_rows, SLICE):
            part = whole.slice(at, SLICE)
            every = [candidates(x or "") for x in part.column("text").to_pylist()]
            tally = [Counter(x[0] for x in found) for found in every]
            listed = [
                [
                    (k, a, b, hashlib.sha256(v.encode("utf-8", "surrogatepass")).hexdigest())
                    for k, a, b, v in found
                ]
                for found in every
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("source"),
                    part.column("text_hash"),
                    *(pa.array([t[k] for t in tally], type=pa.int64()) for k in KINDS[:3]),
                    pa.array(
                        [[dict(zip(kind.names, x)) for x in found] for found in listed], type=pa.list_(kind)
                    ),
                ],
                names,
            )


def scan(docs: DataFrame, most_owners: int = MOST_OWNERS) -> DataFrame:
    """Every secret of every row, as one row per row of ``docs``.

    ``docs`` has doc_id bigint, text string and source string, the owner; other
    columns are not read. Returns doc_id, text_hash, n_assign, n_access, n_hex,
    n_live, n_example and ``secrets``, an array of (kind, start, end, value_hash,
    repositories, owners, live) by start, then kind; positions are code points, the
    end exclusive. Base matches are all there, live or not; opaque tokens only if
    live.

    A null text is an empty one. A null source counts as one owner of its own. Only
    owners decide on ``live``; repositories are the different texts, summed over the
    owners, whatever their ids. Equal rows get equal results. No value leaves the tasks, only its SHA-256.
    """
    text_hash = F.xxhash64(F.col("text").isNull(), "text").alias("text_hash")
    rows = stored(docs.select("doc_id", "source", text_hash, "text").mapInArrow(_scanned, _SCHEMA))
    uses = rows.select("doc_id", "source", "text_hash", F.explode("found").alias("use"))
    uses = uses.select("doc_id", "source", "text_hash", "use.*")
    # One row per value and text, then per value and owner, each summed in the tasks first.
    per_owner = (
        uses.select("value_hash", "source", "text_hash")
        .distinct()
        .groupBy("value_hash", "source")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # Each value once per salt, so that a value with a large part of all uses is met by many tasks.
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    owned = (
        per_owner.groupBy("value_hash")
        .agg(F.sum("n").alias("repositories"), F.count(F.lit(1)).alias("owners"))
        .select("value_hash", "repositories", "owners", salts)
    )
    salted = uses.withColumn("salt", F.pmod(F.xxhash64("doc_id", "text_hash", "start"), F.lit(SALTS)).cast("int"))
    weighed = salted.join(owned, ["value_hash", "salt"]).withColumn("live", F.col("owners") <= most_owners)
    weighed = weighed.where("live or kind != 'opaque'")
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).alias("rank")
    fields = ["start", order, "kind", "end", "value_hash", "repositories", "owners", "live"]
    of_doc = weighed.groupBy(F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_hash")).agg(
        # Equal rows list the same secrets; a set keeps one.
        F.array_sort(F.collect_set(F.struct(*fields))).alias("secrets")
    )
    same = F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("text_hash") == F.col("of_hash"))
    none = F.array().cast(of_doc.schema["secrets"].dataType)
    secrets = F.coalesce("secrets", none)
    out = rows.drop("found").join(of_doc, same, "left").withColumn("secrets", secrets)
    return out.select(
        "doc_id",
        "text_hash",
        "n_assign",
        "n_access",
        "n_hex",
        F.size(F.filter("secrets", lambda x: x["live"])).cast("bigint").alias("n_live"),
        F.size(F.filter("secrets", lambda x: ~x["live"])).cast("bigint").alias("n_example"),
        F.transform("secrets", lambda x: x.dropFields("rank")).alias("secrets"),
    )


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns from scan()'s."""

    def joined(spans):
        return F.array_join(
            F.transform(
                spans,
                lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string")),
            ),
            ",",
        )

    base = F.filter("secrets", lambda x: x["kind"] != "opaque")
    return found.select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("secrets")).alias("spans"),
        "n_live",
        "n_example",
    )
