"""URLs judged by rules and by the reputation of their hosts, with DataFrame functions only.

A page's labelled outcomes (1 good, 0 bad) are added up by host, registered domain
and suffix. Each level shrinks its rates to its parent's: a child with s good of n
has the posterior Beta(k * m + s, k * (1 - m) + n - s), m being the parent's
posterior mean and k = 1 / rho - 1 the level's prior size, with rho, the
overdispersion of the level, estimated from the data by moments. A host is allowed
if its posterior mean less ``z`` standard deviations reaches ``least``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from starmart.scratch import stored

#: (verdict, host, path)
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
Z = 1.645
LEAST = 0.8
RHO_BOUNDS = (0.001, 0.5)
#: Where no child has two outcomes, or all outcomes are alike.
RHO_UNKNOWN = 0.1
# Second-level labels under which a two-letter top level registers names.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")

_PARTS = "://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), upper, lower)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def _by_rule(rules, then) -> Column:
    """What ``then`` gives for the longest rule that fits, else null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r[1] + r[2])):
        _, host, path = rule
        here = (F.col("host") == host) | F.col("host").endswith("." + host)
        out = F.when(here & F.col("path").startswith(path), F.lit(then(rule))).otherwise(out)
    return out


def _ranked(host: Column) -> tuple[Column, Column]:
    """Registered domain and suffix of a host without port and user; an address is its own domain."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    two = (
        (n >= 3)
        & (F.length(F.element_at(labels, -1)) == 2)
        & F.get(labels, n - 2).isin(*SECOND_LEVEL)
    )
    depth = F.when(two, 2).otherwise(1)
    address = host.rlike(r"^[0-9.]*$") | host.startswith("[")
    domain = F.array_join(F.slice(labels, F.greatest(F.lit(1), n - depth), depth + 1), ".")
    suffix = F.array_join(F.slice(labels, n - depth + 1, depth), ".")
    return F.when(address, host).otherwise(domain), F.when(address, F.lit("")).otherwise(suffix)


def _rho(children: DataFrame) -> float:
    """Overdispersion of (s of n) around the parents' means m, by moments."""
    spread = F.col("m") * (1 - F.col("m"))
    n = F.col("n")
    sums = children.agg(
        F.sum(F.pow(F.col("s") - n * F.col("m"), F.lit(2)) - n * spread).alias("above"),
        F.sum(n * (n - 1) * spread).alias("below"),
    ).first()
    if not sums["below"]:
        return RHO_UNKNOWN
    low, high = RHO_BOUNDS
    return min(high, max(low, sums["above"] / sums["below"]))


def _shrunk(children: DataFrame, name: str) -> DataFrame:
    """Children (with s, n and the parent's mean m) with the parameters of their posterior."""
    k = F.lit(1 / _rho(children) - 1)
    a = k * F.col("m") + F.col("s")
    b = k * (1 - F.col("m")) + F.col("n") - F.col("s")
    return children.select(name, "s", "n", a.alias("a"), b.alias("b"), (a / (a + b)).alias("mean"))


def reputations(pages: DataFrame, outcomes: DataFrame, z: float = Z) -> DataFrame:
    """``site``, ``n`` outcomes and the posterior ``bound`` of every site of ``pages`` (page_id, site)."""
    counted = outcomes.where(F.col("good").isin(0, 1) & F.col("page_id").isNotNull())
    counted = counted.groupBy(F.col("page_id").alias("of_page")).agg(
        F.count(F.lit(1)).alias("page_n"), F.sum("good").alias("page_s")
    )
    # A page that repeats is one row per host before it meets its outcomes.
    visits = pages.groupBy("page_id", "site").agg(F.count(F.lit(1)).alias("copies"))
    add = lambda c: F.coalesce(F.sum(F.col(c) * F.col("copies")), F.lit(0))
    domain, suffix = _ranked(F.col("site"))
    hosts = stored(
        visits.join(counted, F.col("page_id") == F.col("of_page"), "left")
        .groupBy("site")
        .agg(add("page_s").alias("s"), add("page_n").alias("n"))
        .select("site", domain.alias("domain"), suffix.alias("suffix"), "s", "n")
    )
    total = lambda df, *by: df.groupBy(*by).agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    domains = stored(total(hosts, "domain", "suffix"))
    suffixes = stored(total(domains, "suffix"))
    every = suffixes.agg(F.sum("s").alias("s"), F.sum("n").alias("n")).first()
    mean = ((every["s"] or 0) + 1) / ((every["n"] or 0) + 2)

    level = _shrunk(suffixes.withColumn("m", F.lit(mean)), "suffix")
    above = level.select("suffix", F.col("mean").alias("m"))
    level = _shrunk(stored(domains.join(above, "suffix")), "domain")
    above = level.select("domain", F.col("mean").alias("m"))
    level = _shrunk(stored(hosts.drop("suffix").join(above, "domain")), "site")
    a, b = F.col("a"), F.col("b")
    deviation = F.sqrt(a * b / (F.pow(a + b, F.lit(2)) * (a + b + 1)))
    return level.select("site", "n", (F.col("mean") - F.lit(z) * deviation).alias("bound"))


def judge(
    pages: DataFrame, outcomes: DataFrame, rules=RULES, z: float = Z, least: float = LEAST
) -> DataFrame:
    """A verdict for every row of ``pages`` (page_id bigint, url string).

    ``outcomes`` has page_id and good (1 or 0; other values are left out); every row
    counts once. Returns page_id, host, path, rule (host and path of the longest rule
    that fits, else null), verdict (allow or block: the rule's, else by the bound),
    host_outcomes and host_bound (to six places).

    A url that is null or has no ``://`` has an empty host, whose reputation is that
    of all such rows. A host without outcomes has its domain's reputation, and one
    without any relative has that of all pages. A null page_id has no outcomes.
    Without outcomes at all every mean is a half. No rows give no rows.
    """
    parted = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    bare = F.regexp_replace(F.regexp_replace("host", "^[^@]*@", ""), ":[0-9]*$", "")
    sited = parted.withColumn("site", bare)
    bounds = reputations(sited.select("page_id", "site"), outcomes, z)
    known = bounds.select(F.col("site").alias("of_site"), F.col("n").alias("host_outcomes"), "bound")
    bound = F.round("bound", 6)
    method = F.when(bound >= least, "allow").otherwise("block")
    return sited.join(known, F.col("site") == F.col("of_site")).select(
        "page_id",
        "host",
        "path",
        _by_rule(rules, lambda r: r[1] + r[2]).alias("rule"),
        F.coalesce(_by_rule(rules, lambda r: r[0]), method).alias("verdict"),
        F.col("host_outcomes").cast("bigint").alias("host_outcomes"),
        bound.alias("host_bound"),
    )
