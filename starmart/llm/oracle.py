"""SQL of the corpus queries that SQL can express."""

from __future__ import annotations

from starmart.llm import importance, interaction, mixing, url_reputation as url

_SECOND = ", ".join(f"'{x}'" for x in url.SECOND_LEVEL)


def _rule_cases(then) -> str:
    ordered = sorted(url.RULES, key=lambda r: len(r[1] + r[2]), reverse=True)
    return "CASE " + " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{then((v, h, p))}'"
        for v, h, p in ordered
    )


def _level(name: str, children: str, parents: str, on: str) -> str:
    """CTEs: children with their parent's mean, the level's prior size, and the posterior."""
    return f"""
{name}_m AS (SELECT c.*, p.mean AS m FROM {children} c JOIN {parents} p ON {on}),
{name}_k AS (SELECT 1 / rho - 1 AS k FROM (
    SELECT CASE WHEN below IS NULL OR below = 0 THEN {url.RHO_UNKNOWN}
           ELSE least({url.RHO_BOUNDS[1]}, greatest({url.RHO_BOUNDS[0]}, above / below)) END AS rho
    FROM (SELECT sum(pow(s - n * m, 2) - n * m * (1 - m)) AS above, sum(n * (n - 1) * m * (1 - m)) AS below
          FROM {name}_m) sums) rhos),
{name}_post AS (SELECT x.*, k * m + s AS a, k * (1 - m) + n - s AS b, (k * m + s) / (k + n) AS mean
    FROM {name}_m x, {name}_k)"""


URLS = f"""
WITH parted AS (
    SELECT page_id,
        translate(coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path
    FROM pages),
sited AS (
    SELECT *, regexp_replace(regexp_replace(host, '^[^@]*@', ''), ':[0-9]*$', '') AS site FROM parted),
outcomes AS (
    SELECT doc_id, count(*) AS n, sum(quality) AS s FROM labels
    WHERE quality IN (0, 1) AND doc_id IS NOT NULL GROUP BY doc_id),
counted AS (
    SELECT site, coalesce(sum(s), 0)::DOUBLE AS s, coalesce(sum(n), 0)::DOUBLE AS n
    FROM sited LEFT JOIN outcomes ON page_id = doc_id GROUP BY site),
split AS (SELECT *, string_split(site, '.') AS parts FROM counted),
deep AS (
    SELECT *, len(parts) AS size,
        CASE WHEN len(parts) >= 3 AND length(parts[len(parts)]) = 2 AND parts[len(parts) - 1] IN ({_SECOND})
             THEN 2 ELSE 1 END AS depth,
        regexp_matches(site, '^[0-9.]*$') OR starts_with(site, '[') AS address
    FROM split),
hosts AS (
    SELECT site, s, n,
        CASE WHEN address THEN site
             ELSE array_to_string(list_slice(parts, greatest(1, size - depth), size), '.') END AS domain,
        CASE WHEN address THEN '' ELSE array_to_string(list_slice(parts, size - depth + 1, size), '.') END AS suffix
    FROM deep),
domains AS (SELECT domain, suffix, sum(s) AS s, sum(n) AS n FROM hosts GROUP BY domain, suffix),
suffixes AS (SELECT suffix, sum(s) AS s, sum(n) AS n FROM domains GROUP BY suffix),
everything AS (SELECT (sum(s) + 1) / (sum(n) + 2) AS mean FROM suffixes),
{_level("suffix", "suffixes", "everything", "true")},
{_level("domain", "domains", "suffix_post", "c.suffix = p.suffix")},
{_level("host", "hosts", "domain_post", "c.domain = p.domain")},
bounds AS (
    SELECT site AS of_site, n, round(mean - {url.Z} * sqrt(a * b / (pow(a + b, 2) * (a + b + 1))), 6) AS bound
    FROM host_post)
SELECT page_id, host, path,
    {_rule_cases(lambda r: r[1] + r[2])} END AS rule,
    {_rule_cases(lambda r: r[0])} WHEN bound >= {url.LEAST} THEN 'allow' ELSE 'block' END AS verdict,
    CAST(n AS BIGINT) AS host_outcomes, bound AS host_bound
FROM sited JOIN bounds ON site = of_site
"""

TOP_K = """
WITH rows_ AS (
    SELECT vec_id, min(v) AS v FROM (
        SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0) known
    GROUP BY vec_id),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM rows_ q JOIN rows_ c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 10
"""


def _number(digits: int, text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, {digits}) AS BIGINT)"


_ID = (
    "CASE WHEN doc_id IS NULL THEN 'null' ELSE 'id' END || ':' || coalesce(CAST(doc_id AS VARCHAR), '')"
    " || ':' || coalesce(md5(text), 'null')"
)
MIX = f"""
WITH sized AS (SELECT source AS of_source, count(*) AS n FROM documents GROUP BY source),
every AS (SELECT sum(n) AS n, sum(pow(n, {mixing.TEMPERATURE})) AS weight FROM sized),
rated AS (
    SELECT of_source, {mixing.EPOCHS} * every.n / every.weight * pow(sized.n, {mixing.TEMPERATURE}) / sized.n AS rate
    FROM sized, every),
summed AS (
    SELECT of_source, sum(exp(-rate + k * ln(rate) - lgamma(k + 1))) OVER (PARTITION BY of_source ORDER BY k) AS total
    FROM (SELECT *, unnest(range(0, CAST(ceil(rate + 12 * sqrt(rate) + 40) AS BIGINT) + 1)) AS k FROM rated) listed),
drawn AS (
    SELECT doc_id, source, text, {_ID} AS name,
        {_number(13, f"'count {mixing.SEED}:' || {_ID}")} / {float(16**13)} AS u
    FROM documents),
levels AS (SELECT of_source, list(total ORDER BY total) AS totals FROM summed GROUP BY of_source),
counted AS (
    SELECT doc_id, source, text, name, len(list_filter(totals, lambda x: x <= u)) AS n
    FROM drawn JOIN levels ON source IS NOT DISTINCT FROM of_source),
copies AS (SELECT doc_id, source, text, name, unnest(range(1, n + 1)) AS copy FROM counted)
SELECT doc_id, source, text, CAST(copy AS INTEGER) AS copy,
    {_number(15, f"'order {mixing.SEED}:' || name || ':' || copy")} AS shuffle_key
FROM copies
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The checksum of a word is worked out from its bytes, as there is no function for it.
IMPORTANCE = f"""
WITH crc_table AS (
    SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END,
        i) ORDER BY i) AS step
    FROM range(256) t(i)),
texts AS (
    SELECT 'd' AS kind, row_number() OVER () AS nr, doc_id, text FROM documents
    UNION ALL SELECT 'b', -row_number() OVER (), NULL, text FROM benchmark),
listed AS (
    SELECT kind, nr, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word
    FROM texts),
spelled AS (
    SELECT word, hex(encode(word)) AS digits FROM (SELECT DISTINCT word FROM listed) w),
summed AS (
    SELECT word, xor(list_reduce(
            list_transform(range(CAST(length(digits) / 2 AS BIGINT)),
                lambda i: CAST('0x' || substr(digits, 2 * i + 1, 2) AS BIGINT)),
            lambda c, x: xor(c >> 8, step[1 + xor(c & 255, x)]), 4294967295), 4294967295) % {importance.BUCKETS}
        AS bucket
    FROM spelled, crc_table),
hashed AS (SELECT kind, nr, bucket FROM listed JOIN summed USING (word)),
totals AS (
    SELECT count(*) FILTER (kind = 'd') AS big_s, count(*) FILTER (kind = 'b') AS big_t FROM hashed),
gains AS (
    SELECT bucket, CAST(floor(1000 * ln((t + 1)::DOUBLE * (big_s + {importance.BUCKETS})
        / ((s + 1)::DOUBLE * (big_t + {importance.BUCKETS})))) AS BIGINT) AS gain
    FROM (SELECT bucket, count(*) FILTER (kind = 'd') AS s, count(*) FILTER (kind = 'b') AS t
          FROM hashed GROUP BY bucket) c, totals),
weighed AS (
    SELECT nr, count(*) AS n, CAST(floor(sum(gain)::DOUBLE / count(*)) AS BIGINT) AS weight
    FROM hashed JOIN gains USING (bucket) WHERE kind = 'd' GROUP BY nr),
scored AS (
    SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(
            sha256('{importance.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE)
            / 4294967296))) AS BIGINT) AS score
    FROM texts LEFT JOIN weighed USING (nr) WHERE kind = 'd'),
ranked AS (
    SELECT *, n_features >= {importance.LEAST_WORDS} AS fits,
        row_number() OVER (PARTITION BY n_features >= {importance.LEAST_WORDS} ORDER BY score DESC, doc_id) AS place,
        count(*) FILTER (n_features >= {importance.LEAST_WORDS}) OVER () AS fitting
    FROM scored)
SELECT doc_id, n_features, weight, score,
    CASE WHEN fits AND place <= {importance.PERCENT} * fitting // 100 THEN place END AS rank
FROM ranked
"""

AUDIT = f"""
WITH docs AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
        regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
    FROM documents),
marks AS (
    SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS bad FROM labels
    WHERE doc_id IS NOT NULL GROUP BY doc_id),
failing AS (
    SELECT doc_id, part,
        CASE WHEN len(words) < {interaction.LEAST_WORDS} THEN 'A' ELSE '' END
        || CASE WHEN 100 * len(list_distinct(words)) < {interaction.LEAST_DISTINCT} * len(words) THEN 'B' ELSE '' END
        || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > {interaction.MOST_CAPITALS} * length(t)
            THEN 'C' ELSE '' END
        || CASE WHEN regexp_matches(t, '{interaction.MARKS}') THEN 'D' ELSE '' END
        || CASE WHEN min(doc_id) OVER (PARTITION BY t) < doc_id THEN 'E' ELSE '' END AS fails
    FROM docs),
grouped AS (
    SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (bad) AS bad
    FROM failing LEFT JOIN marks USING (doc_id) GROUP BY part, fails),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE a.x NOT IN (b.x, c.x, d.x, e.x) AND b.x NOT IN (c.x, d.x, e.x) AND c.x NOT IN (d.x, e.x) AND d.x <> e.x),
removals AS (
    SELECT part, fails, n, good, bad, filter_order,
        list_min(list_transform(string_split(fails, ''), lambda f: instr(filter_order, f))) AS gone
    FROM (SELECT * FROM grouped WHERE fails <> '') g, orders
    UNION ALL SELECT part, fails, n, good, bad, filter_order, 99 FROM grouped, orders WHERE fails = ''),
stepped AS (
    SELECT part, filter_order, step, substr(filter_order, step, 1) AS letter, fails, n, good, bad, gone
    FROM removals, (SELECT unnest(range(1, 6)) AS step) s),
counted AS (
    SELECT part, filter_order, CAST(step AS INTEGER) AS step, letter,
        CAST(coalesce(sum(n) FILTER (gone > step), 0) AS BIGINT) AS kept,
        CAST(coalesce(sum(n) FILTER (gone = step), 0) AS BIGINT) AS removed,
        CAST(coalesce(sum(n) FILTER (gone < step AND contains(fails, letter)), 0) AS BIGINT) AS redundant,
        CAST(coalesce(sum(n) FILTER (fails = letter), 0) AS BIGINT) AS unique_fails,
        CAST(coalesce(sum(good) FILTER (gone = step), 0) AS BIGINT) AS good_lost,
        CAST(coalesce(sum(bad) FILTER (gone = step), 0) AS BIGINT) AS toxic_lost
    FROM stepped GROUP BY part, filter_order, step, letter)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM counted
"""

ORACLE = {"op4_url_reputation": URLS, "op7_top_k": TOP_K, "op8_poisson_mix": MIX}
ORACLE |= {"op11_importance_sample": IMPORTANCE, "op12_filter_audit": AUDIT}
