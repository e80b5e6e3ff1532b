"""URL filter: fixed host/path rules, else an empirical-Bayes host reputation.

Native: DataFrame functions only.

Labelled page outcomes (bad or not) are counted per host, registered domain
and public suffix. Each level's bad rate is shrunk towards its parent's
posterior mean by a beta-binomial prior (suffix towards the overall rate, domain
towards suffix, host towards domain); the prior strengths come from the spread
between groups (method of moments). A host is blocked when the lower bound of
its posterior bad rate exceeds ``threshold``, that is, when it is surely bad.

Defined results: a null url or one without ``://`` has empty host and path and
takes part under the empty host; unlabelled hosts inherit their domain's prior;
with no labelled page at all every url without a rule is allowed; repeated
page rows are judged alike and each counts; outcomes are one per page_id
(repeated outcomes of a page are merged: bad if any is); null outcomes are
ignored. Other columns are dropped, so their names never clash.

Scale: pages are read twice with two string columns at most; counts are
pre-aggregated per host before any shuffle by host; the levels above are joins
of host-sized tables; the join back to pages is a plain equi-join that AQE
broadcasts or splits when one host holds a large share of the rows. Only three
numbers (the level strengths and the overall rate) reach the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The rules of the contract, verdict by host/path.
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
# Public suffixes of two labels that are told from plain domains.
TWO_LABEL_SUFFIXES = ("ac.uk", "co.jp", "co.nz", "co.uk", "co.za", "com.ar", "com.au", "com.br", "com.mx", "gov.uk", "org.uk")

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
THRESHOLD, Z = 0.5, 1.64
MIN_STRENGTH, MAX_STRENGTH = 1.0, 10000.0


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, URL, 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits; of equally long ones the first by name."""
    fits = []
    for rule in sorted(rules, key=lambda r: (-len(r), r)):
        name, slash, rest = rule.partition("/")
        fits.append(F.when(((host == name) | host.endswith("." + name)) & path.startswith(slash + rest), F.lit(rule)))
    return F.coalesce(*fits) if fits else F.lit(None).cast("string")


def suffix_of(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*TWO_LABEL_SUFFIXES), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*TWO_LABEL_SUFFIXES), F.substring_index(host, ".", -3)).otherwise(two)


def _spread(level: str) -> list[Column]:
    """Sums over the groups of one level: labelled, bad, groups, sum of x²/n."""
    has = F.col("n") > 0
    return [
        F.sum("n").alias(f"{level}_n"),
        F.sum("x").alias(f"{level}_x"),
        F.sum(has.cast("long")).alias(f"{level}_g"),
        F.sum(F.when(has, F.col("x") * F.col("x") / F.col("n"))).alias(f"{level}_q"),
    ]


def strength(n: float, x: float, g: float, q: float) -> float:
    """Method-of-moments pseudo-count of the groups' common beta prior."""
    if not n:
        return MIN_STRENGTH
    m = x / n
    within, between = m * (1 - m), q / n - m * m
    excess = between - within * g / n
    if excess <= 0:
        return MAX_STRENGTH
    return min(MAX_STRENGTH, max(MIN_STRENGTH, (within - between) / excess))


def host_reputation(pages: DataFrame, outcomes: DataFrame, z: float = Z) -> DataFrame:
    """One row per host: n_labelled, n_bad and ``bad_low``, the posterior bound.

    ``pages`` has page_id and url, ``outcomes`` page_id and bad (boolean).
    """
    merged = outcomes.where(F.col("bad").isNotNull() & F.col("page_id").isNotNull()).groupBy("page_id").agg(F.max(F.col("bad").cast("long")).alias("bad"))
    seen = pages.select("page_id", host_of(F.col("url")).alias("host")).join(merged, "page_id", "left")
    hosts = seen.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("x"))
    hosts = hosts.withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))})
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
    k, rate = {}, 0.0
    for level, frame in (("host", hosts), ("domain", domains), ("suffix", suffixes)):
        row = [float(v or 0) for v in frame.agg(*_spread(level)).first()]
        k[level] = strength(*row)
        rate = row[1] / row[0] if row[0] else 0.0

    def shrunk(level: str, parent: Column) -> Column:
        return (F.lit(k[level]) * parent + F.col("x")) / (F.lit(k[level]) + F.col("n"))

    up = suffixes.select("suffix", shrunk("suffix", F.lit(rate)).alias("suffix_mean"))
    up = domains.join(up, "suffix").select("domain", "suffix", shrunk("domain", F.col("suffix_mean")).alias("domain_mean"))
    mean, weight = shrunk("host", F.col("domain_mean")), F.lit(k["host"]) + F.col("n")
    low = mean - F.lit(z) * F.sqrt(mean * (1 - mean) / (weight + 1))
    return hosts.join(up, ["domain", "suffix"]).select("host", F.col("n").alias("n_labelled"), F.col("x").alias("n_bad"), low.alias("bad_low"))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: dict[str, str] | None = None, threshold: float = THRESHOLD, z: float = Z) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict, n_labelled, n_bad, bad_low."""
    rules = RULES if rules is None else rules
    reputation = host_reputation(pages, outcomes, z)
    url = F.col("url")
    named = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    named = named.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    by_rule = reduce(lambda c, r: F.when(F.col("rule") == r, F.lit(rules[r])).otherwise(c), rules, F.lit(None).cast("string"))
    by_host = F.when(F.col("bad_low") > threshold, F.lit("block")).otherwise(F.lit("allow"))
    return named.join(reputation, "host", "left").select("page_id", "host", "path", "rule", F.coalesce(by_rule, by_host).alias("verdict"), "n_labelled", "n_bad", "bad_low")


ORACLE = """
WITH o AS (SELECT doc_id AS page_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL GROUP BY 1),
p AS (SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
  coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
h0 AS (SELECT host, count(bad) AS n, coalesce(sum(bad), 0)::BIGINT AS x FROM p LEFT JOIN o USING (page_id) GROUP BY host),
h1 AS (SELECT *, string_split(host, '.') AS s FROM h0),
h2 AS (SELECT host, n, x, array_to_string(s[-2:], '.') AS two, array_to_string(s[-3:], '.') AS three, s[-1] AS one FROM h1),
h AS (SELECT host, n, x, CASE WHEN two IN (%s) THEN three ELSE two END AS domain, CASE WHEN two IN (%s) THEN two ELSE one END AS suffix FROM h2),
d AS (SELECT domain, suffix, sum(n) AS n, sum(x) AS x FROM h GROUP BY 1, 2),
s AS (SELECT suffix, sum(n) AS n, sum(x) AS x FROM d GROUP BY 1),
m AS (SELECT 'h' AS lv, sum(n) AS n, sum(x) AS x, count(*) FILTER (n > 0) AS g, sum(x * x / n) FILTER (n > 0) AS q FROM h
  UNION ALL SELECT 'd', sum(n), sum(x), count(*) FILTER (n > 0), sum(x * x / n) FILTER (n > 0) FROM d
  UNION ALL SELECT 's', sum(n), sum(x), count(*) FILTER (n > 0), sum(x * x / n) FILTER (n > 0) FROM s),
e AS (SELECT lv, n, x / n AS r, (x / n) * (1 - x / n) AS within, q / n - (x / n) * (x / n) AS between_, g FROM m),
k AS (SELECT lv, coalesce(r, 0) AS r, CASE WHEN coalesce(n, 0) = 0 THEN 1.0 WHEN between_ - within * g / n <= 0 THEN 10000.0
  ELSE least(10000.0, greatest(1.0, (within - between_) / (between_ - within * g / n))) END AS k FROM e),
sm AS (SELECT suffix, (k.k * k.r + s.x) / (k.k + s.n) AS mean FROM s, k WHERE k.lv = 's'),
dm AS (SELECT domain, suffix, (k.k * sm.mean + d.x) / (k.k + d.n) AS mean FROM d JOIN sm USING (suffix), k WHERE k.lv = 'd'),
hm AS (SELECT host, h.n, h.x, (k.k * dm.mean + h.x) / (k.k + h.n) AS mean, k.k + h.n AS w FROM h JOIN dm USING (domain, suffix), k WHERE k.lv = 'h'),
v AS (SELECT host, n, x, mean - 1.64 * sqrt(mean * (1 - mean) / (w + 1)) > 0.5 AS bad FROM hm),
r AS (SELECT *, CASE WHEN (host = 'example.net' OR suffix(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
  WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
  WHEN (host = 'org' OR suffix(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
  WHEN (host = 'net' OR suffix(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM p)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' WHEN bad THEN 'block' ELSE 'allow' END AS verdict,
  n AS n_labelled, x AS n_bad FROM r JOIN v USING (host)
""" % ((", ".join(f"'{s}'" for s in TWO_LABEL_SUFFIXES),) * 2)
