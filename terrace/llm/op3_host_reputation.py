"""URL filter by empirical-Bayes host reputation.

Labelled pages (bad: low quality or toxic) are counted by host, registered domain and suffix. At each level the rate
of bad pages is shrunk to its parent's by a beta prior whose strength is fitted to that level by the method of
moments: hosts to their domain, domains to their suffix, suffixes to all pages. A host is blocked if the lower
posterior bound of its rate reaches the threshold; a host without labels has its domain's rate, and the bound that
goes with it. Listed rules come first, the longest that fits.

Native: DataFrame operations only. Pages are counted by host before anything else, so a host with a third of the
pages is one row; verdicts are made for distinct hosts and joined back.

Nulls: a null url, or one without ://, has an empty host and path; such pages share the host ''. Null labels count as
good, labels without an id are dropped, and of several labels of one id any bad one makes it bad. Repeated pages count
each time. Very long urls are taken whole. Other columns are ignored; empty tables give an empty result, or verdicts from the prior alone.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c

RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
#: Suffixes of several parts under which domains are registered; all others have one part.
SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.in", "co.za")
#: Standard deviations below the mean, and the rate of bad pages that blocks: a host goes when most of its pages are bad
#: beyond doubt. Where labels say nothing of hosts, all rates shrink to the whole's and no host goes.
Z, BLOCK_AT = 1.645, 0.5


def parsed(pages: DataFrame) -> DataFrame:
    """page_id, host, path."""
    url = F.coalesce("url", F.lit(""))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), c.ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)).alias("host"), F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1).alias("path"))


def listed(rules: dict[str, str]):
    """The longest rule that fits host and path, else null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):  # the last tried is outermost
        host, path = rule.split("/", 1)
        out = F.when(((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(f"/{path}"), F.lit(rule)).otherwise(out)
    return out


#: The suffix of numeric addresses.
ADDRESS = "(address)"


def domains(hosts: DataFrame, suffixes=SUFFIXES) -> DataFrame:
    """Adds suffix and registered domain; a host that is itself a suffix is its own domain. A port is no part of either. A
    numeric address is its own domain, and all of them have one suffix."""
    name = F.regexp_replace("host", r":[0-9]*$", "")
    address = name.rlike(r"^[0-9.]+$|^\[")
    parts = F.split(name, r"\.")
    size = F.when(F.substring_index(name, ".", -2).isin(*suffixes), 2).otherwise(1)
    suffix = F.when(address, ADDRESS).when(size == 2, F.substring_index(name, ".", -2)).otherwise(F.substring_index(name, ".", -1))
    domain = F.when(address | (F.size(parts) <= size), name).when(size == 2, F.substring_index(name, ".", -3)).otherwise(F.substring_index(name, ".", -2))
    return hosts.withColumns({"suffix": suffix, "domain": domain})


def fitted(groups: DataFrame) -> DataFrame:
    """Adds strength, k of Beta(k m, k (1 - m)), to groups of n pages, x bad, prior mean m: by moments over all groups."""
    spread, noise = (F.col("x") - F.col("n") * F.col("m")) ** 2, F.col("n") * F.col("m") * (1 - F.col("m"))
    rho = (F.sum(spread) - F.sum(noise)) / F.nullif(F.sum((F.col("n") - 1) * noise), F.lit(0.0))
    k = (
        groups.agg(F.least(F.lit(0.9), F.greatest(F.lit(1e-4), F.round(F.coalesce(rho, F.lit(1e-4)), 9))).alias("rho"))
        .select(F.round((1 - F.col("rho")) / F.col("rho"), 6).alias("k"))
    )
    return groups.crossJoin(F.broadcast(k))  # k is one row


def reputation(spark: SparkSession, hosts: DataFrame, scratch: c.Scratch, suffixes=SUFFIXES) -> DataFrame:
    """(host, n, x) with rate and bound: posterior mean and lower bound of the share of bad pages."""
    base = scratch.put(domains(hosts, suffixes), "hosts")
    total = base.agg(((F.coalesce(F.sum("x"), F.lit(0)) + 1) / (F.coalesce(F.sum("n"), F.lit(0)) + 2)).alias("m"))  # one row
    sums = lambda df, *by: df.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
    mean = F.round((F.col("x") + F.col("k") * F.col("m")) / (F.col("n") + F.col("k")), 12)
    by_domain = scratch.put(sums(base, "suffix", "domain"), "domains")
    suffix = scratch.put(fitted(sums(by_domain, "suffix").crossJoin(F.broadcast(total))).select("suffix", mean.alias("m")), "suffixes")
    domain = scratch.put(fitted(scratch.put(c.met(by_domain, suffix, "suffix"), "domain-priors")).select("domain", mean.alias("m")), "means")
    host = fitted(scratch.put(c.met(base, domain, "domain"), "priors"))
    a, b = F.col("x") + F.col("k") * F.col("m"), F.col("n") - F.col("x") + F.col("k") * (1 - F.col("m"))
    rate, deviation = a / (a + b), F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return host.select(
        "host", F.col("n").alias("n_labelled"), F.col("x").alias("n_bad"), F.round(rate, 9).alias("rate"),
        F.round(rate - Z * deviation, 9).alias("bound"),
    )


def judge(spark: SparkSession, pages: DataFrame, labels: DataFrame, rules: dict[str, str] = RULES, block_at: float = BLOCK_AT, suffixes=SUFFIXES) -> DataFrame:
    """page_id, host, path, rule, verdict and the host's n_labelled, n_bad, rate, bound. `labels` has page_id and bad, 0 or 1."""
    scratch = c.Scratch(spark, "hosts")
    urls = scratch.put(parsed(pages), "urls")
    # an id's label is one row, so a page is counted once however often it is labelled
    known = labels.filter("page_id is not null").groupBy("page_id").agg(F.max("bad").alias("bad"))
    hosts = urls.join(known, "page_id", "left").groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("long").alias("x"))
    scores = scratch.put(
        reputation(spark, hosts, scratch, suffixes).withColumn("method", F.when(F.col("bound") >= block_at, "block").otherwise("allow")),
        "reputation",
    )
    verdict = F.element_at(F.create_map(*[F.lit(x) for r in rules.items() for x in r]), F.col("rule")) if rules else F.lit(None)
    return (
        c.met(urls, scores, "host")
        .withColumn("rule", listed(rules))
        .withColumn("verdict", F.coalesce(F.when(F.col("rule").isNotNull(), verdict), "method"))
        .select("page_id", "host", "path", "rule", "verdict", "n_labelled", "n_bad", "rate", "bound")
    )


def outcomes(labels: DataFrame) -> DataFrame:
    return labels.select(
        F.col("doc_id").cast("long").alias("page_id"),
        ((F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)).cast("int").alias("bad"),
    )


def op3_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark, c.table(spark, sf_dir, "pages"), outcomes(c.table(spark, sf_dir, "labels")))


def planted(pages: DataFrame) -> DataFrame:
    """Labels of every other page that do tell of hosts: those with a name of a certain length are bad, and all of one domain."""
    u = parsed(pages).filter("page_id % 2 = 0")
    return u.select("page_id", ((F.length("host") % 5 == 0) | F.col("host").endswith(".example.com")).cast("int").alias("bad"))


def op3b_planted_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same estimate where it has something to say: hosts are blocked by their own pages, and by their domain's."""
    pages = c.table(spark, sf_dir, "pages")
    return judge(spark, pages, planted(pages))


def _level(name: str, source: str, key: str) -> str:
    """SQL of one level: its fitted strength and posterior means."""
    return f"""{name}_k AS (SELECT round((1 - rho) / rho, 6) AS k FROM (SELECT least(0.9, greatest(1e-4, round(coalesce((sum((x - n * m) ** 2) - sum(n * m * (1 - m))) / nullif(sum((n - 1) * (n * m * (1 - m))), 0.0), 1e-4), 9))) AS rho FROM {source})),
{name} AS (SELECT {key}, round((x + k * m) / (n + k), 12) AS m FROM {source}, {name}_k)"""


SQL = rf"""
WITH u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{c.UPPER}', '{c.UPPER.lower()}') AS host, regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
l AS (SELECT doc_id AS page_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
h AS (SELECT host, CAST(count(bad) AS BIGINT) AS n, CAST(coalesce(sum(bad), 0) AS BIGINT) AS x, string_split(host, '.') AS p FROM u LEFT JOIN l USING (page_id) GROUP BY host),
hs AS (SELECT host, n, x, CASE WHEN array_to_string(p[-2:], '.') IN {SUFFIXES!r} THEN 2 ELSE 1 END AS s, p FROM h),
hd AS (SELECT host, n, x, array_to_string(p[-s:], '.') AS suffix, CASE WHEN len(p) <= s THEN host ELSE array_to_string(p[-s - 1:], '.') END AS domain FROM hs),
t AS (SELECT CAST(coalesce(sum(x), 0) + 1 AS DOUBLE) / (coalesce(sum(n), 0) + 2) AS m FROM hd),
s0 AS (SELECT suffix, sum(n)::DOUBLE AS n, sum(x)::DOUBLE AS x, any_value(m) AS m FROM hd, t GROUP BY suffix),
{_level("s1", "s0", "suffix")},
d0 AS (SELECT domain, suffix, sum(n)::DOUBLE AS n, sum(x)::DOUBLE AS x, any_value(m) AS m FROM hd JOIN s1 USING (suffix) GROUP BY domain, suffix),
{_level("d1", "d0", "domain")},
h0 AS (SELECT host, hd.n, hd.x, m FROM hd JOIN d1 USING (domain)),
{_level("h1", "h0", "host")},
ab AS (SELECT host, n, x, x + k * m AS a, n - x + k * (1 - m) AS b FROM h0, h1_k),
r AS (SELECT host, n AS n_labelled, x AS n_bad, round(a / (a + b), 9) AS rate, round(a / (a + b) - {Z} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))), 9) AS bound FROM ab),
o AS (SELECT page_id, host, path, CASE
  WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
  WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
  WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
  WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule, n_labelled, n_bad, rate, bound FROM u JOIN r USING (host))
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' WHEN bound >= {BLOCK_AT} THEN 'block' ELSE 'allow' END AS verdict, n_labelled, n_bad, rate, bound FROM o
"""

PLANTED_SQL = re.sub(
    r"\nl AS \(SELECT doc_id.*\n", "\nl AS (SELECT page_id, CASE WHEN length(host) % 5 = 0 OR ends_with(host, '.example.com') THEN 1 ELSE 0 END AS bad FROM u WHERE page_id % 2 = 0),\n", SQL
)
