"""URL verdicts by rules and by empirical-Bayes host reputation, in DataFrame operations.

Hosts that no rule settles are judged by the labelled outcomes of their pages. The bad
outcomes of a host are a binomial count whose rate has a beta prior; the prior's mean is
the posterior rate of the registered domain, whose own prior comes from the suffix, and the
suffix's from all pages. How strongly a parent informs its children is estimated from how
much more the children's rates differ than their counts explain (method of moments). A host
is blocked where the lower posterior bound of its bad rate is above a limit, so a few bad
pages alone block no host.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import table
from cohortloom.sources.storage import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The rules of the registered query, as (verdict, host, path).
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
#: Suffixes of several labels under which names are registered; a parameter.
SUFFIXES = (
    "ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "ne.jp",
    "co.kr", "com.br", "com.cn", "com.mx", "com.tr", "co.in", "co.za", "github.io",
    "blogspot.com", "wordpress.com",
)
LEVELS = ("suffix", "domain", "host")
LEAST_SPREAD, MOST_SPREAD = 1e-4, 0.9


@dataclass(frozen=True)
class Limits:
    """`bound` standard deviations below the posterior mean must be above `bad_rate`."""

    bad_rate: float = 0.5
    bound: float = 1.645


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host and path of an address; both empty without `://`."""
    text = F.coalesce(F.col(url), F.lit(""))
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(text, pattern, 1), UPPER, LOWER)
    return host, F.regexp_extract(text, pattern, 2)


def longest_rule(rules: tuple[tuple[str, str, str], ...], host: Column, path: Column) -> Column:
    """Struct (verdict, rule) of the longest rule that fits, else null.

    A rule fits its host and all subdomains where the path starts with the rule's. Rules are
    a short list; of two of one length the earlier wins.
    """
    found = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, name, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        value = F.struct(F.lit(verdict).alias("verdict"), F.lit(name + start).alias("rule"))
        found = F.when(fits, value).otherwise(found)
    return found


def parents(host: Column, suffixes: tuple[str, ...] = SUFFIXES) -> tuple[Column, Column]:
    """Registered domain and suffix of a host name.

    The suffix is the longest of `suffixes`, a short list, that the name ends with, else its
    last label; the domain has one label more. An address in numbers has no owner's name: it is
    its own domain, without a suffix.
    """
    name = F.regexp_replace(host, r":[0-9]*$", "")
    numbers = name.rlike(r"^[0-9]+(\.[0-9]+){3}$") | name.startswith("[")
    suffix = F.element_at(F.split(name, r"\."), -1)
    for known in sorted(suffixes, key=len):
        fits = (name == known) | name.endswith("." + known)
        suffix = F.when(fits, F.lit(known)).otherwise(suffix)
    before = F.substring(name, F.lit(1), F.length(name) - F.length(suffix) - 1)
    owner = F.element_at(F.split(before, r"\."), -1)
    domain = F.when(F.length(name) == F.length(suffix), suffix).otherwise(
        F.concat(owner, F.lit("."), suffix)
    )
    return F.when(numbers, name).otherwise(domain), F.when(numbers, F.lit("")).otherwise(suffix)


def _spread(children: DataFrame, parent: str) -> float:
    """Strength of a prior: one over the correlation within children, less one.

    `children` has n, bad and the parent's n and bad; what the driver gets is one row.
    """
    rate = F.col("parent_bad") / F.col("parent_n")
    own = F.col("bad") / F.col("n")
    noise = rate * (1 - rate)
    families = (
        children.where("n > 0")
        .withColumn("noise", noise)
        .groupBy(parent)
        .agg(
            F.count("*").alias("k"),
            F.sum("n").alias("total"),
            F.sum(F.col("n") * F.col("n") / F.col("parent_n")).alias("lost"),
            F.sum(F.col("n") * (own - rate) * (own - rate)).alias("seen"),
            F.max("noise").alias("noise"),
        )
    )
    sums = families.agg(
        F.round(F.sum(F.col("seen") - F.col("noise") * (F.col("k") - 1)), 9).alias("extra"),
        F.round(
            F.sum(F.col("noise") * (F.col("total") - F.col("lost") - F.col("k") + 1)), 9
        ).alias("scale"),
    ).first()
    if not sums["scale"] or sums["scale"] <= 0:
        return 1 / LEAST_SPREAD - 1
    share = min(max(sums["extra"] / sums["scale"], LEAST_SPREAD), MOST_SPREAD)
    return 1 / share - 1


def host_reputation(outcomes: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One row for each host of `outcomes` (host, n, bad): posterior of its bad rate.

    Hosts without labelled pages (n = 0) get what their domain and suffix say. Columns: host,
    n, bad, strength, mean, low, verdict.
    """
    domain, suffix = parents(F.col("host"))
    hosts = materialize(
        outcomes.groupBy("host")
        .agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        .withColumns({"domain": domain, "suffix": suffix}),
        "host-outcomes",
    )
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    whole = suffixes.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    n, bad = whole["n"] or 0, whole["bad"] or 0
    # one page of each outcome more, so that a rate is never zero or one
    base = (bad + 1.0) / (n + 2.0)

    def of_parent(children: DataFrame, elders: DataFrame, key: str) -> DataFrame:
        above = elders.groupBy(key).agg(
            F.max("n").alias("parent_n"), F.max("bad").alias("parent_bad")
        )
        return children.join(above, key)

    overall = suffixes.withColumns(
        {"parent_n": F.lit(n), "parent_bad": F.lit(bad), "whole": F.lit("all")}
    )
    strengths = {
        "suffix": _spread(overall, "whole") if n else 1.0,
        "domain": _spread(of_parent(domains, suffixes, "suffix"), "suffix") if n else 1.0,
        "host": _spread(of_parent(hosts, domains, "domain"), "domain") if n else 1.0,
    }

    def posterior(prior: Column | float, level: str) -> Column:
        s = F.lit(strengths[level])
        return (F.col("bad") + s * prior) / (F.col("n") + s)

    by_suffix = suffixes.select("suffix", posterior(F.lit(base), "suffix").alias("suffix_rate"))
    by_domain = domains.join(by_suffix, "suffix").select(
        "domain", posterior(F.col("suffix_rate"), "domain").alias("domain_rate")
    )
    mean = posterior(F.col("domain_rate"), "host")
    strength = F.col("n") + F.lit(strengths["host"])
    judged = hosts.join(by_domain, "domain").select(
        "host", "n", "bad", strength.alias("strength"), mean.alias("mean")
    )
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("strength") + 1))
    low = F.col("mean") - limits.bound * deviation
    return judged.withColumn("low", low).withColumn(
        "verdict", F.when(F.col("low") > limits.bad_rate, "block").otherwise("allow")
    )


def url_verdicts(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: tuple[tuple[str, str, str], ...] = RULES,
    limits: Limits = Limits(),
    id_col: str = "page_id",
    url_col: str = "url",
    details: bool = False,
) -> DataFrame:
    """One row for each row of `pages`: page_id, host, path, rule, verdict.

    With `details` also what is known of the host: n labelled pages, bad ones among them, mean
    and low, the posterior of its bad rate and its bound, to six digits.

    `outcomes` (page_id, bad) are labelled pages; a page counts once and is bad if any of its
    labels is. A null or malformed address has empty host and path, no rule, and the verdict
    of the host without a name; a host without labels is judged by its parents, and with no
    labels at all everything that no rule blocks is allowed. Rows that repeat are judged one
    by one; an empty table gives no rows; other columns are not read.
    """
    host, path = host_and_path("_url")
    rows = (
        pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("_url"))
        .select("page_id", host.alias("host"), path.alias("path"))
        .withColumn("found", longest_rule(rules, F.col("host"), F.col("path")))
    )
    labels = (
        outcomes.where("page_id IS NOT NULL AND bad IS NOT NULL")
        .groupBy(F.col("page_id").alias("labelled"))
        .agg(F.max("bad").cast("long").alias("bad"))
    )
    # sums by host are formed map-side, so a host with very many pages is no hot group
    counted = (
        rows.join(labels, rows["page_id"] == labels["labelled"], "left")
        .groupBy("host")
        .agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    )
    judged = host_reputation(counted, limits).withColumnRenamed("verdict", "reputation")
    columns = [
        "page_id",
        "host",
        "path",
        F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", "reputation", F.lit("allow")).alias("verdict"),
    ]
    if details:
        # one row for each host against its pages; Spark splits those of a very common host
        known = [F.round(c, 6).alias(c) for c in ("mean", "low")]
        return rows.join(judged, "host", "left").select(*columns, "n", "bad", *known)
    # only blocked hosts are looked up: few rows, and no join for the hosts that stay
    blocked = judged.where("reputation = 'block'").select("host", "reputation")
    return rows.join(blocked, "host", "left").select(*columns)


def op3_url_filter(spark, sf_dir):
    """Labels of the document with the page's number are the page's outcome."""
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"),
        ((F.col("toxic") == 1) | (F.col("quality") == 0)).cast("int").alias("bad"),
    )
    return url_verdicts(table(spark, sf_dir, "pages"), labels, details=True)


SQL = """
WITH parts AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages),
ruled AS (
  SELECT *, CASE
      WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
      WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
      WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
      WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM parts),
outcome AS (
  SELECT doc_id, max(CASE WHEN toxic = 1 OR quality = 0 THEN 1 WHEN toxic IS NULL OR quality IS NULL THEN NULL ELSE 0 END) AS bad
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
hosts AS (
  SELECT host, count(bad) AS n, coalesce(sum(bad), 0)::DOUBLE AS bad,
         array_to_string(list_slice(string_split(regexp_replace(host, ':[0-9]*$', ''), '.'), -2, -1), '.') AS domain,
         list_extract(string_split(regexp_replace(host, ':[0-9]*$', ''), '.'), -1) AS suffix
  FROM ruled LEFT JOIN outcome ON page_id = doc_id GROUP BY host),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY domain, suffix),
suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY suffix),
overall AS (SELECT sum(n) AS n, sum(bad) AS bad FROM suffixes),
families AS (
  SELECT 'suffix' AS level, 'all' AS parent, s.n, s.bad, o.n AS pn, o.bad AS pb FROM suffixes s, overall o
  UNION ALL SELECT 'domain', d.suffix, d.n, d.bad, s.n, s.bad FROM domains d JOIN suffixes s USING (suffix)
  UNION ALL SELECT 'host', h.domain, h.n, h.bad, d.n, d.bad FROM hosts h JOIN domains d USING (domain)),
sums AS (
  SELECT level, parent, count(*) AS k, sum(n) AS total, sum(n * n / pn) AS lost,
         sum(n * (bad / n - pb / pn) ** 2) AS seen, max(pb / pn * (1 - pb / pn)) AS noise
  FROM families WHERE n > 0 GROUP BY level, parent),
strength AS (
  SELECT level, CASE WHEN scale > 0 THEN 1 / least(greatest(extra / scale, 1e-4), 0.9) - 1 ELSE 9999 END AS s
  FROM (SELECT level, round(sum(seen - noise * (k - 1)), 9) AS extra,
               round(sum(noise * (total - lost - k + 1)), 9) AS scale FROM sums GROUP BY level)),
s AS (SELECT max(s) FILTER (level = 'suffix') AS a, max(s) FILTER (level = 'domain') AS b,
             max(s) FILTER (level = 'host') AS c FROM strength),
judged AS (
  SELECT host, h.n AS n, h.bad AS bad, (h.bad + c * dr) / (h.n + c) AS mean, h.n + c AS strength
  FROM hosts h JOIN (
    SELECT domain, b, c, (d.bad + b * sr) / (d.n + b) AS dr
    FROM domains d JOIN (
      SELECT suffix, b, c, (x.bad + a * (o.bad + 1) / (o.n + 2)) / (x.n + a) AS sr
      FROM suffixes x, overall o, s) y USING (suffix)) z USING (domain))
SELECT page_id, ruled.host, path, rule,
       CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow'
            WHEN rule IS NOT NULL THEN 'block'
            WHEN mean - 1.645 * sqrt(mean * (1 - mean) / (strength + 1)) > 0.5 THEN 'block'
            ELSE 'allow' END AS verdict,
       n, bad::BIGINT AS bad, round(mean, 6) AS mean,
       round(mean - 1.645 * sqrt(mean * (1 - mean) / (strength + 1)), 6) AS low
FROM ruled JOIN judged ON ruled.host = judged.host
"""
