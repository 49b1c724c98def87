"""URL filter: fixed rules first, then the empirical-Bayes reputation of the host.

Labelled page outcomes are counted per host. A host's bad rate is shrunk
towards its registered domain, the domain's towards its suffix, the suffix's
towards the whole corpus. At each level the prior is a beta distribution whose
mean is the parent's shrunk rate and whose strength is the beta-binomial
moment estimate over all children of that level. A host is blocked when the
lower posterior bound of its bad rate exceeds ``max_bad``.

Defined results: NULL url or one without ``://`` has empty host and path, no
rule, and is judged by the corpus-wide rate; a host without labels is judged
by its domain's, suffix's or the corpus rate; without any label every host is
allowed. Repeated pages count as often as they occur and each gets its row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from titlecorpus.llm.common import hot_join, stored, table

#: Fixed values: (host, path, verdict).
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
#: Blocked when the posterior mean less Z standard deviations exceeds MAX_BAD.
MAX_BAD, Z = 0.5, 1.645
#: Range of the intra-class correlation that the moment estimate may take.
RHO_MIN, RHO_MAX = 0.001, 0.9
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, URL, 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def domain_of(host: Column) -> Column:
    """Last two labels; the host itself where it has fewer."""
    return F.substring_index(host, ".", -2)


def suffix_of(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """Index of the longest fitting rule, NULL without one."""
    hit = F.lit(None).cast("int")
    for i, (h, p, _) in sorted(enumerate(rules), key=lambda r: len(r[1][0] + r[1][1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        hit = F.when(fits, F.lit(i)).otherwise(hit)
    return hit


def strength(children: DataFrame) -> DataFrame:
    """One row, column ``m``: prior strength by moments over children (parent, n, k) that have labels."""
    p = F.col("k") / F.col("n")
    labelled = children.where("n > 0")
    parents = labelled.groupBy("parent").agg(
        F.count("*").cast("double").alias("i"), F.sum("n").cast("double").alias("nn"), F.sum("k").cast("double").alias("kk"),
        F.sum(F.col("n").cast("double") * F.col("n")).alias("sq"), F.sum(F.col("n") * p * p).alias("npp"))
    q = F.col("kk") / F.col("nn")
    spread = (F.col("npp") - F.col("nn") * q * q) - (F.col("i") - 1) * q * (1 - q)
    scale = q * (1 - q) * (F.col("nn") - F.col("sq") / F.col("nn") - (F.col("i") - 1))
    total = parents.agg(F.sum(spread).alias("a"), F.sum(scale).alias("b"))
    rho = F.greatest(F.lit(RHO_MIN), F.least(F.lit(RHO_MAX), F.when(F.col("b") > 0, F.col("a") / F.col("b")).otherwise(RHO_MAX)))
    return total.select(((1 - rho) / rho).alias("m"))


def host_reputation(hosts: DataFrame, max_bad: float = MAX_BAD, z: float = Z) -> DataFrame:
    """(host, pages, n, k): pages seen, labelled, and bad ones -> with rate, bound and verdict per host."""
    level = hosts.select("host", "pages", "n", "k", domain_of(F.col("host")).alias("domain"), suffix_of(F.col("host")).alias("suffix"))
    domains = level.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"), F.count("*").alias("held"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"), F.count("*").alias("held"))
    whole = suffixes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("k"), F.lit(0)).alias("k"))

    m_host = strength(level.withColumn("parent", F.col("domain")))
    m_domain = strength(domains.withColumn("parent", F.col("suffix")))
    m_suffix = strength(suffixes.withColumn("parent", F.lit("")))
    one = whole.select(F.when(F.col("n") > 0, F.col("k") / F.col("n")).otherwise(0.0).alias("mu"))

    shrunk = lambda m, mu: (F.col("k") + m * mu) / (F.col("n") + m)
    suffixes = suffixes.select("suffix", "held", shrunk(m_suffix.scalar(), one.scalar()).alias("suffix_rate"))
    domains = hot_join(domains, suffixes, "suffix", "held").select("domain", "held", shrunk(m_domain.scalar(), F.col("suffix_rate")).alias("domain_rate"))
    level = hot_join(level, domains, "domain", "held").withColumn("m", m_host.scalar())
    a, b = F.col("k") + F.col("m") * F.col("domain_rate"), F.col("n") - F.col("k") + F.col("m") * (1 - F.col("domain_rate"))
    level = level.withColumn("a", a).withColumn("b", b).withColumn("ab", F.col("a") + F.col("b"))
    rate = F.col("a") / F.col("ab")
    bound = rate - z * F.sqrt(F.col("a") * F.col("b") / (F.col("ab") * F.col("ab") * (F.col("ab") + 1)))
    return level.select("host", "pages", rate.alias("bad_rate"), bound.alias("bad_bound"),
                        F.when(bound > max_bad, "block").otherwise("allow").alias("host_verdict"))


def filter_urls(pages: DataFrame, outcomes: DataFrame, rules=RULES, max_bad: float = MAX_BAD) -> DataFrame:
    """Judge every url of ``pages`` (page_id, url). ``outcomes``: (host, n, k) rows of labelled and bad pages, summed here."""
    seen = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    counted = (seen.groupBy("host").agg(F.count("*").alias("pages"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("k"))
               .unionByName(outcomes.select("host", F.lit(0).cast("long").alias("pages"), F.col("n").cast("long"), F.col("k").cast("long")))
               .groupBy("host").agg(F.sum("pages").alias("pages"), F.sum("n").alias("n"), F.sum("k").alias("k")))
    hosts = stored(host_reputation(stored(counted, "host_counts"), max_bad), "host_verdicts")
    judged = hot_join(seen.withColumn("i", rule_of(F.col("host"), F.col("path"), rules)), hosts, "host", "pages")
    texts, verdicts = F.array(*(F.lit(h + p) for h, p, _ in rules)), F.array(*(F.lit(v) for *_, v in rules))
    return judged.select(
        "page_id", "host", "path", F.get(texts, F.col("i")).alias("rule"),
        F.coalesce(F.get(verdicts, F.col("i")), F.col("host_verdict")).alias("verdict"), "bad_rate", "bad_bound")


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, n, k) from labelled documents: a page's document is the number at the end of its path; bad is toxic or of quality 0."""
    number = F.regexp_extract(path_of(F.col("url")), r"/([0-9]{1,18})(?:\.html)?/?$", 1)
    shown = (pages.select(host_of(F.col("url")).alias("host"), F.when(number != "", number.cast("long")).alias("doc_id"))
             .where("doc_id is not null").groupBy("host", "doc_id").agg(F.count("*").alias("shown")))
    judged = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.when((F.col("toxic") == 1) | (F.col("quality") == 0), 1).otherwise(0)).alias("bad"))
    return shown.join(judged, "doc_id").groupBy("host").agg(F.sum("shown").alias("n"), F.sum(F.col("shown") * F.col("bad")).alias("k"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    found = filter_urls(pages, page_outcomes(pages, table(spark, sf_dir, "labels")))
    return found.select("page_id", "host", "path", "rule", "verdict")


def _strength_sql(name: str, source: str, parent: str) -> str:
    return f"""
{name}_parents AS (
  SELECT {parent} AS parent, count(*)::DOUBLE AS i, sum(n)::DOUBLE AS nn, sum(k)::DOUBLE AS kk,
         sum(n::DOUBLE * n) AS sq, sum(n * (k::DOUBLE / n) * (k::DOUBLE / n)) AS npp
  FROM {source} WHERE n > 0 GROUP BY 1),
{name}_sums AS (
  SELECT sum((npp - nn * (kk / nn) * (kk / nn)) - (i - 1) * (kk / nn) * (1 - kk / nn)) AS a,
         sum((kk / nn) * (1 - kk / nn) * (nn - sq / nn - (i - 1))) AS b FROM {name}_parents),
{name} AS (
  SELECT (1 - rho) / rho AS m FROM (
    SELECT greatest({RHO_MIN}, least({RHO_MAX}, CASE WHEN b > 0 THEN a / b ELSE {RHO_MAX} END)) AS rho FROM {name}_sums))"""


ORACLE_SQL = rf"""
WITH seen AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '{URL}', 1), '{UPPER}', '{LOWER}'), '') AS host,
         coalesce(regexp_extract(url, '{URL}', 2), '') AS path FROM pages),
numbered AS (
  SELECT host, regexp_extract(path, '/([0-9]{{1,18}})(?:\.html)?/?$', 1) AS number FROM seen),
judged AS (
  SELECT doc_id, max(CASE WHEN toxic = 1 OR quality = 0 THEN 1 ELSE 0 END) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY 1),
outcomes AS (
  SELECT host, count(*) AS n, sum(bad) AS k FROM numbered JOIN judged ON number <> '' AND doc_id = try_cast(number AS BIGINT) GROUP BY 1),
hosts AS (
  SELECT host, coalesce(any_value(o.n), 0) AS n, coalesce(any_value(o.k), 0) AS k,
         array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') AS domain, string_split(host, '.')[-1] AS suffix
  FROM seen LEFT JOIN outcomes o USING (host) GROUP BY host),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM hosts GROUP BY 1, 2),
suffixes AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM domains GROUP BY 1),
{_strength_sql("m_host", "hosts", "domain")},
{_strength_sql("m_domain", "domains", "suffix")},
{_strength_sql("m_suffix", "suffixes", "''")},
one AS (SELECT coalesce(CASE WHEN sum(n) > 0 THEN sum(k)::DOUBLE / sum(n) END, 0) AS mu FROM suffixes),
s AS (SELECT suffix, (k + (SELECT m FROM m_suffix) * (SELECT mu FROM one)) / (n + (SELECT m FROM m_suffix)) AS rate FROM suffixes),
d AS (SELECT domain, (k + (SELECT m FROM m_domain) * s.rate) / (n + (SELECT m FROM m_domain)) AS rate FROM domains JOIN s USING (suffix)),
h AS (
  SELECT host, k + (SELECT m FROM m_host) * d.rate AS a, n - k + (SELECT m FROM m_host) * (1 - d.rate) AS b FROM hosts JOIN d USING (domain)),
r AS (
  SELECT page_id, host, path, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule FROM seen)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN a / (a + b) - {Z} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) > {MAX_BAD} THEN 'block' ELSE 'allow' END AS verdict
FROM r JOIN h USING (host)
"""
