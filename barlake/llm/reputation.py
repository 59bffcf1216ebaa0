"""Empirical-Bayes host reputation for URL filters.

Labelled page outcomes are counted by host, registered domain and public suffix. Each level's
share of bad pages is a beta-binomial posterior whose prior mean is that of the level above;
the prior's weight comes from how far the children of all parents spread (moments). A host is
blocked if the lower bound of its posterior share is high, that is, if the beta posterior
leaves little chance that the share is below the limit: few labels shrink to the domain, none
at all give the domain's share and a wide bound. Rules come before the method.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import staged

# Fixed values. A second label of these below a country (two letters) belongs to the public
# suffix, as in co.uk or gov.au; so do the platforms that give a host name to every customer.
SECOND_LABELS = ("ac", "asn", "co", "com", "ed", "edu", "go", "gob", "gouv", "gov", "gv", "id", "ltd", "me", "mil", "ne", "net", "nom", "or", "org", "plc", "sch")
PLATFORMS = ("appspot.com", "blogspot.com", "github.io", "gitlab.io", "herokuapp.com", "netlify.app", "pages.dev", "tumblr.com", "vercel.app", "web.app", "wordpress.com", "workers.dev")

# A host is blocked if its share of bad pages exceeds LIMIT with a chance of CONFIDENCE.
LIMIT = 0.5
CONFIDENCE = 0.95
# What is no part of a host's name, and names that are addresses.
BESIDE_SITE = r"^[^@]*@|\.?(:[0-9]*)?\z"
ADDRESS = r"^([0-9]{1,3}(\.[0-9]{1,3}){3}\z|\[)"
# Bounds of the spread between children, as a correlation.
LEAST_SPREAD, MOST_SPREAD = 1e-4, 0.99

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for null and for a url without ://."""
    rest = F.when(F.contains(url, F.lit("://")), F.expr("substring(url, instr(url, '://') + 3)"))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def site_of(host: Column) -> Column:
    """The host that outcomes count for: without user, port and a last dot."""
    return F.regexp_replace(host, BESIDE_SITE, "")


def split_host(site: Column) -> tuple[Column, Column]:
    """The registered domain and the public suffix. A host without a dot is both; an address
    is a domain of its own, all of them under the empty suffix."""
    labels = F.split(site, r"\.", -1)
    last_two = F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), F.lit(2)), ".")
    national = F.regexp_like(last_two, F.lit(rf"^({'|'.join(SECOND_LABELS)})\.[a-z][a-z]\z"))
    size = F.when(national | last_two.isin(*PLATFORMS), 2).otherwise(1)

    def tail(count: Column) -> Column:
        return F.array_join(F.slice(labels, F.greatest(F.size(labels) - count + 1, F.lit(1)), count), ".")

    address = F.regexp_like(site, F.lit(ADDRESS))
    return F.when(address, site).otherwise(tail(size + 1)), F.when(address, "").otherwise(tail(size))


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """The name and verdict of the longest rule that fits the host or a parent of it and the
    path; null without one. Of equally long ones the first in the list counts."""
    name = verdict = F.lit(None).cast("string")
    for rule in reversed(sorted(rules, key=lambda r: -len(r.name))):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        name = F.when(fits, F.lit(rule.name)).otherwise(name)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def reputations(hosts: DataFrame, limit: float = LIMIT) -> DataFrame:
    """(host, n, bad, mean, log_below) from (host, n, bad): labelled pages and bad ones among them
    of every host (without user and port) once, 0 and 0 for a host without labels. ``log_below``
    is the logarithm of the chance that the host's share is no more than the limit, null unless the mean is
    above it.

    Hosts without any label anywhere have the share one half with a bound as wide as can be.
    """
    domain, suffix = split_host(F.col("host"))
    hosts = hosts.select("host", domain.alias("domain"), suffix.alias("suffix"), "n", "bad")
    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    domains = hosts.groupBy("domain", "suffix").agg(*sums)
    domains = staged(domains, "domains")
    suffixes = staged(domains.groupBy("suffix").agg(*sums), "suffixes")
    root = suffixes.agg(*sums).first()
    prior = ((root["bad"] or 0) + 0.5) / ((root["n"] or 0) + 1)
    suffixes = _posterior(suffixes.withColumn("prior", F.lit(prior)))
    domains = staged(domains.join(suffixes.select("suffix", F.col("mean").alias("prior")), "suffix"), "domain-priors")
    domains = _posterior(domains)
    hosts = hosts.join(domains.select("domain", F.col("mean").alias("prior")), "domain")
    hosts = staged(hosts, "host-priors")
    # Written, so that the mean decides by a column whose chance is worth its sum.
    known = staged(_posterior(hosts), "host-posteriors")
    log_below = log_chance_below(F.col("a"), F.col("b"), limit)
    return known.select("host", "n", "bad", "mean", F.when(F.col("mean") > limit, log_below).alias("log_below"))


def _posterior(rows: DataFrame) -> DataFrame:
    """Rows with n, bad and the parent's mean as ``prior``; adds the posterior's a and b and
    its mean."""
    n, bad, prior = F.col("n"), F.col("bad"), F.col("prior")
    spread = prior * (1 - prior)
    excess = F.sum((bad - n * prior) * (bad - n * prior) - n * spread)
    pairs = F.sum(n * (n - 1) * spread)
    rho = F.least(F.greatest(F.coalesce(excess / F.nullif(pairs, F.lit(0.0)), F.lit(MOST_SPREAD)), F.lit(LEAST_SPREAD)), F.lit(MOST_SPREAD))
    # One number, whatever the input.
    found = rows.agg(rho.alias("rho")).first()["rho"]
    weight = (1 - found) / found
    a, b = bad + prior * weight, n - bad + (1 - prior) * weight
    return rows.withColumns({"a": a, "b": b, "mean": a / (n + weight)})


def _log_gamma(x: Column) -> Column:
    """Of positive numbers: Stirling's series eight steps on, and the steps back."""
    steps = F.ln(x)
    for step in range(1, 8):
        steps = steps + F.ln(x + step)
    y = x + 8
    series = (1 / 12 - (1 / 360 - (1 / 1260 - 1 / 1680 / (y * y)) / (y * y)) / (y * y)) / y
    return (y - 0.5) * F.ln(y) - y + math.log(2 * math.pi) / 2 + series - steps


def log_chance_below(a: Column, b: Column, limit: float) -> Column:
    """The logarithm of the chance that a share with beta posterior (a, b) and a mean above the
    limit is no more than the limit: the incomplete beta integral by its series of positive terms, which
    fall from the first on; their number grows with the root of a + b."""
    count = F.ceil(64 + 8 * F.sqrt(a + b)).cast("int")
    first = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))

    def more(found: Column, k: Column) -> Column:
        term = found["term"] * limit * (a + b + k) / (a + 1 + k)
        return F.struct(term.alias("term"), (found["total"] + term).alias("total"))

    total = F.aggregate(F.sequence(F.lit(0), count), first, more)["total"]
    log_beta = _log_gamma(a) + _log_gamma(b) - _log_gamma(a + b)
    return a * math.log(limit) + b * math.log(1 - limit) - F.ln(a) - log_beta + F.ln(total)


def judge(pages: DataFrame, outcomes: DataFrame, rules: tuple[Rule, ...] = RULES, limit: float = LIMIT) -> DataFrame:
    """(page_id, url, host, path, rule, verdict, log_below) for every row of ``pages`` (page_id,
    url); ``outcomes`` has url and bad (0 or 1; others do not count) of labelled pages.

    Null and malformed urls have an empty host, judged like any host. Repeated rows are
    judged alike; a repeated outcome counts again. Other columns do not matter.
    """
    seen = _placed(pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url")))
    known = _placed(outcomes.filter(F.col("bad").isin(0, 1)).select(F.col("url").cast("string").alias("url"), F.col("bad").cast("long").alias("bad")))
    # One row for each host and task before anything is shuffled.
    counted = known.select(site_of(F.col("host")).alias("host"), F.lit(1).cast("long").alias("n"), "bad").unionByName(
        seen.select(site_of(F.col("host")).alias("host"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("bad"))
    )
    hosts = staged(counted.groupBy("host").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")), "hosts")
    standing = staged(reputations(hosts, limit).select(F.col("host").alias("site"), "log_below"), "reputations")
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = seen.withColumn("site", site_of(F.col("host"))).join(standing, "site", "left")
    method = F.when(F.col("log_below") <= math.log(1 - CONFIDENCE), F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(
        "page_id", "url", "host", "path", name.alias("rule"), F.coalesce(verdict, method).alias("verdict"), "log_below"
    )


def _placed(rows: DataFrame) -> DataFrame:
    host, path = host_and_path(F.col("url"))
    return rows.withColumns({"host": host, "path": path})


def document_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(url, bad): a page shows the document its path ends in (/language/number); its outcome
    is bad if that document is labelled toxic or of low quality."""
    number = F.regexp_extract("url", r"://[^/?#]*/[a-z]+/([0-9]{1,18})", 1)
    shown = pages.select("url", F.nullif(number, F.lit("")).cast("long").alias("doc_id"))
    known = labels.filter(F.col("quality").isNotNull() | F.col("toxic").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        ((F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)).cast("int").alias("bad"),
    )
    return shown.join(known, "doc_id").select("url", "bad")


def oracle() -> str:
    """DuckDB SQL for the query over ``pages`` and ``labels``."""
    fits = sorted(RULES, key=lambda r: -len(r.name))

    def cases(value: str) -> str:
        when = " ".join(
            f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')"
            f" THEN '{r.name if value == 'name' else r.verdict}'"
            for r in fits
        )
        return f"CASE {when} END"

    two = "|".join([rf"({'|'.join(SECOND_LABELS)})\.[a-z][a-z]", *(name.replace(".", r"\.") for name in PLATFORMS)])
    tail = "array_to_string(list_slice(parts, greatest(1, len(parts) - {0} + 1), len(parts)), '.')"

    def level(name: str, source: str, parent: str) -> str:
        return f"""{name}_weight AS (SELECT (1 - rho) / rho AS weight FROM (SELECT least(greatest(coalesce(
            sum((bad - n * prior) * (bad - n * prior) - n * prior * (1 - prior))
            / nullif(sum(n * (n - 1) * prior * (1 - prior)), 0), {MOST_SPREAD}), {LEAST_SPREAD}), {MOST_SPREAD}) AS rho
            FROM {source})),
        {name}_mean AS (SELECT s.*, bad + prior * weight AS a, n - bad + (1 - prior) * weight AS b, (bad + prior * weight) / (n + weight) AS mean
            FROM {source} s, {name}_weight)"""

    return f"""
    WITH rests AS (SELECT *, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
    seen AS (SELECT page_id, url,
        coalesce(translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}'), '') AS host,
        coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
        try_cast(regexp_extract(url, '://[^/?#]*/[a-z]+/([0-9]{{1,18}})', 1) AS bigint) AS shown FROM rests),
    outcomes AS (SELECT host, (coalesce(quality, 1) = 0 OR coalesce(toxic, 0) = 1)::bigint AS bad
        FROM seen JOIN labels ON shown = labels.doc_id WHERE quality IS NOT NULL OR toxic IS NOT NULL),
    counted AS (SELECT regexp_replace(host, '{BESIDE_SITE}', '', 'g') AS host, sum(n)::double AS n, sum(bad)::double AS bad FROM (
        SELECT host, 1 AS n, bad FROM outcomes UNION ALL SELECT host, 0, 0 FROM seen) GROUP BY 1),
    cut AS (SELECT *, string_split(host, '.') AS parts, regexp_matches(host, '{ADDRESS}') AS address,
        CASE WHEN regexp_matches(host, '(^|\\.)({two})\\z') THEN 2 ELSE 1 END AS k FROM counted),
    hosts AS (SELECT host, n, bad, CASE WHEN address THEN host ELSE {tail.format("(k + 1)")} END AS domain,
        CASE WHEN address THEN '' ELSE {tail.format("k")} END AS suffix FROM cut),
    domains AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY ALL),
    roots AS (SELECT (sum(bad) + 0.5) / (sum(n) + 1) AS prior FROM domains),
    suffixes AS (SELECT suffix, n, bad, prior FROM (
        SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY suffix), roots),
    {level("suffix", "suffixes", "")},
    domains_prior AS (SELECT d.*, m.mean AS prior FROM domains d JOIN suffix_mean m USING (suffix)),
    {level("domain", "domains_prior", "")},
    hosts_prior AS (SELECT h.*, m.mean AS prior FROM hosts h JOIN domain_mean m USING (domain)),
    {level("host", "hosts_prior", "")},
    terms AS (SELECT host, a, b, unnest(range(0, 100 + (8 * sqrt(a + b))::bigint)) AS k FROM host_mean WHERE mean > {LIMIT}),
    bounds AS (SELECT host AS site, sum(exp(lgamma(a + b + k) - lgamma(a + 1 + k) - lgamma(b) + (a + k) * ln({LIMIT}) + b * ln(1 - {LIMIT}))) AS below
        FROM terms GROUP BY host)
    SELECT page_id, host, path, {cases("name")} AS rule,
        coalesce({cases("verdict")}, CASE WHEN below <= 1 - {CONFIDENCE} THEN 'block' ELSE 'allow' END) AS verdict
    FROM seen LEFT JOIN bounds ON site = regexp_replace(host, '{BESIDE_SITE}', '', 'g')"""
