"""URL filter: explicit rules first, then host reputation by empirical Bayes.

Labelled page outcomes are counted by host. Each host's share of bad pages is shrunk towards its registered
domain's, that towards the public suffix's and that towards all pages', with beta-binomial priors whose strength is fitted
on each level by moments. A host is blocked if the lower bound of its posterior share of bad pages, a quantile of its beta
distribution, is above a threshold.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caresift.llm.tables import narrow, read
from caresift.session import materialize

#: (host, path, verdict); the longest rule that fits wins.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
#: Suffixes of two labels under which domains are registered.
TWO_LABEL_SUFFIXES = ("ac.uk", "co.jp", "co.nz", "co.uk", "com.au", "com.br", "com.mx", "gov.uk", "org.uk")
#: Posterior probability below the bound, and the share of bad pages that the bound must pass.
BELOW, BAD_SHARE = 0.05, 0.3
#: A page is bad with fewer words than this, or with more marks than this share of its words.
LEAST_WORDS, MARK_SHARE = 10, 0.2
#: Bounds of the fitted correlation inside a group, so that a prior is never empty or all there is.
LEAST_RHO, MOST_RHO = 0.001, 0.999


def url_parts(url: str = "url") -> tuple[Column, Column]:
    """(host, path): both empty if the url is null or has no ``://``."""
    rest = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return lower, path


def read_suffix_rules(spark: SparkSession, path: str) -> list[str]:
    """The rules of a public-suffix file: one a line, ``*.`` for any label, ``!`` for an exception; ``//`` starts a comment."""
    lines = spark.read.text(path).select(F.trim("value").alias("rule")).where("rule <> '' AND NOT startswith(rule, '//')")
    return sorted(r["rule"].split()[0].lower() for r in lines.distinct().collect())


def domain_of(host: Column, suffix_rules: Sequence[str] = TWO_LABEL_SUFFIXES) -> tuple[Column, Column]:
    """(registered domain, suffix) of a host, whose user, port and last dot are left aside.

    The suffix is the longest end of the host that a rule names, else its last label; the domain has one label more, or is
    the whole host if it has none.
    """
    plain = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r"(\.?:[0-9]*|\.)$", "")
    exact = [r for r in suffix_rules if not r.startswith(("*.", "!"))]
    wild = [r[2:] for r in suffix_rules if r.startswith("*.")]
    spared = [r[1:] for r in suffix_rules if r.startswith("!")]
    labels = F.split(plain, r"\.")
    ends = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))

    def named(end: Column) -> Column:
        found = end.isin(*exact) if exact else F.lit(False)
        if wild:
            found = found | F.regexp_replace(end, r"^[^.]*\.", "").isin(*wild) & end.contains(".")
        return found & ~end.isin(*spared) if spared else found

    place = F.coalesce(F.array_position(F.transform(ends, lambda e: named(e)), True), F.lit(0))
    place = F.when(place > 0, place).otherwise(F.size(labels)).cast("int")
    return F.get(ends, F.greatest(place - 2, F.lit(0))), F.get(ends, place - 1)


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """A struct (rule, verdict) of the longest fitting rule, or null."""
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for name, start, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), len(r[0]))):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        found = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _strength(table: DataFrame) -> float:
    """The prior's weight in pages, by moments of the beta-binomial over the groups of one level; 1 if none has a page."""
    r = table.agg(
        F.count(F.lit(1)).alias("j"),
        F.sum("n").alias("n"),
        F.sum("bad").alias("bad"),
        F.sum(F.col("bad") * F.col("bad") / F.col("n")).alias("sq"),
        F.sum((F.col("n") * F.col("n")).cast("decimal(38,0)")).cast("double").alias("nn"),
    ).first()
    if not r["n"]:
        return 1.0
    p = r["bad"] / r["n"]
    inside = p * (1 - p)
    room = inside * (r["n"] - r["nn"] / r["n"] - (r["j"] - 1))
    rho = (r["sq"] - p * r["bad"] - inside * (r["j"] - 1)) / room if room > 0 else MOST_RHO
    rho = min(MOST_RHO, max(LEAST_RHO, rho))
    return (1 - rho) / rho


def beta_share(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The share of a beta distribution below ``x``, by its continued fraction."""
    turned = x > (a + 1) / (a + b + 2)
    p, q, y = np.where(turned, b, a), np.where(turned, a, b), np.where(turned, 1 - x, x)
    log = np.vectorize(math.lgamma, otypes=[float])
    with np.errstate(divide="ignore", invalid="ignore"):
        front = np.exp(log(p + q) - log(p) - log(q) + p * np.log(y) + q * np.log1p(-y))
    tiny = 1e-300
    c, d = np.ones_like(y), 1 - (p + q) * y / (p + 1)
    d = 1 / np.where(np.abs(d) < tiny, tiny, d)
    h = d.copy()
    for m in range(1, 10_000):
        for step in (m * (q - m) * y / ((p + 2 * m - 1) * (p + 2 * m)), -(p + m) * (p + q + m) * y / ((p + 2 * m) * (p + 2 * m + 1))):
            d, c = 1 + step * d, 1 + step / c
            d, c = 1 / np.where(np.abs(d) < tiny, tiny, d), np.where(np.abs(c) < tiny, tiny, c)
            h = h * d * c
        if np.all(np.abs(d * c - 1) < 1e-14):
            break
    below = np.where(y > 0, front * h / p, 0.0)
    return np.where(turned, 1 - below, below)


def beta_quantile(share: float, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The points below which ``share`` of each beta distribution lies, by halving."""
    low, high = np.zeros(len(a)), np.ones(len(a))
    for _ in range(52):
        middle = (low + high) / 2
        under = beta_share(middle, a, b) < share
        low, high = np.where(under, middle, low), np.where(under, high, middle)
    return (low + high) / 2


def with_bounds(posterior: DataFrame, below: float = BELOW) -> DataFrame:
    """(host, n, bad, mean, low) of posteriors (host, n, bad, a, b); ``low`` is the lower bound of the share."""
    import pyarrow as pa

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (batch.column(k).to_numpy(zero_copy_only=False) for k in (3, 4))
                columns = [*(batch.column(k) for k in range(3)), pa.array(a / (a + b)), pa.array(beta_quantile(below, a, b))]
                yield pa.RecordBatch.from_arrays(columns, names=["host", "n", "bad", "mean", "low"])

    return posterior.select("host", "n", "bad", "a", "b").mapInArrow(work, "host string, n long, bad long, mean double, low double")


def reputations(outcomes: DataFrame, suffix_rules: Sequence[str] = TWO_LABEL_SUFFIXES) -> DataFrame:
    """(host, n, bad, mean, low) of every host in ``outcomes`` (url, bad boolean); rows with null ``bad`` count nothing.

    ``suffix_rules`` are public suffixes of several labels (``read_suffix_rules`` reads a file of them). A host keeps a row even if none of its pages is labelled: its posterior is then its domain's prior. Rows without a
    host are the host ``''``. One row for each level comes to the driver.
    """
    host, _ = url_parts()
    labelled = F.col("bad").isNotNull().cast("long")
    hosts = (
        narrow(outcomes, url="url", bad="bad")
        .select(host.alias("host"), labelled.alias("n"), F.coalesce(F.col("bad").cast("long"), F.lit(0)).alias("bad"))
        .groupBy("host")
        .agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    )
    domain, suffix = domain_of(F.col("host"), suffix_rules)
    hosts = materialize(hosts.withColumns({"domain": domain, "suffix": suffix}), "hosts")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    domains = materialize(domains, "domains")
    suffixes = materialize(domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")), "suffixes")
    total = suffixes.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    overall = ((total["bad"] or 0) + 1) / ((total["n"] or 0) + 2)
    k_suffix, k_domain, k_host = (_strength(t.where("n > 0")) for t in (suffixes, domains, hosts))

    def shrunk(prior, k: float):
        return (F.col("bad") + F.lit(k) * prior) / (F.col("n") + F.lit(k))

    by_suffix = suffixes.select(
        F.col("suffix").alias("s"), shrunk(F.lit(overall), k_suffix).alias("suffix_mean")
    )
    by_domain = domains.join(by_suffix, F.col("suffix") == F.col("s")).select(
        F.col("domain").alias("d"),
        F.col("suffix").alias("ds"),
        shrunk(F.col("suffix_mean"), k_domain).alias("prior"),
    )
    by_domain = materialize(by_domain, "domain-priors")
    joined = hosts.join(by_domain, (F.col("domain") == F.col("d")) & (F.col("suffix") == F.col("ds")))
    a = F.col("bad") + F.lit(k_host) * F.col("prior")
    b = F.col("n") - F.col("bad") + F.lit(k_host) * (1 - F.col("prior"))
    return with_bounds(joined.withColumns({"a": a, "b": b}))


def page_outcomes(pages: DataFrame) -> DataFrame:
    """(url, bad) by a plain content rule: too few words outside of tags, or too many marks; a null html has no outcome."""
    text = F.regexp_replace("html", "<[^>]*>", " ")
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    marks = F.regexp_count(text, F.lit(r"[#*$%|!]"))
    return narrow(pages, url="url", html="html").select("url", ((words < LEAST_WORDS) | (marks > MARK_SHARE * words)).alias("bad"))


def judge(pages: DataFrame, reputation: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, bad_share: float = BAD_SHARE) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of ``pages`` (page_id, url): the longest rule's verdict, else by reputation.

    A host without a reputation is allowed. Null and repeated rows each get a verdict; other columns are ignored.
    """
    host, path = url_parts()
    rows = narrow(pages, page_id="page_id", url="url").select("page_id", host.alias("host"), path.alias("path"))
    ruled = rows.withColumn("found", matching_rule(F.col("host"), F.col("path"), rules))
    bad = reputation.where(F.col("low") > bad_share).select(F.col("host").alias("bad_host"))
    bad = materialize(bad, "bad-hosts")
    joined = ruled.join(bad, F.col("host") == F.col("bad_host"), "left")
    by_host = F.when(F.col("bad_host").isNotNull(), "block").otherwise("allow")
    return joined.select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"), F.coalesce("found.verdict", by_host).alias("verdict")
    )


def op3_url_reputation(spark, sf_dir: str) -> DataFrame:
    """A verdict for every page's url."""
    pages = read(spark, sf_dir, "pages")
    return judge(pages, reputations(page_outcomes(pages)))


OP3_SQL = r"""
    WITH cut AS (
        SELECT page_id, html, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
    ), parts AS (
        SELECT page_id, html, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
        FROM cut
    ), texts AS (
        SELECT *, regexp_replace(html, '<[^>]*>', ' ', 'g') AS body FROM parts
    ), outcomes AS (
        SELECT *, len(regexp_extract_all(body, '[^\x20\x09-\x0D]+')) AS words, len(regexp_extract_all(body, '[#*$%|!]')) AS marks FROM texts
    ), hosts AS (
        SELECT host, count(body) AS n, coalesce(sum((words < 10 OR marks > 0.2 * words)::INT), 0) AS bad,
            string_split(regexp_replace(regexp_replace(host, '^.*@', ''), '(\.?:[0-9]*|\.)$', ''), '.') AS l
        FROM outcomes GROUP BY host
    ), ends AS (
        SELECT host, n, bad, l[len(l)] AS end1, CASE WHEN len(l) > 1 THEN l[len(l) - 1] || '.' || l[len(l)] ELSE l[1] END AS end2,
            CASE WHEN len(l) > 2 THEN l[len(l) - 2] || '.' || l[len(l) - 1] || '.' || l[len(l)] ELSE array_to_string(l, '.') END AS end3
        FROM hosts
    ), h AS (
        SELECT host, n, bad, CASE WHEN two THEN end3 ELSE end2 END AS domain, CASE WHEN two THEN end2 ELSE end1 END AS suffix
        FROM (SELECT *, end2 IN ('ac.uk', 'co.jp', 'co.nz', 'co.uk', 'com.au', 'com.br', 'com.mx', 'gov.uk', 'org.uk') AS two FROM ends)
    ), d AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM h GROUP BY ALL
    ), s AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM d GROUP BY ALL
    ), levels AS (
        SELECT 'h' AS level, n, bad FROM h UNION ALL SELECT 'd', n, bad FROM d UNION ALL SELECT 's', n, bad FROM s
    ), sums AS (
        SELECT level, count(*)::DOUBLE AS j, sum(n)::DOUBLE AS n, sum(bad)::DOUBLE AS bad, sum(bad * bad / n::DOUBLE) AS sq, sum(n * n)::DOUBLE AS nn
        FROM levels WHERE n > 0 GROUP BY level
    ), rhos AS (
        SELECT level, p, p * (1 - p) AS inside, p * (1 - p) * (n - nn / n - (j - 1)) AS room, sq - p * bad - p * (1 - p) * (j - 1) AS extra
        FROM (SELECT *, bad / n AS p FROM sums)
    ), k AS (
        SELECT level, (1 - rho) / rho AS k FROM (SELECT level, least(0.999, greatest(0.001, CASE WHEN room > 0 THEN extra / room ELSE 0.999 END))::DOUBLE AS rho FROM rhos)
    ), ks AS (
        SELECT max(k) FILTER (level = 'h') AS kh, max(k) FILTER (level = 'd') AS kd, max(k) FILTER (level = 's') AS ks,
            (SELECT (sum(bad) + 1) / (sum(n) + 2)::DOUBLE FROM s) AS overall FROM k
    ), sm AS (SELECT suffix, (bad + ks * overall) / (n + ks) AS mean FROM s, ks
    ), dm AS (SELECT domain, d.suffix, (bad + kd * mean) / (n + kd) AS prior FROM d JOIN sm ON d.suffix = sm.suffix, ks
    ), ab AS (SELECT host, bad + kh * prior AS a, n - bad + kh * (1 - prior) AS b FROM h JOIN dm ON h.domain = dm.domain AND h.suffix = dm.suffix, ks
    ), low AS (
        SELECT host, sum(exp(lgamma(a + b + i) - lgamma(a + b) - lgamma(a + 1 + i) + lgamma(a + 1) + i * ln(0.3::DOUBLE)))
            * exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * ln(0.3::DOUBLE) + b * ln(0.7::DOUBLE)) / a AS below
        FROM (SELECT host, a::DOUBLE AS a, b::DOUBLE AS b FROM ab) CROSS JOIN range(3000) t(i) GROUP BY host, a, b
    ), ruled AS (
        SELECT page_id, p.host, path, CASE
            WHEN (p.host = 'example.org' OR ends_with(p.host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
            WHEN (p.host = 'example.org' OR ends_with(p.host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
            WHEN (p.host = 'com' OR ends_with(p.host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
            WHEN (p.host = 'com' OR ends_with(p.host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
            WHEN (p.host = 'org' OR ends_with(p.host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule, below
        FROM parts p LEFT JOIN low ON p.host = low.host
    )
    SELECT page_id, host, path, rule, CASE
        WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
        WHEN below < 0.05 THEN 'block' ELSE 'allow' END AS verdict
    FROM ruled
"""
