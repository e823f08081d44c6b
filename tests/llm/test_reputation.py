"""URL parts and rules against plain Python, reputations on literal cases."""

import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from caresift.llm import reputation

URLS = [
    None,
    "",
    "no scheme/a",
    "http://",
    "HTTP://A.Example.ORG/es/1?x#y",
    "https://example.org/en/1",
    "https://xexample.org/en/2",
    "http://sub.x.com/fr/",
    "http://com/de/",
    "http://host.com?/fr/",
    "http://ÄB.com#/fr/",
    "ftp://a.b.co.uk/://c/d",
    "http://org",
]


def plain(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in reputation.RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else None


def test_parts_and_rules(spark):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)], "page_id long, url string, host string")
    empty = spark.createDataFrame([], "url string, bad boolean")
    got = {r["page_id"]: r for r in reputation.judge(pages, reputation.reputations(empty)).collect()}
    for i, u in enumerate(URLS):
        host, path, rule, verdict = plain(u)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"]) == (host, path, rule, verdict or "allow")


def outcomes(spark, *groups):
    rows = [(f"http://{host}/{k}", k < bad) for host, n, bad in groups for k in range(n)]
    return spark.createDataFrame(rows, "url string, bad boolean")


def test_shrinkage(spark):
    usual = [(f"h{i}.d{i % 10}.com", 20, i % 5) for i in range(60)]
    rows = outcomes(spark, *usual, ("spam.bad.net", 40, 38), ("new.bad.net", 1, 1), ("good.net", 60, 1), ("www.good.net", 50, 0), ("one.com", 1, 1))
    got = {r["host"]: r for r in reputation.reputations(rows).collect()}
    assert got["spam.bad.net"]["low"] > reputation.BAD_SHARE
    assert got["one.com"]["low"] < reputation.BAD_SHARE < got["new.bad.net"]["mean"]
    assert got["one.com"]["mean"] < got["new.bad.net"]["mean"] < 1
    assert got["good.net"]["mean"] < 0.1
    pages = rows.selectExpr("1L AS page_id", "url")
    verdicts = {r["host"]: r["verdict"] for r in reputation.judge(pages, reputation.reputations(rows)).collect()}
    assert verdicts["spam.bad.net"] == "block" and verdicts["good.net"] == verdicts["one.com"] == "allow"


def test_unlabelled_rows_count_nothing(spark):
    rows = spark.createDataFrame([("http://a.net/", None), (None, True), ("http://a.net/", True)], "url string, bad boolean")
    got = {r["host"]: (r["n"], r["bad"]) for r in reputation.reputations(rows).collect()}
    assert got == {"a.net": (1, 1), "": (1, 1)}
    none = rows.where("bad IS NULL")
    assert [r["mean"] for r in reputation.reputations(none).collect()] == [pytest.approx(0.5)]


def test_content_rule(spark):
    pages = spark.createDataFrame([("u", "<p>" + "word " * 20), ("v", "<p>few"), ("w", "wor#d*$ " * 20), ("x", None)], "url string, html string")
    assert {r["url"]: r["bad"] for r in reputation.page_outcomes(pages).collect()} == {"u": False, "v": True, "w": True, "x": None}


def test_bound_is_the_quantile_of_the_posterior():
    draws = np.random.default_rng(3)
    for a, b in ((0.5, 3.0), (1.0, 1.0), (3.5, 40.25), (38.7, 2.2), (900.0, 4000.0), (5e5, 2e6)):
        low = reputation.beta_quantile(0.05, np.array([a]), np.array([b]))[0]
        if a == b == 1.0:
            assert low == pytest.approx(0.05)
        assert np.mean(draws.beta(a, b, 200_000) < low) == pytest.approx(0.05, abs=0.003)
    x = np.linspace(0, 1, 11)
    assert np.allclose(reputation.beta_share(x, np.full(11, 2.0), np.full(11, 3.0)), 6 * x**2 - 8 * x**3 + 3 * x**4)


def test_domains(spark):
    cases = {
        "a.b.co.uk": ("b.co.uk", "co.uk"),
        "user:pw@www.site.org:8080": ("site.org", "org"),
        "site.org.": ("site.org", "org"),
        "co.uk": ("co.uk", "co.uk"),
        "localhost": ("localhost", "localhost"),
        "": ("", ""),
        "x.y.any.ck": ("y.any.ck", "any.ck"),
        "www.ck": ("www.ck", "ck"),
        "deep.www.ck": ("www.ck", "ck"),
    }
    rows = spark.createDataFrame([(h,) for h in cases], "host string")
    domain, suffix = reputation.domain_of(F.col("host"), ["co.uk", "*.ck", "!www.ck"])
    assert {r["host"]: (r["d"], r["s"]) for r in rows.select("host", domain.alias("d"), suffix.alias("s")).collect()} == cases


def test_rules_of_a_file(spark, tmp_path):
    (tmp_path / "suffixes.dat").write_text("// comment\n\nco.uk\n*.ck\n!www.ck\n")
    assert reputation.read_suffix_rules(spark, str(tmp_path / "suffixes.dat")) == ["!www.ck", "*.ck", "co.uk"]


def test_query_and_sql_block_the_same_hosts(spark, tmp_path):
    """On a table with bad hosts the method decides, and the SQL finds the same verdicts."""
    draw = random.Random(4)
    good, bad = "<p>" + "word " * 30, "<p>few"
    hosts = {f"h{k}.site{k % 7}.{['com', 'net', 'co.uk'][k % 3]}": draw.choice([0.0, 0.05, 0.4, 0.6, 0.95]) for k in range(40)}
    hosts |= {"user@spam.net:81": 1.0, "": 0.5}
    rows, page = [], 0
    for host, share in hosts.items():
        for _ in range(draw.randint(1, 40)):
            rows.append((page, f"http://{host}/p{page}" if host else None, bad if draw.random() < share else good))
            page += 1
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = {r["page_id"]: tuple(r) for r in reputation.op3_url_reputation(spark, str(tmp_path)).collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    cursor = con.execute(reputation.OP3_SQL)
    names = [d[0] for d in cursor.description]
    want = {r[names.index("page_id")]: tuple(r[names.index(c)] for c in ("page_id", "host", "path", "rule", "verdict")) for r in cursor.fetchall()}
    assert got == want
    verdicts = [r[4] for r in got.values()]
    assert 50 < verdicts.count("block") < len(verdicts) - 50
