from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from loanops.llm import url_filter
from loanops.llm.queries import URL_RULES

URLS = [
    "https://WWW.Example.com/en/1",
    "https://www.example.com/en/1/?utm_source=x#top",
    "http://blog.example.com/en/",
    "http://example.com/de/2?b=2&a=1",
    "http://m.example.com/de/2?a=1&b=2&ref=z",
    "http://a.net/es/x",
    "http://net/fr/",
    "http://xnet/fr/",
    "http://a.net",
    "http://a.org?x=://b.com/",
    "://",
    "no scheme",
    "",
    None,
    "ftp://user:pw@Host.org:80/p/?#f",
    "http://host.org/p",
]


def rule_by_hand(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.host + r.path), default=None)
    return host, path, best and best.host + best.path, best and best.verdict


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(i, u, "x", "y", 1) for i, u in enumerate(URLS)] + [(3, URLS[3], "x", "y", 1)], "page_id long, url string, host string, rule string, block long")


def test_rules(spark, pages):
    listed = spark.createDataFrame([], "url string")
    rows = url_filter.filter_urls(pages, listed, URL_RULES).collect()
    assert len(rows) == len(URLS) + 1
    for r in rows:
        host, path, rule, verdict = rule_by_hand(URLS[r["id"]])
        assert (r["host"], r["path"], r["rule"], r["verdict"], r["listed"]) == (host, path, rule, verdict or "allow", False)


def test_listed_pages_match_by_canonical_url(spark, pages):
    listed = spark.createDataFrame([("http://m.example.com/de/2?b=2&a=1",), ("x://host.org/p/",), (None,), ("http://host.org/p",), ("none",)], "url string")
    hits = {r["id"] for r in url_filter.filter_urls(pages, listed, []).where("verdict = 'block'").collect()}
    assert hits == {3, 4, 14, 15}


def test_filter_has_every_listed_url_and_few_others(spark):
    known = spark.range(20_000).select(F.concat(F.lit("h/"), "id").alias("known"))
    bloom = url_filter.bloom_filter(known, "known")
    assert bloom.count() <= url_filter.BLOCKS
    tried = spark.range(40_000).select("id", F.concat(F.lit("h/"), "id").alias("c"))
    passes = F.lit(True)
    for k, bit in enumerate(url_filter.block_bits(F.col("c"))):
        passes = passes & (F.coalesce(F.col(f"w{k}"), F.lit(0)).bitwiseAND(bit) != 0)
    found = tried.withColumn("block", url_filter.block_of(F.col("c"))).join(bloom, "block", "left").where(passes)
    assert found.where("id < 20000").count() == 20_000
    assert found.where("id >= 20000").count() < 20


def test_plan_has_no_python_and_empty_tables_work(spark, pages):
    frame = url_filter.filter_urls(pages.limit(0), pages.limit(0).select("url"), URL_RULES)
    assert frame.count() == 0
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Cartesian|NestedLoop", plan)
