"""URL filter: host and path rules, then a blocked Bloom filter of listed canonical URLs before an exact hash join.

A canonical URL is the host (A-Z lower-cased, without user, port and a leading ``www.`` or ``m.``), the path without one trailing ``/``
and the query without tracking parameters; scheme and fragment go. The filter has ``BLOCKS`` blocks of 512 bits; a URL's hash chooses one block
and eight bits in it. It is built by one aggregation (``bit_or`` by block) and broadcast: ``BLOCKS`` rows of nine longs are its proven
bound, 2.4 MB, whatever the list's length. With 16 bits a URL (1 million URLs) about one page in 2,000 passes by
mistake, with more URLs more do; the exact join on the canonical URL removes them all, so the verdicts never depend on the filter. Only built-in
functions are used.

Defined cases: a null URL, or one without ``://``, has empty host and path, fits no rule, is never listed and is allowed. A URL without a
path has path ``''``, which no rule's path starts. Of two rules that fit, the one with the longest host and path wins. Repeated pages are judged each,
repeated or null listed URLs count once or not at all. An empty list allows everything that no rule blocks.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCKS = 1 << 15
WORDS = 8

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TRACKING = "utm_[a-z]+|ref|fbclid|gclid"


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str


def url_rest(url: Column) -> Column:
    """What follows the first ``://``; null for a null URL or one without it."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + F.lit(3)))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url_rest(url), "^([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical_url(url: Column) -> Column:
    """One form for the addresses of one page; null without ``://``."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"^.*@|:[0-9]*\z", ""), r"^(www\.|m\.)", "")
    path = F.regexp_replace(path_of(url), r"/\z", "")
    query = F.regexp_extract(url_rest(url), r"^[^?#]*\?([^#]*)", 1)
    parts = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(f"^({TRACKING})(=|\\z)")))
    shown = F.when(F.size(parts) > 0, F.concat(F.lit("?"), F.array_join(parts, "&"))).otherwise(F.lit(""))
    return F.when(url_rest(url).isNotNull(), F.concat(host, path, shown))


def rule_fits(host: Column, path: Column, rule: Rule) -> Column:
    own = (host == rule.host) | host.endswith("." + rule.host)
    return own & path.startswith(rule.path)


def longest_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(rule as host and path, its verdict) of the longest rule that fits; nulls if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.host + r.path)):  # the last one that fits is the longest
        fits = rule_fits(host, path, rule)
        name = F.when(fits, F.lit(rule.host + rule.path)).otherwise(name)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def block_of(canonical: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(1), canonical), F.lit(BLOCKS))


def block_bits(canonical: Column) -> list[Column]:
    """One bit in each of the block's eight words, from six bits of a second hash each."""
    h = F.xxhash64(F.lit(2), canonical)
    return [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 6 * k).bitwiseAND(63).cast("int")) for k in range(WORDS)]


def bloom_filter(listed: DataFrame, canonical: str) -> DataFrame:
    """(block, w0..w7): at most ``BLOCKS`` rows."""
    bits = block_bits(F.col(canonical))
    own = listed.select(block_of(F.col(canonical)).alias("block"), *[b.alias(f"w{k}") for k, b in enumerate(bits)])
    return own.groupBy("block").agg(*[F.expr(f"bit_or(w{k})").alias(f"w{k}") for k in range(WORDS)])


def filter_urls(pages: DataFrame, listed: DataFrame, rules: Sequence[Rule], id_column: str = "page_id", url_column: str = "url",
                listed_column: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict, canonical, listed): one row for each page."""
    url = F.col(f"`{url_column}`").cast("string")
    # dealt out by a salt as well, so that the exact join exchanges this side by itself and can split hot addresses
    known = (
        listed.select(canonical_url(F.col(f"`{listed_column}`").cast("string")).alias("known"))
        .where(F.col("known").isNotNull())
        .groupBy("known", F.xxhash64("known").alias("salt"))
        .agg(F.lit(1).alias("one"))
        .select("known")
    )
    name, said = longest_rule(F.col("host"), F.col("path"), rules)
    own = (
        pages.select(F.col(f"`{id_column}`").alias("id"), url.alias("url"))
        .withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url")), "canonical": canonical_url(F.col("url"))})
        .withColumns({"rule": name, "said": said})
        .drop("url")
        .withColumn("block", block_of(F.col("canonical")))
    )
    probed = own.join(F.broadcast(bloom_filter(known, "known")), "block", "left")
    passes = F.col("canonical").isNotNull()
    for k, bit in enumerate(block_bits(F.col("canonical"))):
        passes = passes & (F.coalesce(F.col(f"w{k}"), F.lit(0)).bitwiseAND(bit) != 0)
    probe = F.when(passes, F.col("canonical"))  # null never matches, and Spark spreads such rows of a left join
    probed = probed.withColumn("probe", probe).drop("block", *[f"w{k}" for k in range(WORDS)])
    hits = probed.where(F.col("probe").isNotNull())
    rest = probed.where(F.col("probe").isNull()).withColumn("listed", F.lit(False))
    exact = hits.join(known, F.col("probe") == F.col("known"), "left").withColumn("listed", F.col("known").isNotNull()).drop("known")
    method = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    return rest.unionByName(exact).select("id", "host", "path", "rule", F.coalesce("said", method).alias("verdict"), "canonical", "listed")
