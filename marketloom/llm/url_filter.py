"""URL filters: a blocked Bloom filter of listed canonical URLs, then an exact hash join on what passes it.

Only DataFrame functions: no Python code runs on the executors.
"""

from __future__ import annotations

import math
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import stored

_URL = r"^(?s).*?://([^/?#]*)([^?#]*)"
_QUERY = r"^(?s)[^?#]*\?([^#]*)"
_TRACKING = r"^(utm_[a-z]+|ref|gclid|fbclid)(=.*)?$"
WORDS = 8


@dataclass(frozen=True)
class UrlRule:
    """`verdict` for a host with all its subdomains, where the path starts with `path`."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    UrlRule("allow", "org", "/"),
    UrlRule("block", "example.org", "/es/"),
    UrlRule("block", "example.org", "/en/1"),
    UrlRule("allow", "com", "/fr/"),
    UrlRule("block", "com", "/de/"),
)
#: Host labels whose pages and mirrors a crawl's own list holds.
LISTED_LABELS = ("casino-win", "free-bets", "ads-track", "spam-farm", "cheap-pills", "adult-x")
BITS_PER_URL = 12


def lower_ascii(column: Column) -> Column:
    return F.translate(column, string.ascii_uppercase, string.ascii_lowercase)


def host_of(url: str = "url") -> Column:
    """From the first :// up to /, ? or #, A-Z in lower case; empty without :// or for null."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")))


def path_of(url: str = "url") -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def canonical(url: str = "url") -> Column:
    """One spelling of a URL: host in lower case without www., m. or a standard port, path without a last slash
    or .html, other query parts sorted, no tracking part, no fragment, no scheme. Empty if there is no host."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"^(www|m)\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(F.regexp_replace(path_of(url), r"\.html?$", ""), r"/+$", "")
    parts = F.array_sort(F.filter(F.split(F.regexp_extract(url, _QUERY, 1), "&"), lambda x: (x != "") & ~x.rlike(_TRACKING)))
    query = F.when(F.size(parts) > 0, F.concat(F.lit("?"), F.array_join(parts, "&"))).otherwise("")
    return F.when(host_of(url) == "", "").otherwise(F.coalesce(F.concat(host, path, query), F.lit("")))


def rule_of(host: Column, path: Column, rules: tuple[UrlRule, ...] = RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, null if none does; `rules` is a bounded parameter."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.name), r.verdict == "block")):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        chosen = F.when(fits, F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.shiftrightunsigned(F.xxhash64(key), 32), F.lit(blocks))


def _masks(key: Column) -> list[Column]:
    """One bit in each of the eight words of 32 bits of a block."""
    low = F.xxhash64(F.lit(1), key)
    bits = [F.shiftrightunsigned(low, 5 * i).bitwiseAND(F.lit(31)).cast("int") for i in range(WORDS)]
    return [F.call_function("shiftleft", F.lit(1).cast("long"), b) for b in bits]


def bloom_blocks(listed: DataFrame, blocks: int) -> DataFrame:
    """block and its eight words, from `listed` (key): one grouping whose rows are combined before the shuffle."""
    masks = [m.alias(f"w{i}") for i, m in enumerate(_masks(F.col("key")))]
    return (
        listed.select(_block(F.col("key"), blocks).alias("block"), *masks)
        .groupBy("block")
        .agg(*(F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)))
    )


def listed_flags(urls: DataFrame, listed: DataFrame) -> DataFrame:
    """`urls` (with a column __key) and __listed: whether __key is a key of `listed` (key string).

    A row meets its block of the filter. Only rows whose eight bits are set go on to the exact hash join, which removes
    false positives; the others are known not to be listed and move no further. The probed rows and both tables are
    written once, so Spark broadcasts a table only if its size is below its threshold; else it shuffles the hits and
    splits a hot key.
    """
    keys = stored(listed.where("key is not null and key <> ''").select("key").distinct(), "listed")
    blocks = max(1, math.ceil(keys.count() * BITS_PER_URL / (32 * WORDS)))
    bloom = stored(bloom_blocks(keys, blocks), "bloom").withColumnRenamed("block", "__block")
    met = urls.join(bloom, _block(F.col("__key"), blocks) == F.col("__block"), "left")
    hit = F.col("__block").isNotNull()
    for i, mask in enumerate(_masks(F.col("__key"))):
        hit = hit & (F.col(f"w{i}").bitwiseAND(mask) == mask)
    probed = stored(met.select(*urls.columns, F.coalesce(hit, F.lit(False)).alias("__hit")), "probed")
    exact = keys.select(F.col("key").alias("__found")).hint("shuffle_hash")
    hits = probed.where("__hit").join(exact, F.col("__key") == F.col("__found"), "left")
    misses = probed.where("not __hit").select(*urls.columns, F.lit(False).alias("__listed"))
    return hits.select(*urls.columns, F.col("__found").isNotNull().alias("__listed")).unionByName(misses)


def url_verdicts(pages: DataFrame, listed: DataFrame, rules: tuple[UrlRule, ...] = RULES) -> DataFrame:
    """page_id, host, path, rule and verdict of every row of `pages` (page_id, url).

    The longest rule that fits decides; without one, a URL is blocked if its canonical form is among those
    of `listed` (url) and allowed otherwise. Null, empty and other URLs without :// have an empty host and
    path and are allowed. Repeated rows each get their verdict; an empty list blocks nothing.
    """
    own = pages.select("page_id", host_of().alias("host"), path_of().alias("path"), canonical().alias("__key"))
    flagged = listed_flags(own, listed.select(canonical().alias("key")))
    fit = rule_of(F.col("host"), F.col("path"), rules)
    judged = flagged.withColumn("__fit", fit)
    verdict = F.coalesce(F.col("__fit.verdict"), F.when(F.col("__listed"), "block").otherwise("allow"))
    return judged.select("page_id", "host", "path", F.col("__fit.rule").alias("rule"), verdict.alias("verdict"))


def crawl_list(pages: DataFrame, labels: tuple[str, ...] = LISTED_LABELS) -> DataFrame:
    """url of the pages that a crawl lists by itself: those with one of `labels` in their host, and their mirrors, the
    pages elsewhere that carry the title of one of them. Pages without a title are nobody's mirror."""
    title = F.regexp_extract(F.coalesce("html", F.lit("")), r"(?s)<title>(.*?)</title>", 1)
    named = pages.select("url", title.alias("title"), F.exists(F.split(host_of(), r"\."), lambda x: x.isin(*labels)).alias("bad"))
    titles = named.where("bad and title <> ''").select(F.col("title").alias("bad_title")).distinct()
    mirrors = named.where("not bad and title <> ''").join(titles, F.col("title") == F.col("bad_title"), "left_semi")
    return named.where("bad").select("url").unionByName(mirrors.select("url"))
