"""URL filter: a blocked Bloom filter of listed canonical URLs in front of an exact join.

The listed URLs set eight bits each in one block of 256; the blocks are built by a grouped bitwise or. The
filter is sent to all tasks: its blocks are bounded in number, so a longer list makes more
possible hits, never more memory. URLs whose bits are all set go to a join with the list itself,
which removes false positives.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits per listed URL, and most blocks: 2^18 blocks of 256 bits are 8 MB.
BITS_PER_URL, MOST_BLOCKS = 16, 1 << 18


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str


#: Fixed by the results' definition.
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)

#: Host labels whose pages are listed.
LISTED_LABELS = ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z in lower case and path; both empty for null or where there is no ://."""
    has = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.substr(url, F.instr(url, "://") + 3)
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.when(has, host).otherwise(""), F.when(has, path).otherwise("")


def canonical(url: Column) -> Column:
    """Host without www., m. or blog. and default port, path without index page, .html and trailing slash,
    query without tracking parameters in order of its parts; no scheme and no fragment. Empty where there is no ://."""
    host, path = host_and_path(url)
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^(www|m|blog)\.", "")
    path = F.regexp_replace(F.regexp_replace(path, r"(/index)?(\.html?)$", ""), r"/+$", "")
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    parts = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(r"^(utm_[a-z]+|ref|fbclid|gclid)=")))
    found = F.concat(host, path, F.when(F.size(parts) > 0, F.concat(F.lit("?"), F.array_join(parts, "&"))).otherwise(""))
    return F.when(F.coalesce(F.instr(url, "://") > 0, F.lit(False)), found).otherwise("")


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The longest rule that fits, as struct(rule, verdict); null without one."""
    found = None
    for r in sorted(rules, key=lambda r: len(r.host) + len(r.path), reverse=True):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        value = F.struct(F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict"))
        found = F.when(fits, value) if found is None else found.when(fits, value)
    return found


def _block_and_bits(url: Column, blocks: int) -> tuple[Column, list[Column]]:
    """Block of a URL, and the four 64-bit words of its bits in it, two bits in each."""
    spread = F.xxhash64(F.lit(7), url)
    words = []
    for k in range(4):
        one = F.expr("1L")
        bits = [F.call_function("shiftleft", one, F.shiftrightunsigned(spread, 12 * k + 6 * j).bitwiseAND(F.lit(63)).cast("int")) for j in (0, 1)]
        words.append(bits[0].bitwiseOR(bits[1]))
    return F.pmod(F.xxhash64(url), F.lit(blocks)), words


def bloom_blocks(listed: DataFrame, blocks: int) -> DataFrame:
    """(block, b0 .. b3) from distinct `canonical` URLs."""
    block, words = _block_and_bits(F.col("canonical"), blocks)
    bits = listed.select(block.alias("block"), *[w.alias(f"b{k}") for k, w in enumerate(words)])
    return bits.groupBy("block").agg(*[F.bit_or(f"b{k}").alias(f"b{k}") for k in range(4)])


def possible_hits(urls: DataFrame, listed: DataFrame) -> DataFrame:
    """`urls` whose `canonical` passes the filter of `listed`; none that is listed is lost."""
    n = listed.count()
    blocks = min(MOST_BLOCKS, max(1, -(-n * BITS_PER_URL // 256)))
    # At most MOST_BLOCKS rows of five longs, whatever the length of the list.
    sieve = F.broadcast(bloom_blocks(listed, blocks))
    block, words = _block_and_bits(F.col("canonical"), blocks)
    tried = urls.withColumn("block", block).join(sieve, "block")
    passed = reduce(lambda a, b: a & b, [F.col(f"b{k}").bitwiseAND(w) == w for k, w in enumerate(words)])
    return tried.where(passed).select(*urls.columns)


def filter_urls(pages: DataFrame, listed: DataFrame, rules: tuple[Rule, ...] = RULES, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """Per row: page_id, host, path, rule, verdict: the rule's, else block if the canonical URL is in `listed` (url).

    A null URL or one without :// has an empty host and path, fits no rule and is allowed. Repeated rows have
    one result each; an empty list blocks nothing.
    """
    told = listed.where(F.col("url").isNotNull()).select(canonical(F.col("url")).alias("canonical")).where("canonical <> ''").distinct()
    host, path = host_and_path(F.col(url))
    rows = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"), canonical(F.col(url)).alias("canonical"))
    rows = rows.withColumn("found", rule_of(F.col("host"), F.col("path"), rules))
    open_ = rows.where("found is null and canonical <> ''").select("canonical").distinct()
    blocked = possible_hits(open_, told).join(told, "canonical").select("canonical", F.lit("block").alias("listed"))
    judged = rows.join(blocked, "canonical", "left")
    verdict = F.coalesce(F.col("found.verdict"), F.col("listed"), F.lit("allow"))
    return judged.select("page_id", "host", "path", F.col("found.rule").alias("rule"), verdict.alias("verdict"))


def pages_of_listed_hosts(pages: DataFrame, labels: tuple[str, ...] = LISTED_LABELS, url: str = "url") -> DataFrame:
    """URLs (url) of pages whose host has one of the labels."""
    host, _ = host_and_path(F.col(url))
    return pages.where(F.arrays_overlap(F.split(host, r"\."), F.array(*map(F.lit, labels)))).select(F.col(url).alias("url"))
