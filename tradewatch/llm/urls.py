"""Verdicts on URLs: rules for hosts and paths, then a list of canonical URLs.

The longest rule that fits decides. For other URLs a blocked Bloom filter of the listed canonical
URLs is asked: each URL hashes to one block of eight words and to one bit in each of them. A URL
whose bits are not all set is not listed. The rest, the listed ones and a few by chance, go to an
exact hash join, which decides. The filter has a bounded number of blocks and is broadcast; when the
list outgrows it, more URLs reach the exact join, and results stay the same.

Defined results: a null URL, or one without ://, has an empty host and path, fits no rule and is not
listed; rules of equal length are taken in alphabetical order; repeated rows stay repeated; an empty
list allows what no rule blocks.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 8
BITS_PER_URL = 16
MAX_BLOCKS = 1 << 18  # of 256 bits: 8 MB of bits


class Rule(NamedTuple):
    """verdict for a host with its subdomains and paths that start with path."""

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
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?"
# Query parameters that do not tell pages apart.
TRACKING = r"^(?:utm_[a-z]+|ref)(?:=|$)"


def host(url: Column) -> Column:
    part = F.translate(F.regexp_extract(url, _PARTS, 1), UPPER, LOWER)
    return F.coalesce(part, F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def canonical(url: Column) -> Column:
    """Host and path with the telling query parameters in order; null without a host.

    Scheme, leading www., default ports, closing slashes, tracking parameters and fragments go.
    """
    name = F.regexp_replace(F.regexp_replace(host(url), r"^www\.", ""), r":(?:80|443)$", "")
    query = F.coalesce(F.regexp_extract(url, _PARTS, 3), F.lit(""))
    kept = F.array_sort(
        F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING))
    )
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    whole = F.concat(name, F.regexp_replace(path(url), "/+$", ""), tail)
    return F.when(name != "", whole)


def rule_of(host_: Column, path_: Column, rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, null without one."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (-len(r.name), r.name), reverse=True):
        fits = ((host_ == rule.host) | host_.endswith("." + rule.host)) & path_.startswith(rule.path)
        name = F.when(fits, rule.name).otherwise(name)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def _block_and_bits(key: Column, blocks: int) -> tuple[Column, list[Column]]:
    """Block of a key and one bit for each word of the block."""
    wide = F.xxhash64(key)
    block = F.pmod(wide, F.lit(blocks))
    bits = []
    other = F.xxhash64(key, F.lit("bits"))
    for word in range(WORDS):
        place = F.shiftrightunsigned(other, 5 * word).bitwiseAND(F.lit(31)).cast("int")
        bits.append(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return block, bits


def bloom_blocks(listed: DataFrame, key: str = "canonical") -> tuple[DataFrame, int]:
    """The blocked filter of a column: block, w0 .. w7; and the number of blocks."""
    count = listed.count()
    blocks = 1
    while blocks < MAX_BLOCKS and blocks * 32 * WORDS < count * BITS_PER_URL:
        blocks *= 2
    block, bits = _block_and_bits(F.col(key), blocks)
    table = (
        listed.select(block.alias("block"), *[b.alias(f"b{i}") for i, b in enumerate(bits)])
        .groupBy("block")
        .agg(*[F.bit_or(f"b{i}").alias(f"w{i}") for i in range(WORDS)])
    )
    return table, blocks


def judge(pages: DataFrame, listed: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """page_id, host, path, rule and verdict of every row. listed: canonical URLs to block."""
    listed = listed.select("canonical").filter("canonical is not null").distinct()
    url = F.col("url")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    ruled = (
        pages.select("page_id", host(url).alias("host"), path(url).alias("path"), canonical(url).alias("canonical"))
        .withColumn("rule", rule)
        .withColumn("verdict", verdict)
    )
    table, blocks = bloom_blocks(listed)
    block, bits = _block_and_bits(F.col("canonical"), blocks)
    hit = F.col("w0").isNotNull()
    for word, bit in enumerate(bits):
        hit = hit & (F.col(f"w{word}").bitwiseAND(bit) != 0)
    # At most MAX_BLOCKS rows of nine longs.
    asked = ruled.withColumn("block", block).join(F.broadcast(table), "block", "left")
    asked = asked.withColumn(
        "possible", F.col("verdict").isNull() & F.col("canonical").isNotNull() & F.coalesce(hit, F.lit(False))
    )
    columns = ["page_id", "host", "path", "rule", "verdict"]
    sure = asked.filter("not possible").withColumn("verdict", F.coalesce("verdict", F.lit("allow")))
    exact = listed.withColumn("found", F.lit(True)).hint("shuffle_hash")
    checked = (
        asked.filter("possible")
        .join(exact, "canonical", "left")
        .withColumn("verdict", F.when(F.col("found"), "block").otherwise("allow"))
    )
    return sure.select(columns).unionByName(checked.select(columns))
