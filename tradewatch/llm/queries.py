"""The operators of this subpackage as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewatch.llm import (
    bpe,
    byte_bpe,
    decontam,
    licences,
    neighbours,
    pii,
    quality,
    repeats,
    sharding,
    simhash,
    spelling,
    urls,
    whitening,
)
from tradewatch.llm.scratch import ship_package

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(build: Query) -> Query:
    """Register under the function's name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return build(spark, sf_dir)

    QUERIES[build.__name__] = run
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every document, learned from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    scored = quality.classify(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


@query
def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and class of near copies of every document."""
    found = simhash.near_copies(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


@query
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and discovered spans of personal data of every document."""
    found = pii.find(table(spark, sf_dir, "documents"))
    counts = [pii.count_of("base", kind).alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"),
        pii.listed(F.col("spans")).alias("spans"),
    )


@query
def op9_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the token ids of every document and of the text they decode to."""
    return bpe.digests(spark, table(spark, sf_dir, "documents"), bpe.default_path())


@query
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a copy of a benchmark item, with the item and the place."""
    found = decontam.matches(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.select("doc_id", "item_id", "score", "start", "end")


@query
def op1_kk_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of nearly equal bytes, equal texts together."""
    placed = sharding.shard(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


# Hosts with one of these labels make up the list of canonical URLs.
LISTED_HOSTS = r"(?:^|\.)(?:casino-win|cheap-pills|free-bets|ads-track)\."


@query
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the URL of every page; listed are all canonical URLs of known unwanted hosts."""
    pages = table(spark, sf_dir, "pages")
    listed = pages.filter(urls.host(F.col("url")).rlike(LISTED_HOSTS)).select(
        urls.canonical(F.col("url")).alias("canonical")
    )
    return urls.judge(pages, listed)


ORACLES["op6_url_filter"] = rf"""
WITH cut AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?', 2), '') AS path,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?', 3), '') AS query
  FROM pages
), named AS (
  SELECT page_id, host, path,
    CASE WHEN n <> '' THEN n || regexp_replace(path, '/+$', '')
      || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END END AS canonical
  FROM (
    SELECT *, regexp_replace(regexp_replace(host, '^www\.', ''), ':(?:80|443)$', '') AS n,
      list_sort(list_filter(string_split(query, '&'),
        lambda p: p <> '' AND NOT regexp_matches(p, '^(?:utm_[a-z]+|ref)(?:=|$)'))) AS kept
    FROM cut)
), listed AS (
  SELECT DISTINCT canonical FROM named
  WHERE canonical IS NOT NULL AND regexp_matches(host, '{LISTED_HOSTS}')
), ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM named
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
    WHEN rule IS NOT NULL THEN 'allow'
    WHEN canonical IN (SELECT canonical FROM listed) THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""


@query
def op7_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth vector."""
    return neighbours.search(table(spark, sf_dir, "embeddings"))


@query
def op4_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without strings of 100 bytes that start earlier."""
    return repeats.digests(table(spark, sf_dir, "documents"))


@query
def op3_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licence of every document, its own or that of the nearest directory above it.

    The table has no paths; documents are filed by source and language, a thousand to a directory.
    """
    docs = table(spark, sf_dir, "documents")
    shelf = F.floor(F.col("doc_id") / 1000).cast("string")
    path = F.concat_ws("/", "source", "lang", shelf, F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    found = licences.scan(docs.withColumn("path", path))
    return found.withColumn("cosine", F.round("cosine", 6))


@query
def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the rank-file ids of every document and of the bytes they decode to."""
    docs = table(spark, sf_dir, "documents")
    return byte_bpe.digests(spark, docs, byte_bpe.default_path(), byte_bpe.default_pattern())


@query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the four components of largest variance, at unit variance."""
    found = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return found.select(
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"
    )


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequent words of all documents with their commoner forms at one edit."""
    found = spelling.variants(table(spark, sf_dir, "documents"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")
