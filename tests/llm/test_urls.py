import pytest
from compare import connect, differences, duckdb_rows, spark_rows
from conftest import SF_DIR
from pyspark.sql import functions as F

from tradewatch.llm import urls
from tradewatch.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    found = spark_rows(QUERIES[name](spark, SF_DIR))
    assert differences(found, duckdb_rows(connect(SF_DIR), ORACLES[name])) is None


CASES = [
    ("http://A.Example.NET/en/x", "a.example.net", "/en/x", "example.net/en/", "allow"),
    ("http://example.net/de/", "example.net", "/de/", "net/", "block"),
    ("https://badexample.net/en/", "badexample.net", "/en/", "net/", "block"),
    ("http://x.net", "x.net", "", None, "allow"),
    ("http://x.net?a=/en/", "x.net", "", None, "allow"),
    ("ftp://example.com/de/a?b#c", "example.com", "/de/a", "example.com/de/", "block"),
    ("http://example.com/De/", "example.com", "/De/", None, "allow"),
    ("http://q.org/fr/?x://y", "q.org", "/fr/", "org/fr/", "allow"),
    ("no scheme", "", "", None, "allow"),
    ("://h/p", "h", "/p", None, "allow"),
    ("http://É.Example.org/\n/x?y", "É.example.org", "/\n/x", None, "allow"),
    (None, "", "", None, "allow"),
    ("", "", "", None, "allow"),
    ("http://spam.com/a/?utm_source=x&b=2&a=1#top", "spam.com", "/a/", None, "block"),
    ("https://www.spam.com:443/a?a=1&b=2&ref=q", "www.spam.com:443", "/a", None, "block"),
    ("https://spam.com/a?a=1", "spam.com", "/a", None, "allow"),
]


def test_cases(spark):
    rows = [(i, c[0], None, "r") for i, c in enumerate(CASES)] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, rule string")
    listed = spark.createDataFrame([("spam.com/a?a=1&b=2",), (None,)], "canonical string")
    found = urls.judge(pages, listed).collect()
    expected = [(i, *c[1:]) for i, c in enumerate(CASES)] * 2
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected))


def test_filter_keeps_every_listed_url_and_drops_most_others(spark):
    listed = spark.range(5000).select(F.concat(F.lit("h/"), "id").alias("canonical"))
    table, blocks = urls.bloom_blocks(listed)
    assert blocks == 512 and table.count() <= blocks

    def passing(keys):
        block, bits = urls._block_and_bits(F.col("canonical"), blocks)
        hit = F.col("w0").isNotNull()
        for i, bit in enumerate(bits):
            hit = hit & (F.col(f"w{i}").bitwiseAND(bit) != 0)
        return keys.withColumn("block", block).join(table, "block").filter(hit).count()

    assert passing(listed) == 5000
    others = spark.range(20_000).select(F.concat(F.lit("other/"), "id").alias("canonical"))
    assert passing(others) < 200


def test_full_filter_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(urls, "MAX_BLOCKS", 1)
    pages = spark.range(300).select(
        F.col("id").alias("page_id"), F.concat(F.lit("http://h/"), "id").alias("url")
    )
    listed = spark.range(100).select(F.concat(F.lit("h/"), "id").alias("canonical"))
    assert urls.judge(pages, listed).filter("verdict = 'block'").count() == 100
    assert urls.judge(pages, listed.filter("false")).filter("verdict = 'block'").count() == 0
    assert urls.judge(pages.filter("false"), listed).count() == 0
