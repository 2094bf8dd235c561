"""Urls that hold a second ``://`` after their host."""

from pyspark.sql import functions as F

from airseries.llm import url_filter

CASES = [
    ("https://example.com?next=https://other.org/en/x", "example.com", "", "allow"),
    ("https://Example.com#see://other.org/en/x", "example.com", "", "allow"),
    ("https://example.com/en/a?next=https://other.org/fr/x", "example.com", "/en/a", "block"),
    ("https://example.com/fr/https://other.org/en/x?q", "example.com", "/fr/https://other.org/en/x", "allow"),
    ("http://a\n?b://c/en/\n", "a\n", "", "allow"),
    ("http://a.net/es/\nx?y", "a.net", "/es/\nx", "block"),
    ("http://", "", "", "allow"),
    ("no scheme/en/", "", "", "allow"),
    (None, "", "", "allow"),
]


def test_second_scheme_is_no_cut(spark):
    pages = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "page_id long, url string")
    rules = url_filter.rules_frame(spark, url_filter.PAGE_RULES)
    got = url_filter.judge_urls(pages, rules).orderBy("page_id")
    assert [tuple(r) for r in got.select("url", "host", "path", "verdict").collect()] == CASES
    assert got.where(F.col("host").isNull() | F.col("path").isNull()).isEmpty()
