import pytest

from shelfgap.llm import urls
from shelfgap.llm.oracles import ORACLES
from shelfgap.llm.queries import QUERIES, URL_RULES
from tests.compare import open_tables, spark_rows, sql_rows

RULES = [*URL_RULES, ("block", "evil.net", "/"), ("allow", "evil.net", "/good/"), ("block", "t.io", "/")]

CASES = [  # page_id, url, html, host, path, rule, verdict
    (1, "http://A.Example.ORG/es/x?q#f", None, "a.example.org", "/es/x", "example.org/es/", "block"),
    (2, "https://example.org/en/17", "", "example.org", "/en/17", "example.org/en/1", "block"),
    (3, "https://notexample.org/es/", "", "notexample.org", "/es/", "org/", "allow"),
    (4, "https://x.com/de/", "", "x.com", "/de/", "com/de/", "block"),
    (5, "https://x.com/fr/", "", "x.com", "/fr/", "com/fr/", "allow"),
    (6, "https://x.com?q=/de/", "", "x.com", "", None, "allow"),
    (7, None, "<link rel=canonical href='http://evil.net/'>", "", "", None, "allow"),
    (8, "no scheme", "", "", "", None, "allow"),
    (9, "http://evil.net/a", "", "evil.net", "/a", "evil.net/", "block"),
    (10, "http://alias.net/1", '<link href="//www.evil.net/a.html#x" rel="canonical">', "alias.net", "/1", None, "block"),
    (11, "http://alias.net/2", '<META HTTP-EQUIV=refresh content="0; url=http://alias.net/1">', "alias.net", "/2", None, "block"),
    (12, "http://alias.net/3/?utm_source=a", '<link rel="canonical" href="/2">', "alias.net", "/3/", None, "block"),
    (13, "https://www.alias.net/3", "", "www.alias.net", "/3", None, "block"),
    (14, "http://both.net/1", '<link rel="canonical" href="http://evil.net/b">', "both.net", "/1", None, "allow"),
    (15, "http://both.net/2", '<link rel="canonical" href="http://both.net/1">', "both.net", "/2", None, "allow"),
    (16, "http://evil.net/good/1", '<link rel="canonical" href="http://both.net/2">', "evil.net", "/good/1", "evil.net/good/", "allow"),
    (17, "http://evil.net/b", "", "evil.net", "/b", "evil.net/", "block"),
    (18, "http://other.net/", '<link rel="stylesheet" href="http://evil.net/a">', "other.net", "/", None, "allow"),
    (19, "http://gone.net/", '<link rel="canonical" href="http://t.io/gone">', "gone.net", "/", None, "block"),
    (9, "http://evil.net/a", "", "evil.net", "/a", "evil.net/", "block"),
    (20, "http://q.net/d/p", '<link rel="canonical" href="?a=1">', "q.net", "/d/p", None, "block"),
    (21, "http://q.net/d/p?a=1", '<link rel="canonical" href="http://evil.net/a">', "q.net", "/d/p", None, "block"),
    (22, "http://q.net/d/r", '<link rel="canonical" href="#a">', "q.net", "/d/r", None, "allow"),
    (23, "http://q.net/d/", '<link rel="canonical" href="http://evil.net/a">', "q.net", "/d/", None, "block"),
    (24, "http://" + "a." * 20_000 + "evil.net/z", "", "a." * 20_000 + "evil.net", "/z", "evil.net/", "block"),
    (25, "http://" + "." * 5_000 + "/", "", "." * 5_000, "/", None, "allow"),
    (None, "x://://y", "", ":", "//y", None, "allow"),
]


def test_verdicts(spark):
    data = [(*c[:3], "clash", "clash") for c in CASES]
    pages = spark.createDataFrame(data, "page_id long, url string, html string, class string, node string")
    got = sorted(map(tuple, urls.judge_pages(pages.repartition(3), urls.rules_table(spark, RULES)).collect()), key=str)
    assert got == sorted(((c[0], *c[3:]) for c in CASES), key=str)


def test_hostless_and_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert urls.judge_pages(pages, urls.rules_table(spark, RULES)).count() == 0


def test_no_rules_and_rules_without_a_host(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c", None), (2, None, None)], "page_id long, url string, html string")
    none = urls.rules_table(spark, [("block", None, "/"), ("block", "b", None)])
    assert {r.verdict for r in urls.judge_pages(pages, none).collect()} == {"allow"}


@pytest.mark.parametrize("a, b", [
    ("http://www.a.b/x.html", "https://A.b:443/x#top"),
    ("http://a.b/x/?utm_source=q&ref=2", "http://m.a.b/x"),
    ("http://a.b/x?p=1&gclid=3&q=2", "http://a.b/x/?p=1&q=2"),
])
def test_spellings_of_one_page(spark, a, b):
    from pyspark.sql import functions as F

    row = spark.range(1).select(urls.canonical_key(F.lit(a)).alias("a"), urls.canonical_key(F.lit(b)).alias("b")).first()
    assert row.a == row.b


def test_query_equals_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    got = spark_rows(QUERIES["op10_url_verdicts"](spark, sf_dir))
    assert got == sql_rows(open_tables(sf_dir), ORACLES["op10_url_verdicts"])
