"""URL rules against a plain loop over all rules."""

import pytest

from custodia.llm.queries import QUERIES, URL_RULES, url_rules
from custodia.llm.url_filter import judge_urls
from tests.llm.helpers import clashing

URLS = [
    None, "", "no scheme", "http://", "http://org", "http://Example.ORG/es/x?y#z", "https://a.b.example.org/en/123",
    "https://example.org/en/2", "http://notexample.org/es/", "http://x.com/fr/1", "http://x.com/fr", "http://com/de/",
    "ftp://x.com?de=/de/", "http://x.com#/de/", "http://x.com:80/de/", "http://x.net/de/", "http://..org/", "http://org./",
    "a://b://example.org/es/", "http://example.org/es/" + "p/" * 5000, "http://" + "a." * 3000 + "org/", "HTTP://Ä.ORG/",
]


def parsed(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    tail = rest[end:]
    stop = min([tail.find(c) for c in "?#" if c in tail], default=len(tail))
    host = "".join(c.lower() if c.isascii() else c for c in rest[:end])
    return host, tail[:stop]


def judged(url, rules, default="allow"):
    host, path = parsed(url)
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    if not fits:
        return host, path, None, default
    best = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0]), r[2]))
    return host, path, best[0] + best[1], best[2]


def compare(spark, urls, rules, **more):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    frame = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = judge_urls(clashing(pages, "host", "path", "level", "rule"), frame, **more).collect()
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got} == {
        i: judged(u, rules, more.get("default", "allow")) for i, u in enumerate(urls)
    }
    assert len(got) == len(urls)


def test_awkward_urls(spark):
    compare(spark, URLS + URLS, list(URL_RULES), spread=3)


def test_nested_rules(spark):
    rules = [("org", "/a", "allow"), ("org", "/a/b", "block"), ("org", "/a/b/c", "allow"), ("x.org", "/a", "block"),
             ("y.x.org", "", "allow"), ("org", "", "block"), ("org", "/a/b", "allow")]
    urls = [f"http://{h}{p}" for h in ("org", "x.org", "y.x.org", "z.y.x.org", "zx.org") for p in
            ("", "/", "/a", "/a/b", "/a/b/cc", "/a/bb", "/a/c", "/b")]
    kept = [r for r in rules if r != ("org", "/a/b", "allow")]
    compare(spark, urls, kept, spread=2, default="block")
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    both = judge_urls(pages, spark.createDataFrame(rules, "host string, path string, verdict string"), default="block")
    assert {r.page_id: r.verdict for r in both.collect()} == {i: judged(u, kept, "block")[3] for i, u in enumerate(urls)}


def test_empty_tables(spark):
    nothing = spark.createDataFrame([], "page_id long, url string")
    assert judge_urls(nothing, url_rules(spark)).count() == 0
    none = spark.createDataFrame([], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    assert [tuple(r) for r in judge_urls(pages, none).collect()] == [(1, "a.org", "/", None, "allow")]


@pytest.mark.parametrize("name", ["op5_url_range_join"])
def test_table(spark, base, name):
    pages = spark.read.parquet(f"{base}/pages.parquet").collect()
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in QUERIES[name](spark, base).collect()}
    assert got == {p.page_id: judged(p.url, URL_RULES) for p in pages}
