import re

import pytest

from tidemark.llm import url_filter
from tidemark.llm.registry import QUERIES


def parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.match(r"[^?#]*", rest[len(host) :])[0]


def rule_of(host, path, rules):
    fits = []
    for verdict, rule in rules:
        h, slash, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith(slash + p):
            fits.append((len(rule), verdict == "allow", rule, verdict))
    return max(fits)[2:] if fits else (None, None)


URLS = [
    None, "", "nothing", "http://", "https://Example.COM/en/7", "http://a.example.com/en/81", "http://notexample.com/en/7", "http://x.net/de/", "http://example.net/de/8?x#y",
    "http://b.example.net/de/9", "http://w.org/es/1", "http://w.org/es", "http://w.org?q=/es/", "ftp://ÄÖ.org/es/#a", "http://com/en/x", "://com/en/", "a://b://com/en/",
]


@pytest.mark.parametrize("few", [100, 0])
def test_rules(spark, few, monkeypatch):
    monkeypatch.setattr(url_filter, "FEW", few)
    df = spark.createDataFrame([(i, u, None) for i, u in enumerate(URLS)], "page_id long, url string, html string")
    for r in url_filter.filter_urls(df, url_filter.RULES).collect():
        host, path = parts(URLS[r.id])
        rule, verdict = rule_of(host, path, url_filter.RULES)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        if verdict:
            assert r.verdict == verdict


def test_decisions_spread(spark):
    pages = [
        (1, "http://bad.com/en/1", None),  # blocked by a rule
        (2, "http://mirror.io/x", '<html><LINK href="http://bad.com/en/1?utm_source=z" rel=canonical></html>'),
        (3, "http://third.io/a/b", "<meta http-equiv='refresh' content='0; url=//mirror.io/x/'>"),
        (4, "https://www.third.io/a/b/?ref=1#t", None),
        (5, "http://third.io/other", '<link rel="canonical" href="/other.html">'),
        (6, "http://moved.io/1", None),
        (7, "http://www.example.com/en/7", None),  # allowed by a rule
        (8, "http://alias.io/7", '<link rel="canonical" href="http://example.com/en/7">'),
        (9, "http://both.io/", '<link rel="canonical" href="http://alias.io/7"><meta http-equiv=refresh content="1;url=http://bad.com/en/2">'),
        (10, "http://points.io/", '<link rel="canonical" href="http://elsewhere.com/en/not-a-page">'),
        (11, "http://rel.io/dir/page", '<link rel="canonical" href="target">'),
        (12, None, '<link rel="canonical" href="http://bad.com/en/1">'),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    moves = spark.createDataFrame([("http://moved.io/1", "http://third.io/a/b"), (None, "http://x.y/z"), ("http://rel.io/dir/target", "http://bad.com/en/1")], "src string, dst string")
    got = {r.id: r.verdict for r in url_filter.filter_urls(df, url_filter.RULES, redirects=moves).collect()}
    # 9 links an allowed and a blocked group: one component, in which allow comes first, but for the rule's own pages
    assert got == {1: "block", 2: "block", 3: "block", 4: "block", 5: "allow", 6: "block", 7: "allow", 8: "allow", 9: "allow", 10: "block", 11: "block", 12: "allow"}


def test_empty_and_repeats(spark):
    df = spark.createDataFrame([(1, "http://a.com/en/", "x")] * 3, "page_id long, url string, html string")
    assert [r.verdict for r in url_filter.filter_urls(df, url_filter.RULES).collect()] == ["block"] * 3
    assert url_filter.filter_urls(df.limit(0), url_filter.RULES).count() == 0


def test_query_on_all_pages(spark, sf):
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url").collect()}
    got = QUERIES["op2_url_filter"](spark, sf).collect()
    assert sorted(r.page_id for r in got) == sorted(urls)
    for r in got:
        rule, verdict = rule_of(*parts(urls[r.page_id]), url_filter.RULES)
        assert (r.host, r.path) == parts(urls[r.page_id]) and r.rule == rule and r.verdict == (verdict or r.verdict)


def test_without_spelling_only_links_join_pages(spark):
    rows = [(1, "http://bad.com/en/1", None), (2, "http://a.io/x", '<link rel=canonical href="http://bad.com/en/1">'), (3, "http://www.a.io/x", None), (4, "http://a.io/x", None)]
    # columns with names of our own are ignored
    df = spark.createDataFrame([(*r, "c", "k", 1, "v") for r in rows], "page_id long, url string, html string, component string, key string, id int, host string")
    for spelling, want in ((True, ["block"] * 4), (False, ["block", "block", "allow", "block"])):
        got = url_filter.filter_urls(df, url_filter.RULES, spelling=spelling).orderBy("id").collect()
        assert [r.verdict for r in got] == want and [r.id for r in got] == [1, 2, 3, 4]
