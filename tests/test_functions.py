"""Column functions on small hand-made cases."""

import pytest
from pyspark.sql import functions as F

from siftloom.functions import cleaning, urls
from siftloom.functions.signals import term_pattern, unusable
from siftloom.sources import readers


def one(spark, col, *values):
    kinds = ", ".join(f"c{i} string" for i in range(len(values)))
    return spark.createDataFrame([values], kinds).select(col.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "url, want",
    [
        ("  HTTP://User:p@Example.COM:80/a/./b/../c/?utm_source=x&b=2&a=1&b=2#top ", "http://example.com/a/c/?b=2&a=1&b=2#top"),
        ("https://example.com", "https://example.com/"),
        ("https://example.com:8443//a//b/", "https://example.com:8443/a/b/"),
        ("https://example.com/%7euser/%e4%2f?a&q=x+y", "https://example.com/~user/%E4%2F?a=&q=x%20y"),
        ("https://example.com/a/..", "https://example.com/"),
        ("ftp://example.com/", None),
        ("https:///x", None),
        ("https://example.com:port/", None),
        ("https://example.com:99999/", None),
        ("mailto:x@example.com", None),
        (None, None),
        ("", None),
    ],
)
def test_canonical(spark, url, want):
    assert one(spark, urls.canonical(F.col("c0")), url) == want


def test_canonical_is_idempotent(spark):
    for u in ("https://Example.com/A%2fb/?q=%7E*'()&x", "http://a.b.c/../d?x=1&&y"):
        c = one(spark, urls.canonical(F.col("c0")), u)
        assert one(spark, urls.canonical(F.col("c0")), c) == c


def test_fragment_of_routes_stays(spark):
    c = urls.canonical(F.col("c0"), drop_fragment=F.lit(True))
    assert one(spark, c, "https://a.com/#top") == "https://a.com/"
    for f in ("#!/x", "#/x", "#?x"):
        assert one(spark, c, f"https://a.com/{f}").endswith(f)


def test_repository_root(spark):
    r = urls.repository_root(F.col("c0"))
    assert one(spark, r, "https://github.com/Some/Repo.git") == "some/repo"
    assert one(spark, r, "https://github.com/topics/spark") is None
    assert one(spark, r, "https://github.com/a/b/issues") is None


def test_suspicion(spark):
    s = urls.suspicion(F.col("c0"))
    cases = {"https://search.a.com/x": "search_host", "https://a.com/search": "search_path", "https://a.com/x?Q=1": "search_path", "https://a.com/feed/": "feed", "https://a.com/tag/x": "index", "https://a.com/x/page/3": "index", "https://a.com/research": None, "https://a.com/": None}
    assert {u: one(spark, s, u) for u in cases} == cases


@pytest.mark.parametrize(
    "text, want",
    [
        ("Tue, 02 Jan 2024 03:04:05 GMT", "2024-01-02T03:04:05Z"),
        ("Tue, 2 Jan 2024 03:04:05 +0200", "2024-01-02T01:04:05Z"),
        ("2024-01-02T03:04:05Z", "2024-01-02T03:04:05Z"),
        ("2024-01-02T03:04:05.250+01:00", "2024-01-02T02:04:05Z"),
        ("2024-01-02", "2024-01-02T00:00:00Z"),
        ("January 2, 2024", "2024-01-02T00:00:00Z"),
        ("soon", None),
        (None, None),
    ],
)
def test_dates(spark, text, want):
    assert one(spark, cleaning.utc_text(cleaning.utc_time(F.col("c0"))), text) == want


def test_slugs_and_keys(spark):
    s = cleaning.slug(F.col("c0"))
    assert one(spark, s, " Crème & Brûlée — №1 ") == "creme-and-brulee-no1"
    assert one(spark, s, "!!!") is None
    assert one(spark, s, "ab " * 100) is None and one(spark, s, "ab " * 40) == "ab-" * 39 + "ab"
    assert one(spark, cleaning.ascii_key(F.col("c0")), "  ÄB  Cd ") == "Äb cd"
    assert one(spark, cleaning.folded(F.col("c0")), " Straße\tﬁ ") == "strasse fi"
    assert one(spark, cleaning.known(F.col("c0")), " UNKNOWN ") is None
    assert one(spark, cleaning.cell_parts(F.col("c0"))["topic"], "a__b") == "a"
    assert one(spark, cleaning.cell_parts(F.col("c0")), "a__b__c") is None


def test_terms(spark):
    import re

    ok = lambda t, x: one(spark, F.col("c0").rlike(term_pattern(t)), x)
    assert ok("large model", "A LARGE, model!") and not ok("large model", "large models")
    assert ok("large model*", "large models") and not ok("été", "étés") and ok("été", "Été.")
    assert unusable(["%", "$", "a"]) == ["%", "$"]
    assert re  # the module is only for reading the patterns


def test_feeds_and_json(spark):
    rss = "<rss><channel><title>no</title><item><title><![CDATA[A &amp; B]]></title><link>https://a.com/1</link><pubDate>d</pubDate></item><item><title>x</title></item><item><guid>https://a.com/2</guid></item></channel></rss>"
    got = [(r["position"], r["target_url"], r["title"]) for r in readers.feed_items(spark.createDataFrame([(rss,), (None,), ("junk",)], "b string"), "b").collect()]
    # CDATA is taken as it stands; positions count the items that have an address
    assert got == [(0, "https://a.com/1", "A &amp; B"), (1, "https://a.com/2", None)]
    doc = '{"d": {"items": [{"u": "https://a.com", "t": [{"n": "x"}], "k": 3}, {"t": []}, {"u": true}]}}'
    b = spark.createDataFrame([(doc,), ("{broken",), (None,)], "b string")
    got = readers.json_items(b, "b", "d.items", {"target_url": "u", "title": "t.0.n", "n": "k"}).drop("b").collect()
    assert [tuple(r) for r in got] == [(0, "https://a.com", "x", "3")]


def test_json_recovery():
    assert readers.recovered_json('text ```json\n{"a": "}"}\n``` more {}') == '{"a": "}"}'
    assert readers.recovered_json('{"a":1} {"b":2}') is None
    assert readers.recovered_json("none {broken") is None


def test_html(spark):
    html = '<html><head><link rel="canonical" href="https://a.com/x"></head><body><a href="/p#1">One</a><a href="/p#1">again</a><a href="mailto:x">m</a><link rel="canonical" href="no"></body>'
    p = spark.createDataFrame([(1, "https://a.com/q/", html), (2, None, None)], "k long, u string, h string")
    assert [tuple(r) for r in readers.html_links(p, "k", "u", "h").collect()] == [(1, 0, "https://a.com/p#1", "One")]
    assert [r["c"] for r in p.select(readers.canonical_tags("h").alias("c")).collect()] == [["https://a.com/x"], []]
    md = spark.createDataFrame([("| [a](https://a.com) | x |\n[b](https://b.com)\n|[l](https://c.com/awesome-x)|",)], "b string")
    assert [r["target_url"] for r in readers.markdown_links(md, "b").collect()] == ["https://a.com"]


def test_manifest(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "b.txt").write_bytes(b"x")
    (tmp_path / "a.txt").write_bytes(b"yz")
    (tmp_path / "d" / "none").write_bytes(b"")
    got = [tuple(r)[:2] for r in readers.file_manifest(spark, str(tmp_path)).collect()]
    assert sorted(got) == [("a.txt", 2), ("d/b.txt", 1), ("d/none", 0)]
