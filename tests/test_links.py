import time

import pytest
from pyspark.sql import functions as F

from pagelake.operators.links import (
    LinkRule,
    catalogue_rules,
    dedup_requests,
    extract_links,
    frontier,
    keep_domains,
    new_links,
    route_links,
    union_requests,
    with_fingerprint,
)
from pagelake.operators.markup import Page, anywhere
from pagelake.operators.records import first_text
from pagelake.operators.skew import first_per_key, first_per_key_late
from pagelake.plans.crawl import crawl_rounds, followed_links, next_requests, unseen_links

HOST = "book.example"
HTML = """<html><head><base target="_top"></head><body>
<!-- <a href="/hidden">x</a> --><script>var s = '<a href="/script">';</script>
<a class="t" href="/tag/小说">plain</a>
<a href='/tag/%E5%B0%8F%E8%AF%B4' >escaped</a>
<a href=/subject/12/>unquoted</a>
<a data-href="/wrong" title="a > b" href = " /subject/13/ ">spaces</a>
<A HREF="?start=20&amp;type=T">next</A>
<a href="http://m.book.example/subject/14/">sub</a>
<a href="http://other.example/subject/15/">off</a>
<area href="../up"><a name="x">no href</a><a href="mailto:x@y">mail</a>
<a href="/subject/12/">again</a><a href="">self</a><ahref="/not">
</body></html>"""
URL = f"http://{HOST}/tag/x/y?z=1"


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(1, URL, HTML)], "page_id long, url string, html string")


def links_of(df):
    return [r["link"] for r in df.orderBy("page_id", "pos").collect()]


def test_extract_links(pages):
    h = f"http://{HOST}"
    want = [
        f"{h}/tag/小说", f"{h}/tag/%E5%B0%8F%E8%AF%B4", f"{h}/subject/12/",
        f"{h}/subject/13/", f"{h}/tag/x/y?start=20&type=T",
        "http://m.book.example/subject/14/", "http://other.example/subject/15/",
        f"{h}/tag/up", f"{h}/subject/12/", URL,
    ]
    assert links_of(extract_links(pages)) == want
    assert links_of(extract_links(pages, unique=True)) == [*want[:8], URL]


def test_base_tag(spark):
    html = '<base href="http://b.example/dir/"><a href="x">1</a><a href="/y">2</a>'
    df = spark.createDataFrame([(1, URL, html)], "page_id long, url string, html string")
    assert links_of(extract_links(df)) == ["http://b.example/dir/x", "http://b.example/y"]


def test_pages_without_links_give_no_rows(spark):
    rows = [(1, URL, "<p>x"), (2, URL, None), (3, URL, "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert extract_links(df).count() == 0


HOSTILE = [
    "<a " + "x " * 100_000 + '<a href="/y">' + "<a " * 100_000,
    "<!-- " * 100_000,
    "<script " * 100_000,
    '<a "' * 100_001 + ">",
    '<a "<a" ' * 100_000,
    "<a" + " " * 100_000,
    "<div>" * 20_000 + "<p>" * 1000 + "</div>" * 20_000,
    "&" * 100_000 + "&#" * 100_000,
]


@pytest.mark.parametrize("html", HOSTILE, ids=range(len(HOSTILE)))
def test_broken_pages_take_linear_time(spark, html):
    df = spark.createDataFrame([(1, URL, html)], "page_id long, url string, html string")
    start = time.monotonic()
    extract_links(df).count()
    Page(html).select((anywhere("div"), anywhere("p")))
    assert time.monotonic() - start < 30


def test_route_links(pages):
    links = keep_domains(extract_links(pages, unique=True), [HOST])
    routed = {
        r["link"].removeprefix(f"http://{HOST}"): (r["rule"], r["parse"], r["follow"])
        for r in route_links(links, catalogue_rules(HOST)).collect()
    }
    assert routed == {
        "/tag/小说": ("category", False, True),
        "/tag/%E5%B0%8F%E8%AF%B4": ("category", False, True),
        "/subject/12/": ("detail", True, True),
        "/subject/13/": ("detail", True, True),
        "http://m.book.example/subject/14/": ("detail", True, True),
        "/tag/x/y?start=20&type=T": ("next", False, True),
        "/tag/up": (None, False, False),
        "/tag/x/y?z=1": (None, False, False),
    }


def test_first_rule_claims(spark):
    df = spark.createDataFrame([("http://x.example/ab",)], "link string")
    rules = [LinkRule("a", "/a"), LinkRule("b", "b$", parse=True)]
    assert route_links(df, rules).first()["rule"] == "a"
    assert route_links(df, rules[::-1]).first()["parse"]


def requests(spark, rows):
    return spark.createDataFrame(
        [(i, "http://h.example/" + p, f) for i, p, f in rows],
        "first_seen int, link string, dont_filter boolean",
    )


def test_dedup_requests_takes_the_first_spelling(spark):
    df = requests(spark, [(3, "a?y=1&x=2", None), (1, "a?x=2&y=1#t", None), (2, "b", None)])
    got = dedup_requests(df, ["first_seen"]).orderBy("first_seen").collect()
    assert [r["first_seen"] for r in got] == [1, 2]


def test_new_links(spark):
    df = requests(spark, [(1, "a", None), (2, "b", None), (3, "b", None), (4, "a", True)])
    seen = with_fingerprint(requests(spark, [(0, "a#x", None)])).select("fp")
    fresh = new_links(df, seen, ["first_seen"])
    assert [r["first_seen"] for r in fresh.collect()] == [2]
    forced = new_links(df, seen, ["first_seen"], force="dont_filter")
    assert sorted(r["first_seen"] for r in forced.collect()) == [2, 4]
    # Nothing is new once the result has been seen.
    again = new_links(df, seen.union(fresh.select("fp")), ["first_seen"])
    assert again.count() == 0


def test_union_and_frontier(spark):
    seeds = spark.createDataFrame([("http://h.example/s", 9)], "link string, priority int")
    more = requests(spark, [(2, "b", None), (1, "a", True)])
    both = union_requests(seeds, more)
    assert {(r.priority, r.dont_filter, r.retry_times) for r in both.collect()} == {
        (9, False, 0), (0, False, 0), (0, True, 0)}
    got = [r["link"][-1] for r in frontier(both).collect()]
    assert got == ["s", "a", "b"]
    assert frontier(both, 1).count() == 1
    seen = with_fingerprint(more).select("fp")
    assert [r["link"][-1] for r in next_requests(seen, seeds, more).collect()] == ["s", "a"]


def test_unseen_links_property(spark, pages):
    rules = catalogue_rules(HOST)
    seen = with_fingerprint(followed_links(pages, rules)).select("fp").limit(2)
    fresh = unseen_links(pages, seen, rules)
    assert fresh.join(seen, "fp").count() == 0
    assert fresh.filter(F.col("rule").isNull()).count() == 0


def test_late_rows_are_the_first_rows(spark):
    """Orders that fit one number, in part or not at all; nulls and both ends of a type."""
    low, high = -(1 << 63), (1 << 63) - 1
    rows = [
        (None, 5, "b", 1), (None, 4, "c", 2), ("x", None, "d", 3), ("x", low, "e", 4),
        ("y", high, "f", 5), ("y", 0, "g", 6), ("z", 1, "h", 8), ("z", 1, "a", 7),
    ]
    df = spark.createDataFrame(rows, "k string, a long, s string, n int")
    df = df.withColumn("at", F.timestamp_seconds("n")).withColumn("day", F.to_date("at"))
    for order in (["a", "n"], ["a", "s"], ["s"], ["at"], ["day", "a", "n"], ["day", "s"]):
        want = first_per_key(df, ["k"], order)
        assert sorted(first_per_key_late(df, "k", order).collect(), key=str) == sorted(want.collect(), key=str)
    known = spark.createDataFrame([("x",), ("q",)], "k string")
    got = first_per_key_late(df, "k", ["a", "n"], known).collect()
    assert sorted(str(r.k) for r in got) == ["None", "y", "z"]


def test_pages_that_are_not_followed_give_no_links(spark, pages):
    rules = [LinkRule("all", "/subject/"), LinkRule("tags", "/tag/", follow=False)]
    assert followed_links(pages, rules).collect() == []  # the page itself is a tag page
    assert followed_links(pages, [LinkRule("all", "/subject/")]).count() > 0


def test_failed_pages_are_stored_with_their_status(spark, pages, tmp_path):
    from pagelake.sources.tables import read_pages

    both = pages.withColumn("status", F.lit(200)).union(
        pages.withColumn("page_id", F.lit(2)).withColumn("status", F.lit(500))
    )
    both.write.parquet(str(tmp_path / "p"))
    found = followed_links(read_pages(spark, str(tmp_path / "p")), catalogue_rules(HOST))
    assert {r.page_id for r in found.collect()} == {1}


def test_crawl_rounds(spark):
    """A ring, a page without a name, a failed page and one that is not there."""
    site = {
        "/a": (["/b", "/c", "/a#x"], "A", 200), "/b": (["/a", "/gone"], None, 200),
        "/c": (["/d"], "C", 500), "/d": ([], "D", 200), "/list": (["/a"], None, 200),
    }
    h = f"http://{HOST}"
    rows = []
    for i, (path, (links, name, status)) in enumerate(site.items()):
        html = "".join(f'<a href="{x}">l</a>' for x in links) + (f"<h1>{name}</h1>" if name else "")
        rows.append((i, h + path, html, status))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, status int")
    rules = [LinkRule("page", r"/[abcd]$", parse=True), LinkRule("rest", "/(gone|list)$")]
    seeds = spark.createDataFrame([(h + "/list",), (h + "/list#top",)], "link string")
    picks = [first_text("book_name", (anywhere("h1"),))]
    got = crawl_rounds(seeds, pages, rules, picks=picks)
    assert sorted((r.round, r.link[len(h):], r.times, r.outcome) for r in got.collect()) == [
        (0, "/list", 0, "page"), (1, "/a", 0, "record"),
        (2, "/b", 0, "rejected"), (2, "/c", 0, "missing"),
        (3, "/b", 1, "rejected"), (3, "/c", 1, "missing"), (3, "/gone", 0, "missing"),
        (4, "/b", 2, "rejected"), (4, "/c", 2, "missing"), (4, "/gone", 1, "missing"),
        (5, "/gone", 2, "missing"),
    ]
    assert crawl_rounds(seeds, pages, rules, picks=picks, max_rounds=1).count() == 2
    assert crawl_rounds(seeds.limit(0), pages, rules, picks=picks).count() == 0
