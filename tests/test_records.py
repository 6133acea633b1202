"""Hand-written pages, for what the given pages do not contain."""

import time

import pytest
from pyspark.sql import functions as F

from pagelake.operators.attempts import ok_only
from pagelake.operators.links import catalogue_rules
from pagelake.operators.markup import Page, anywhere, child
from pagelake.operators.records import (
    BOOK_SCHEMA,
    extract_records,
    rejects_as_requests,
    split_valid,
)
from pagelake.plans.crawl import page_records


def info(*lines, author="<a href='/author/1'>First &amp; Author</a>"):
    spans = "".join(f"<span class='pl'>key</span>\n {line} <br>" for line in lines)
    return f'<div id="info" class="">{author}{spans}</div>'


def page(name="A Book", body="", intros=()):
    sections = "".join(f'<div class="intro">{i}</div>' for i in intros)
    return f"""<!DOCTYPE html><html><head><title>t</title>
    <script>var x = '<div class="intro"><p>no</p></div>';</script></head><body>
    <h1><span property="v">{name}</span></h1>
    <div class="subject clearfix"><div id="mainpic"><a class="nbg" href="/c?a=1&amp;b=2">
    <img src="x.jpg"></a></div>{body}</div>
    <div class="rating_self clearfix"><strong class="ll"> 8.5 </strong>
    <div class="rating_sum"><span><a href="c"><span>1234</span> votes</a></span></div></div>
    <!-- <div class="intro"><p>hidden</p></div> -->
    {sections}
    <div class="blank20"><div class="indent"><span><a href="/tag/x">novel</a></span>
    <span><a href="/tag/y">long</a></span></div></div></body></html>"""


SEVEN = ["House", "Sub", "2001-1", "300", "20.00", "Paper", "97801"]
PAGES = [
    ("full", 200, page(body=info(*SEVEN), intros=["<p>One</p><p>Two</p>", "<p>Who</p>"])),
    ("second", 200, page(body=info(*SEVEN[:6],
        author="<span><b>by</b><a>Second</a><a>Other</a></span>"))),
    ("five", 200, page(body=info(*SEVEN[:5]))),
    ("six", 200, page(body=info(*SEVEN[:6]))),
    ("eight", 200, page(body=info("P", "a", "b", *SEVEN[2:]))),
    ("nine", 200, page(body=info(*"123456789"))),
    ("one-intro", 200, page(intros=["<p>Only<b>bold</b>tail</p><div><p>deep</p></div>"])),
    ("nameless", 200, page(name="")),
    ("empty", 200, "<html><body>nothing</body>"),
    ("null", 200, None),
    ("blank-name", 200, page(name=" ")),
    ("failed", 503, page()),
]


@pytest.fixture(scope="module")
def records(spark):
    rows = [(i, f"http://b.example/{u}/", s, h) for i, (u, s, h) in enumerate(PAGES)]
    df = spark.createDataFrame(rows, "page_id long, url string, status int, html string")
    out = extract_records(ok_only(df))
    assert out.schema.simpleString() == BOOK_SCHEMA.simpleString()
    return {r["book_link"].split("/")[-2]: r for r in out.collect()}


def test_not_ok_is_left_out(records):
    assert set(records) == {u for u, s, _ in PAGES if s == 200}


def test_full_record(records):
    assert records["full"].asDict() == {
        "book_type": ["novel", "long"],
        "book_cover_url": "/c?a=1&b=2",
        "book_name": "A Book",
        "book_author": "First & Author",
        "book_link": "http://b.example/full/",
        "book_publisher": "House",
        "book_publish_time": "2001-1",
        "book_pages_num": "300",
        "book_price": "20.00",
        "book_rating": " 8.5 ",
        "book_comment_num": "1234",
        "book_abstract": "One\nTwo\n",
        "book_author_abstract": "Who\n",
        "book_info": SEVEN,
    }


def test_author_fallback_takes_first_link_of_each_span(records):
    assert records["second"]["book_author"] == "Second"


@pytest.mark.parametrize("which, want", [
    ("five", ("", "", "", "")),
    ("six", ("House", "Sub", "2001-1", "300")),
    ("eight", ("P", "2001-1", "300", "20.00")),
    ("nine", ("", "", "", "")),
])
def test_layouts(records, which, want):
    r = records[which]
    got = (r.book_publisher, r.book_publish_time, r.book_pages_num, r.book_price)
    assert got == want


def test_only_direct_text_of_direct_paragraphs(records):
    assert records["one-intro"]["book_abstract"] == "Only\ntail\n"
    assert records["one-intro"]["book_author_abstract"] == ""


def test_null_and_empty_are_kept_apart(records):
    r = records["empty"]
    assert r.book_type == [] and r.book_info == [] and r.book_abstract == ""
    assert r.book_name is None and r.book_rating is None and r.book_author is None
    assert records["null"].book_name is None


def test_split_valid(spark, records):
    df = spark.createDataFrame(list(records.values()), BOOK_SCHEMA)
    valid, rejected = split_valid(df)
    names = {r.book_link.split("/")[-2] for r in rejected.collect()}
    # A blank is a name; an element without text gives none at all.
    assert names == {"nameless", "empty", "null"}
    assert valid.count() + rejected.count() == df.count()
    again = rejects_as_requests(rejected).collect()
    assert all(r.dont_filter and r.reason == "no name" for r in again)


def test_page_records_parses_only_claimed_pages(spark):
    rows = [(1, "http://b.example/subject/7/", page()), (2, "http://b.example/x", page())]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = page_records(df, catalogue_rules("b.example")).collect()
    assert [r.book_link for r in got] == ["http://b.example/subject/7/"]


def texts(html, *path):
    return [t for n in Page(html).select(path) for t in n.texts]


@pytest.mark.parametrize("html, path, want", [
    ("<p>a<p>b", (anywhere("p"),), ["a", "b"]),
    ("<p><b>x<br><p>y</p>", (anywhere("p"),), ["y"]),
    ("<ul><li>a<li>b<ul><li>c</ul></ul>", (anywhere("li"),), ["a", "b", "c"]),
    ("<ul><li>a<li>b</ul>", (anywhere("ul"), child("li", nth=2)), ["b"]),
    ("<div>a<!-- c -->b<i>c</i>d</div>", (anywhere("div"),), ["a", "b", "d"]),
    ("<div>a &lt; b < c</div>", (anywhere("div"),), ["a < b < c"]),
    ("<div class=x>1</div><div class='x y'>2</div>", (anywhere("div", class_="x"),), ["1"]),
    ("<DIV ID=q>1</DIV>", (anywhere("div", id="q"),), ["1"]),
    ("<div title='a>b'>1</div>", (anywhere("div"),), ["1"]),
    ("<div>1</span></div>2", (anywhere("div"),), ["1"]),
    ("<table><tr><td>1<td>2<tr><td>3</table>", (anywhere("td"),), ["1", "2", "3"]),
    ("<div><div>in</div>out</div>", (anywhere("div"),), ["out", "in"]),
    ("<script>'<p>no'</script><p>yes", (anywhere("p"),), ["yes"]),
    ("<p>cut <a hre", (anywhere("p"),), ["cut "]),
    ("<p>cut &amp", (anywhere("p"),), ["cut &"]),
    ("<div/>x<p>y</p>", (anywhere("p"),), ["y"]),
    ("<a href=/x/>in</a>out", (anywhere("a"),), ["in"]),
    ("<div><a>1</a><b>n</b><a>2</a></div><div><a>3</a></div>",
     (anywhere("div"), child("a", nth=1)), ["1", "3"]),
])
def test_lenient_markup(html, path, want):
    assert texts(html, *path) == want


def test_filter_is_below_the_python_node(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    out = extract_records(df.filter(F.col("page_id") < 5))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("ArrowEvalPython") < plan.index("PushedFilters: [IsNotNull(page_id)")
    assert plan.count("ArrowEvalPython") == 1


@pytest.mark.parametrize("depth", [10, 600, 5000])
def test_deep_pages_keep_direct_text(depth):
    html = "<div>" * depth + "<p>one<b>two</b>three</p>" + "</div>" * depth
    (p,) = Page(html).select((anywhere("p"),))
    assert p.texts == ["one", "three"]


def test_many_siblings_and_nested_roots_take_linear_time():
    start = time.perf_counter()
    wide = Page("<div>" + "<a>x</a>" * 100_000 + "</div>")
    assert len(wide.select((anywhere("div"), child("a", nth=99_999)))) == 1
    deep = Page("<div>" * 4000 + "<a>x</a>" + "</div>" * 4000)
    assert len(deep.select((anywhere("div"), anywhere("a")))) == 1
    assert time.perf_counter() - start < 10
