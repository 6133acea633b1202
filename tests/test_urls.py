import html
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from pagelake.functions import text as tx
from pagelake.functions import urls

BASES = [
    "http://h.example/a/b/c?x=1#f",
    "https://h.example",
    "http://h.example/",
    "http://h.example/a/b/",
    "http://u@h.example:81/a",
]
LINKS = [
    "", "/x", "x", "x/y", "./x", "../x", "../../../x", "/a/../b/./c", "?q=2", "#top",
    "//other.example/z", "https://abs.example/p?q#r", "mailto:a@b", "/x?y=/../z",
    "x#../y", "..", ".", "/a/b/..", "a/..", "/.hidden", "/...", "b/./../c?d",
]


def one(spark, values, fn):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    rows = df.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()
    return [r["o"] for r in rows]


@pytest.mark.parametrize("base", BASES)
def test_resolve_url_like_the_standard_library(spark, base):
    got = one(spark, LINKS, lambda v: urls.resolve_url(v, F.lit(base)))
    assert got == [urljoin(base, link) for link in LINKS]


def test_decode_entities_like_the_standard_library(spark):
    values = [
        "plain", "a&amp;b", "a&b", "&lt;&gt;&quot;&#39;&apos;", "&eacute;t&eacute;",
        "&#233;&#xE9;&#x4e2d;&#128512;", "&amp;amp;", "&nosuch;x", "&", "&&amp;",
        "?a=1&amp;b=2&amp;c", "&amp", "&lt", "&copy;", "&#;", "& ;",
    ]
    assert one(spark, values, tx.decode_entities) == [html.unescape(v) for v in values]


def test_decode_entities_leaves_impossible_numbers(spark):
    assert one(spark, ["&#9999999;x", None], tx.decode_entities) == ["&#9999999;x", None]


def test_canonical_url(spark):
    cases = {
        "http://H.Example": "http://h.example/",
        "http://h.example/#top": "http://h.example/",
        "http://h.example/a?b=2&a=1": "http://h.example/a?a=1&b=2",
        "http://h.example/a?a=2&a=1&a=10": "http://h.example/a?a=1&a=10&a=2",
        "http://h.example/a?": "http://h.example/a",
        "http://h.example/a?x": "http://h.example/a?x=",
        "http://h.example/a?x=a b&y=a+b": "http://h.example/a?x=a+b&y=a+b",
        "http://h.example/é": "http://h.example/%C3%A9",
        "http://h.example/%c3%a9": "http://h.example/%C3%A9",
        "http://h.example/a%2fb": "http://h.example/a%2Fb",
        "http://h.example/a b+c~d": "http://h.example/a%20b+c~d",
        "http://h.example/a?k=é&k=z": "http://h.example/a?k=z&k=%C3%A9",
        "http://h.example/a?a-b=1&a=2": "http://h.example/a?a=2&a-b=1",
        "http://h.example/100%": "http://h.example/100%25",
    }
    assert one(spark, list(cases), urls.canonical_url) == list(cases.values())
    options = lambda v: urls.canonical_url(v, drop_query=True, drop_slash=True)
    assert one(spark, ["http://h.example/a/?b=1#c", "http://h.example/"], options) == [
        "http://h.example/a", "http://h.example/"]


def test_canonical_url_is_stable(spark):
    values = ["http://H/é?b=%7E&a=*#x", "http://h/a%2fb?x=1&&y", "http://h?z"]
    once = one(spark, values, urls.canonical_url)
    assert one(spark, once, urls.canonical_url) == once


def test_fingerprint_merges_spellings(spark):
    same = ["http://h.example/a?b=2&a=1#x", "http://H.example/a?a=1&b=2"]
    a, b = one(spark, same, urls.url_fingerprint)
    assert a == b and len(a) == 40


def test_in_domains(spark):
    values = [
        "http://book.example/x", "https://a.book.example:80/", "http://notbook.example/",
        "http://book.example.evil.example/", "http://u:p@BOOK.example", "/relative",
    ]
    got = one(spark, values, lambda v: urls.in_domains(v, ["book.example"]))
    assert got == [True, True, False, False, True, False]


def test_split_endpoint(spark):
    values = ["http://10.0.0.1:80", "10.0.0.1:8080", "", None, "http://10.0.0.1", "x:y"]
    got = one(spark, values, lambda v: urls.split_endpoint(v))
    assert [tuple(r) for r in got] == [
        ("10.0.0.1", 80, "10.0.0.1:80"), ("10.0.0.1", 8080, "10.0.0.1:8080"),
        (None, None, None), (None, None, None), (None, None, None), (None, None, None),
    ]


def test_endpoint_url(spark):
    row = spark.range(1).select(urls.endpoint_url(F.lit("10.0.0.1"), F.lit(80))).first()
    assert row[0] == "http://10.0.0.1:80"


def test_strip_text_takes_all_white_space(spark):
    values = ["　 a b\xa0\n", "\t\r\n", "", None, "x"]
    assert one(spark, values, tx.strip_text) == [
        v.strip() if v is not None else None for v in values
    ]


def test_layout_lengths(spark):
    from pagelake.operators.records import BOOK_LAYOUT

    got = one(
        spark,
        [",".join(map(str, range(n))) for n in range(5, 10)],
        lambda v: tx.map_by_layout(F.split(v, ","), BOOK_LAYOUT),
    )
    assert [tuple(r) for r in got] == [
        ("", "", "", ""), ("0", "1", "2", "3"), ("0", "2", "3", "4"),
        ("0", "3", "4", "5"), ("", "", "", ""),
    ]
