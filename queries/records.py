"""Page-to-record extraction and record stores."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelake.functions.text import (
    WHITESPACE,
    clean_lines,
    join_paragraphs,
    map_by_layout,
    nth_or_empty,
    strip_text,
)
from pagelake.functions.urls import split_endpoint
from pagelake.operators.custom import apply_stages, extract_with
from pagelake.operators.links import LinkRule
from pagelake.operators.markup import Page, anywhere, child
from pagelake.operators.records import (
    BOOK_LAYOUT,
    all_texts,
    extract_picks,
    extract_records,
    first_attr,
    first_text,
    rejects_as_requests,
    section_texts,
    split_valid,
)
from pagelake.plans.crawl import page_records
from pagelake.session import scratch_dir, written
from pagelake.sources.tables import parse_json, write_records, write_records_json
from queries import query
from queries.inputs import pages, table

# What the given pages hold, in the places of the record's fields.
TITLE = first_text("title", (anywhere("h1"),))
ARTICLE = (anywhere("article"),)
PAGE_PICKS = (
    all_texts("book_type", (anywhere("nav"), child("ul"), child("li"), child("a"))),
    first_attr("book_cover_url", (anywhere("nav"), anywhere("a")), "href"),
    first_text("book_name", (anywhere("article"), child("p"))),
    first_text("book_author", (anywhere("h2"),), (anywhere("h1"),)),
    all_texts("info_texts", (anywhere("article"), child("p"))),
    first_text("book_rating", (anywhere("div", class_="ad"),)),
    first_text("book_comment_num", (anywhere("div", class_="none"),)),
    section_texts("abstract_texts", ARTICLE, 0, (child("p"),)),
    section_texts("author_texts", ARTICLE, 1, (child("p"),)),
)


def _sql_text(expr: str) -> str:
    """Entities of the given pages decoded. As HTML has it, these names count
    without their semicolon too, which cut-off pages have.
    """
    for name, char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "''"), ("amp", "&")):
        expr = f"regexp_replace({expr}, '&{name};?', '{char}', 'g')"
    return expr


_WS = "".join(f"chr({ord(c)})||" for c in WHITESPACE)[:-2]
_H1 = _sql_text("regexp_extract(html, '<h1>([^<]*)', 1)")
_NAV = r"regexp_extract_all(html, '<a href=\"[^\"]*\">([^<]+)', 1)".replace('\\"', '"')
_PARAS = "list_filter(regexp_extract_all(html, '<p>([^<]*)', 1), lambda x: x <> '')"
_PARAS = f"list_transform({_PARAS}, lambda x: {_sql_text('x')})"
_LINES = f"""list_filter(list_transform({{0}},
    lambda x: trim(replace(x, chr(10), ''), {_WS})), lambda x: x <> '')"""
_PAGE_LINES = _LINES.format(_PARAS)
_DOC_LINES = _LINES.format("string_split(text, chr(10))")


def _sql_layout(lines: str) -> str:
    known = f"len({lines}) BETWEEN 6 AND 8"
    return f"""CASE WHEN {known} THEN {lines}[1] ELSE '' END AS book_publisher,
        CASE WHEN {known} THEN {lines}[-5] ELSE '' END AS book_publish_time,
        CASE WHEN {known} THEN {lines}[-4] ELSE '' END AS book_pages_num,
        CASE WHEN {known} THEN {lines}[-3] ELSE '' END AS book_price"""


_RECORD_SQL = f"""
    read AS (
        SELECT url AS book_link, {_PARAS} AS paras, {_PAGE_LINES} AS lines,
               {_H1} AS h1, list_transform({_NAV}, lambda x: {_sql_text('x')}) AS nav,
               regexp_extract(html, '<a href="([^"]*)"', 1) AS href,
               nullif({_sql_text("regexp_extract(html, '<div class=\"ad\">([^<]*)', 1)")},
                      '') AS ad
        FROM pages
    ),
    records AS (
        SELECT array_to_string(nav, '|') AS book_type,
               nullif({_sql_text('href')}, '') AS book_cover_url,
               paras[1] AS book_name, nullif(h1, '') AS book_author, book_link,
               {_sql_layout('lines')},
               ad AS book_rating, CAST(NULL AS VARCHAR) AS book_comment_num,
               coalesce(array_to_string(
                   list_transform(paras, lambda x: x || chr(10)), ''), '')
                   AS book_abstract,
               '' AS book_author_abstract,
               coalesce(array_to_string(lines, '|'), '') AS book_info
        FROM read
    )"""


NAMES_SQL = f"""SELECT page_id, url, paras[1] AS name
        FROM (SELECT page_id, url, {_PARAS} AS paras FROM pages)"""


def _flat(records):
    """Arrays as text, so that both sides compare by value."""
    return records.withColumns({
        "book_type": F.array_join("book_type", "|"),
        "book_info": F.array_join("book_info", "|"),
    })


@query(f"SELECT page_id, url, nullif({_H1}, '') AS title FROM pages")
def c3_first_text(spark, sf):
    return extract_picks(pages(spark, sf), [TITLE])


@query(f"""
    SELECT page_id, array_to_string(list_transform({_NAV},
        lambda x: {_sql_text('x')}), '|') AS texts FROM pages""")
def c4_all_texts(spark, sf):
    pick = all_texts("texts", (anywhere("nav"), anywhere("a")))
    return extract_picks(pages(spark, sf), [pick], keep=["page_id"]).withColumn(
        "texts", F.array_join("texts", "|")
    )


@query(f"""
    SELECT page_id, {_sql_text("regexp_extract(html, '<a href=\"([^\"]*)\"', 1)")} AS href
    FROM pages""")
def c5_first_attr(spark, sf):
    pick = first_attr("href", (anywhere("nav"), anywhere("a")), "href")
    return extract_picks(pages(spark, sf), [pick], keep=["page_id"])


@query(f"""
    SELECT page_id,
           {_sql_text("regexp_extract(html, '<div class=\"ad\">([^<]*)', 1)")} AS ad
    FROM pages""")
def c6_match_on_attribute(spark, sf):
    pick = first_text("ad", (anywhere("div", class_="ad"),))
    return extract_picks(pages(spark, sf), [pick], keep=["page_id"])


@query(f"""
    SELECT page_id, list_transform({_NAV}, lambda x: {_sql_text('x')})[3] AS third
    FROM pages""")
def c7_child_and_index(spark, sf):
    path = (anywhere("nav"), child("ul"), child("li", nth=3), child("a", nth=1))
    return extract_picks(pages(spark, sf), [first_text("third", path)], keep=["page_id"])


@query(f"SELECT page_id, nullif({_H1}, '') AS title FROM pages")
def c8_fallback(spark, sf):
    pick = first_text("title", (anywhere("h2"),), (anywhere("h1"),))
    return extract_picks(pages(spark, sf), [pick], keep=["page_id"])


@query(f"WITH {_RECORD_SQL} SELECT book_link, book_author FROM records")
def c9_lineage(spark, sf):
    records = extract_records(pages(spark, sf), PAGE_PICKS)
    return records.select("book_link", "book_author")


@query(f"""
    SELECT doc_id, coalesce(array_to_string({_DOC_LINES}, '|'), '') AS lines
    FROM documents""")
def c10_clean_lines(spark, sf):
    lines = clean_lines(F.split("text", "\n"))
    return table(spark, sf, "documents").select(
        "doc_id", F.array_join(lines, "|").alias("lines")
    )


@query(f"SELECT doc_id, {_sql_layout(_DOC_LINES)} FROM documents")
def c11_map_by_layout(spark, sf):
    docs = table(spark, sf, "documents").select(
        "doc_id", clean_lines(F.split("text", "\n")).alias("lines")
    )
    fields = map_by_layout(F.col("lines"), BOOK_LAYOUT)
    return docs.select("doc_id", fields.alias("f")).select("doc_id", "f.*")


@query(f"""
    SELECT page_id, coalesce({_PARAS}[1], '') AS first, coalesce({_PARAS}[2], '') AS second,
           coalesce({_PARAS}[40], '') AS fortieth
    FROM pages""")
def c12_nth_section(spark, sf):
    pick = all_texts("texts", (anywhere("article"), child("p")))
    texts = extract_picks(pages(spark, sf), [pick], keep=["page_id"])
    return texts.select(
        "page_id",
        nth_or_empty(F.col("texts"), 0).alias("first"),
        nth_or_empty(F.col("texts"), 1).alias("second"),
        nth_or_empty(F.col("texts"), 39).alias("fortieth"),
    )


@query(f"""
    SELECT page_id, coalesce(array_to_string(
        list_transform({_PARAS}, lambda x: x || chr(10)), ''), '') AS abstract
    FROM pages""")
def c13_join_paragraphs(spark, sf):
    pick = section_texts("texts", ARTICLE, 0, (child("p"),))
    return extract_picks(pages(spark, sf), [pick], keep=["page_id"]).select(
        "page_id", join_paragraphs(F.col("texts")).alias("abstract")
    )


@query(f"WITH {_RECORD_SQL} SELECT * FROM records")
def c14_assemble_record(spark, sf):
    return _flat(extract_records(pages(spark, sf), PAGE_PICKS))


@query(rf"""WITH {_RECORD_SQL}
    SELECT * FROM records WHERE regexp_matches(book_link, '\.html$')""")
def c15_extract_records(spark, sf):
    rules = [LinkRule("detail", r"\.html$", parse=True), LinkRule("rest", ".")]
    return _flat(page_records(pages(spark, sf), rules, PAGE_PICKS))


@query(r"""
    SELECT page_id, nullif(regexp_extract(u, '^http://([^:]+):', 1), '') AS ip,
           CAST(regexp_extract(u, ':([0-9]+)$', 1) AS INTEGER) AS port,
           regexp_extract(u, '^http://(.*)$', 1) AS endpoint
    FROM (SELECT page_id, 'http://' || regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)
              || ':' || (8000 + page_id % 90) AS u FROM pages)""")
def c16_split_endpoint(spark, sf):
    host = F.regexp_extract("url", r"^[a-z]+://([^/?#]*)", 1)
    port = (F.col("page_id") % 90 + F.lit(8000)).cast("string")
    proxy = F.concat(F.lit("http://"), host, F.lit(":"), port)
    return pages(spark, sf).select("page_id", split_endpoint(proxy).alias("e")).select(
        "page_id", "e.*"
    )


@query("""
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def c19_parse_record_json(spark, sf):
    schema = T.StructType([T.StructField("k", T.LongType())])
    return table(spark, sf, "events").select(
        "event_id", parse_json(F.col("props"), schema).alias("p")
    ).select("event_id", "p.k")


@query(f"""WITH {_RECORD_SQL}
    SELECT book_link, book_name IS NOT NULL AND book_name <> '' AS valid FROM records""")
def b5_valid_and_rejected(spark, sf):
    records = extract_records(pages(spark, sf), PAGE_PICKS)
    records = written(records.select("book_link", "book_name"), scratch_dir(spark, "records"))
    valid, rejected = split_valid(records)
    return valid.select("book_link", F.lit(True).alias("valid")).unionByName(
        rejected.select("book_link", F.lit(False).alias("valid"))
    )


@query(f"""WITH {_RECORD_SQL}
    SELECT book_link AS link, true AS dont_filter, 'no name' AS reason
    FROM records WHERE book_name IS NULL OR book_name = ''""")
def b5_rejects_as_requests(spark, sf):
    records = extract_records(pages(spark, sf), PAGE_PICKS)
    return rejects_as_requests(split_valid(records)[1])


@query("""
    SELECT doc_id, text, lang, source, n_chars FROM documents""")
def a4_write_records_json(spark, sf):
    docs = table(spark, sf, "documents")
    lines = scratch_dir(spark, "json")
    write_records_json(docs, lines)
    parsed = spark.read.text(lines).select(
        parse_json(F.col("value"), docs.schema).alias("r")
    )
    return parsed.select("r.*").drop("_corrupt")


@query("""
    SELECT doc_id, lang, 2 AS copies FROM documents""")
def a5_write_records_append(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    store = scratch_dir(spark, "store")
    write_records(docs, store)
    write_records(docs, store)
    return spark.read.parquet(store).groupBy("doc_id", "lang").agg(
        F.count("*").cast("int").alias("copies")
    )


@query("""
    SELECT sha1(text) AS fp, min(doc_id) AS doc_id FROM documents GROUP BY 1""")
def a5_write_records_by_key(spark, sf):
    docs = table(spark, sf, "documents").select(
        F.sha1(F.col("text").cast("binary")).alias("fp"), "doc_id"
    )
    store = scratch_dir(spark, "store")
    write_records(docs, store, key=["fp"], order=["doc_id"])
    write_records(docs, store, key=["fp"], order=["doc_id"])
    return spark.read.parquet(store)


@query(f"""
    SELECT doc_id, trim(text, {_WS}) AS stripped, replace(text, chr(10), '') AS one_line,
           text IS NULL OR text = '' AS empty
    FROM documents""")
def s1_replace_strip_empty(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id",
        strip_text(F.col("text")).alias("stripped"),
        F.replace("text", F.lit("\n"), F.lit("")).alias("one_line"),
        (F.col("text").isNull() | (F.col("text") == "")).alias("empty"),
    )


@query(f"""
    SELECT url, 'title' AS kind, nullif({_H1}, '') AS value FROM pages
    UNION ALL
    SELECT url, 'link', unnest(list_transform({_NAV}, lambda x: {_sql_text('x')})) FROM pages""")
def u1_page_callback(spark, sf):
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("url", "kind", "value")])

    def callback(url, html):
        page = Page(html)
        for kind, path in (("title", (anywhere("h1"),)), ("link", (anywhere("nav"), anywhere("a")))):
            for element in page.select(path):
                for text in element.texts:
                    yield {"url": url, "kind": kind, "value": text}

    return extract_with(pages(spark, sf), callback, schema)


@query(f"""WITH {_RECORD_SQL}
    SELECT book_link, length(book_name) AS n_chars FROM records WHERE book_name <> ''""")
def u2_record_stages(spark, sf):
    return apply_stages(
        extract_records(pages(spark, sf), PAGE_PICKS),
        lambda df: split_valid(df)[0],
        lambda df: df.select("book_link", F.length("book_name").cast("bigint").alias("n_chars")),
    )
