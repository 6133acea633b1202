"""Turn pages into typed records by a declared spec."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelake.functions.text import Layout, clean_lines, join_paragraphs, map_by_layout
from pagelake.operators.markup import Page, Step, anywhere, child

Path = tuple[Step, ...]


@dataclass(frozen=True)
class Pick:
    """One value to read off a page.

    ``kind``: ``first`` text, ``all`` texts, or the first ``attr`` value. With
    several paths, a later one counts only while the value is null (an empty one
    is kept). ``section`` first narrows the page to the nth match (from 0) of a
    path, below which ``paths`` then start; no such match gives no values.
    """

    name: str
    paths: tuple[Path, ...]
    kind: str = "first"
    attr: str | None = None
    section: tuple[Path, int] | None = None

    @property
    def many(self) -> bool:
        return self.kind == "all"


def first_text(name: str, *paths: Path) -> Pick:
    """First direct text at the path, null if there is none."""
    return Pick(name, paths)


def all_texts(name: str, path: Path) -> Pick:
    """Every direct text at the path, as an array."""
    return Pick(name, (path,), kind="all")


def first_attr(name: str, path: Path, attr: str) -> Pick:
    """First value of an attribute at the path, null if there is none."""
    return Pick(name, (path,), kind="attr", attr=attr)


def section_texts(name: str, sections: Path, index: int, path: Path) -> Pick:
    """Every direct text at ``path`` below the nth match of ``sections``."""
    return Pick(name, (path,), kind="all", section=(sections, index))


def _reader(picks: tuple[Pick, ...]):
    """Function from a page to the picked values; travels to the executors."""
    plan = [(p.paths, p.kind, p.attr, p.section) for p in picks]

    def read(html: str | None) -> list:
        page = Page(html or "")
        out = []
        for paths, kind, attr, section in plan:
            start = None
            if section is not None:
                start = page.select(section[0])[section[1] : section[1] + 1]
            value = None
            for path in paths:
                nodes = page.select(path, start)
                if kind == "attr":
                    values = (n.attrs[attr] for n in nodes if attr in n.attrs)
                else:
                    values = (t for n in nodes for t in n.texts)
                value = list(values) if kind == "all" else next(values, None)
                if value is not None:
                    break
            out.append(value)
        return out

    return read


def pick_values(html: Column, picks: Sequence[Pick]) -> Column:
    """Struct of the picked values. Arrow batches; only ``html`` goes to Python.

    A column and not a ``mapInPandas`` node, so filters on other columns are
    still pushed below it and those columns never leave the JVM.
    """
    picks = tuple(picks)
    read = _reader(picks)
    names = [p.name for p in picks]
    many = [p.many for p in picks]
    kinds = [T.ArrayType(T.StringType()) if m else T.StringType() for m in many]
    schema = T.StructType([T.StructField(n, k) for n, k in zip(names, kinds)])

    def parse(pages: pa.Array) -> pa.Array:
        columns = [[] for _ in names]
        for page in pages:
            for column, value in zip(columns, read(page.as_py())):
                column.append(value)
        arrays = [
            pa.array(c, pa.list_(pa.string()) if m else pa.string())
            for c, m in zip(columns, many)
        ]
        return pa.StructArray.from_arrays(arrays, names=names)

    return F.arrow_udf(parse, schema)(html)


def extract_picks(
    pages: DataFrame, picks: Sequence[Pick], keep: Sequence[str] = ("page_id", "url")
) -> DataFrame:
    """``keep`` columns plus one column per pick."""
    raw = pages.select(*keep, pick_values(F.col("html"), picks).alias("_raw"))
    return raw.select(*keep, "_raw.*")


# Where the fields of a book page are.
_INFO = anywhere("div", id="info")
BOOK_PICKS = (
    all_texts("book_type", (
        anywhere("div", class_="blank20"), child("div", class_="indent"),
        child("span"), child("a"))),
    first_attr("book_cover_url", (
        anywhere("div", class_="subject clearfix"), child("div", id="mainpic"),
        child("a")), "href"),
    first_text("book_name", (anywhere("h1"), child("span"))),
    first_text("book_author",
        (_INFO, child("a", nth=1)), (_INFO, child("span"), child("a", nth=1))),
    all_texts("info_texts", (_INFO,)),
    first_text("book_rating", (
        anywhere("div", class_="rating_self clearfix"), child("strong"))),
    first_text("book_comment_num", (
        anywhere("div", class_="rating_sum"), child("span"), child("a"),
        child("span"))),
    section_texts("abstract_texts",
        (anywhere("div", class_="intro"),), 0, (child("p"),)),
    section_texts("author_texts",
        (anywhere("div", class_="intro"),), 1, (child("p"),)),
)

# The lengths of the info block that are understood. In all three
# the publisher comes first; date, pages and price sit at the same places from
# the end.
BOOK_LAYOUT = Layout(
    sizes=(6, 7, 8),
    positions=(
        ("book_publisher", 1),
        ("book_publish_time", -5),
        ("book_pages_num", -4),
        ("book_price", -3),
    ),
)

# The record's fields.
BOOK_SCHEMA = T.StructType([
    T.StructField("book_type", T.ArrayType(T.StringType())),
    T.StructField("book_cover_url", T.StringType()),
    T.StructField("book_name", T.StringType()),
    T.StructField("book_author", T.StringType()),
    T.StructField("book_link", T.StringType()),
    T.StructField("book_publisher", T.StringType()),
    T.StructField("book_publish_time", T.StringType()),
    T.StructField("book_pages_num", T.StringType()),
    T.StructField("book_price", T.StringType()),
    T.StructField("book_rating", T.StringType()),
    T.StructField("book_comment_num", T.StringType()),
    T.StructField("book_abstract", T.StringType()),
    T.StructField("book_author_abstract", T.StringType()),
    T.StructField("book_info", T.ArrayType(T.StringType())),
])


def assemble_record(picked: DataFrame, schema: T.StructType = BOOK_SCHEMA) -> DataFrame:
    """Picked values to the record's columns, in order and with fixed types.

    ``picked`` has ``url``, the arrays ``info_texts``, ``abstract_texts``,
    ``author_texts`` and, by their own names, the fields taken as they are.
    Fields nobody picked are null.
    """
    lines = picked.withColumn("book_info", clean_lines(F.col("info_texts")))
    made = {
        "book_link": F.col("url"),
        "book_abstract": join_paragraphs(F.col("abstract_texts")),
        "book_author_abstract": join_paragraphs(F.col("author_texts")),
    }
    laid_out = map_by_layout(F.col("book_info"), BOOK_LAYOUT)
    made |= {name: laid_out[name] for name, _ in BOOK_LAYOUT.positions}
    columns = []
    for field in schema.fields:
        if field.name in made:
            value = made[field.name]
        elif field.name in lines.columns:
            value = F.col(field.name)
        else:
            value = F.lit(None)
        columns.append(value.cast(field.dataType).alias(field.name))
    return lines.select(*columns)


def extract_records(pages: DataFrame, picks: Sequence[Pick] = BOOK_PICKS) -> DataFrame:
    """Pages to records. Filter ``pages`` first: parsing is the dear part."""
    return assemble_record(extract_picks(pages, picks, keep=("url",)))


def split_valid(
    records: DataFrame, name: str = "book_name"
) -> tuple[DataFrame, DataFrame]:
    """Records with a name, and those whose name is null or empty.

    Both read ``records``: write it once first if it is dear to compute.
    """
    ok = F.coalesce(F.col(name) != "", F.lit(False))
    return records.filter(ok), records.filter(~ok)


def rejects_as_requests(
    rejected: DataFrame, url: str = "book_link", first_seen: str | None = None
) -> DataFrame:
    """Rejected records as requests for their page, to be fetched again. ``first_seen``
    names the column that orders them in a frontier, if they are to enter one.
    """
    return rejected.select(
        F.col(url).alias("link"),
        F.lit(True).alias("dont_filter"),
        F.lit("no name").alias("reason"),
        *([F.col(first_seen).alias("first_seen")] if first_seen else []),
    )
