"""Find, route, deduplicate and order links."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagelake.functions.text import decode_entities
from pagelake.functions.urls import (
    base_parts,
    decoded_url,
    in_domains,
    resolve_against,
    resolve_url,
    url_fingerprint,
    url_matches,
)
from pagelake.operators.skew import first_per_key, first_per_key_late

# One pass over a page. Comments, scripts and styles match first, with an empty
# group, so nothing inside them counts; unclosed ones reach to the end. Of an
# anchor, area or base tag the group holds the text from its name to its href.
# Attributes in between are skipped one by one, possessively and never past the
# next tag, so the time stays linear on broken pages too.
_VALUE = r"""("[^"]*"|'[^']*'|[^\s"'<>]+)"""
_TAGS = (
    r"(?is)<(?:!--(?:.*?-->|.*\z)"
    r"|script\b(?:.*?</script\s*>|.*\z)"
    r"|style\b(?:.*?</style\s*>|.*\z)"
    r"""|((?:a|area|base)(?=\s)(?:\s+(?!href\b)[^\s=<>"']+"""
    r"""(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s<>"']+))?)*+"""
    r"""\s+href\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'<>]+)))"""
)
_TAG_HREF = r"(?is)\shref\s*=\s*" + _VALUE + r"\z"
_HTML_BLANKS = " \t\n\r\f"
_CRAWLABLE = r"^(?i:https?|ftp|file)://"


@dataclass(frozen=True)
class LinkRule:
    """Links that match ``pattern`` are claimed: parse their page, follow it on."""

    name: str
    pattern: str
    parse: bool = False
    follow: bool = True


# What a category, a detail and a next-page link look like.
CATEGORY_SEGMENT = r"[\u2E80-\u9FFF]+$"
DETAIL_PATH = r"/subject/[0-9]+/$"
NEXT_PAGE_QUERY = r"\?start=[0-9]+&type=T$"


def catalogue_rules(host: str) -> list[LinkRule]:
    """The three rules of a book catalogue served by ``host``, in their order."""
    category = host.replace(".", r"\.") + "/tag/" + CATEGORY_SEGMENT
    return [
        LinkRule("category", category),
        LinkRule("detail", DETAIL_PATH, parse=True),
        LinkRule("next", NEXT_PAGE_QUERY),
    ]


def _tag_href(tag: Column) -> Column:
    value = F.trim(F.regexp_extract(tag, _TAG_HREF, 1), F.lit("\"'"))
    return F.trim(value, F.lit(_HTML_BLANKS))


def extract_links(
    pages: DataFrame, unique: bool = False, id_col: str = "page_id"
) -> DataFrame:
    """One row per link: ``id_col``, ``url``, ``pos``, ``link`` (absolute).

    With ``unique`` a link counts once per page. All links of a page come from
    one row, so that needs no shuffle.
    """
    found = F.regexp_extract_all("html", F.lit(_TAGS), F.lit(1))
    is_base = r"^(?i:base)\s"
    bases = F.filter("_tags", lambda t: t.rlike(is_base))
    others = F.filter("_tags", lambda t: (t != "") & ~t.rlike(is_base))
    tags = pages.select(id_col, "url", found.alias("_tags")).select(
        id_col,
        "url",
        F.get(F.transform(bases, _tag_href), F.lit(0)).alias("_declared"),
        F.transform(others, _tag_href).alias("_hrefs"),
    )
    based = tags.select(
        id_col,
        "url",
        "_hrefs",
        F.when(F.col("_declared").isNull(), F.col("url"))
        .otherwise(resolve_url(F.col("_declared"), F.col("url")))
        .alias("_base"),
    )
    parts = base_parts(F.col("_base"))
    ready = based.select(
        id_col, "url", "_hrefs", *(c.alias(f"_b_{k}") for k, c in parts.items())
    )
    known = {k: F.col(f"_b_{k}") for k in parts}
    # One transform per step: each value is then computed once, not once per use.
    links = F.transform(
        F.transform("_hrefs", decode_entities), lambda x: resolve_against(x, known)
    )
    links = F.filter(links, lambda x: x.rlike(_CRAWLABLE))
    if unique:
        links = F.array_distinct(links)
    # The outer form: the inner one would add a filter that computes the array
    # a second time.
    return ready.select(
        id_col, "url", F.posexplode_outer(links).alias("pos", "link")
    ).filter(F.col("link").isNotNull())


def route_links(
    links: DataFrame, rules: Sequence[LinkRule], col: str = "link"
) -> DataFrame:
    """Add ``rule``, ``parse``, ``follow``: the first rule that matches claims
    the link. Unclaimed links get a null rule and neither flag.

    Patterns see the decoded url, so they may name characters beyond ASCII.
    """
    seen_as = decoded_url(F.col(col))
    rule = reduce(
        lambda chain, r: chain.when(url_matches(seen_as, r.pattern), F.lit(r.name)),
        rules[1:],
        F.when(url_matches(seen_as, rules[0].pattern), F.lit(rules[0].name)),
    )
    routed = links.withColumn("rule", rule)
    for flag in ("parse", "follow"):
        names = [r.name for r in rules if getattr(r, flag)]
        test = F.col("rule").isin(*names) if names else F.lit(False)
        routed = routed.withColumn(flag, F.coalesce(test, F.lit(False)))
    return routed


def keep_domains(links: DataFrame, domains: list[str], col: str = "link") -> DataFrame:
    """Links whose host is one of the domains or below one."""
    return links.filter(in_domains(F.col(col), domains))


def unique_links(links: DataFrame, id_col: str = "page_id") -> DataFrame:
    """Each link once per page, its first occurrence kept.

    For links from :func:`extract_links` ask for ``unique=True`` there instead.
    """
    return first_per_key(links, [id_col, "link"], ["pos"])


def with_fingerprint(requests: DataFrame, col: str = "link") -> DataFrame:
    """Add ``fp`` unless it is there."""
    if "fp" in requests.columns:
        return requests
    return requests.withColumn("fp", url_fingerprint(F.col(col)))


def dedup_requests(
    requests: DataFrame, order: Sequence[str], col: str = "link", late: bool = False
) -> DataFrame:
    """The first request of each fingerprint, by ``order``. ``late`` as in
    :func:`new_links`.
    """
    first = first_per_key_late if late else _first_of_key
    return first(with_fingerprint(requests, col), "fp", list(order))


def _first_of_key(
    df: DataFrame, key: str, order: list[str], unless: DataFrame | None = None
) -> DataFrame:
    first = first_per_key(df, [key], order)
    return first if unless is None else first.join(unless, key, "left_anti")


def new_links(
    requests: DataFrame,
    seen: DataFrame,
    order: Sequence[str],
    force: str | None = None,
    col: str = "link",
    late: bool = False,
) -> DataFrame:
    """First requests whose fingerprint is not in ``seen(fp)``.

    Copies are merged before the join: a link on a third of all pages reaches it
    as one row, and the join runs on the aggregate's own partitioning. Rows with
    a true ``force`` column skip both tests, in the same pass: each is a key of its own,
    which no fingerprint equals.

    ``late`` is for wide requests most of which are known: these are written once, only
    their fingerprints and order are aggregated and held against ``seen``, and the rows
    of the new ones are fetched last. ``order`` must then tell a key's rows apart.
    """
    requests = with_fingerprint(requests, col)
    first = first_per_key_late if late else _first_of_key
    known = seen.select("fp")
    if force is None:
        return first(requests, "fp", list(order), known)
    key = "_key"
    if key in requests.columns:
        raise ValueError(f"column {key} exists")
    forced = F.coalesce(F.col(force), F.lit(False))
    own = F.concat(F.lit("row "), F.monotonically_increasing_id().cast("string"))
    keyed = requests.withColumn(key, F.when(forced, own).otherwise(F.col("fp")))
    return first(keyed, key, list(order), known.withColumnRenamed("fp", key)).select(
        *requests.columns
    )


REQUEST_DEFAULTS = {"priority": 0, "dont_filter": False, "retry_times": 0}


def union_requests(*sources: DataFrame) -> DataFrame:
    """One request table out of seeds, followed links, rejects and retries.

    Columns a source lacks are null, but for the three with a default.
    """
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)
    for name, default in REQUEST_DEFAULTS.items():
        value = F.lit(default)
        if name in both.columns:
            value = F.coalesce(F.col(name), value)
        both = both.withColumn(name, value)
    return both


def frontier(
    requests: DataFrame,
    n: int | None = None,
    tie_break: Sequence[str] = ("first_seen", "link"),
) -> DataFrame:
    """Requests with the highest priority first; ``n`` takes the top of it."""
    ordered = requests.orderBy(F.desc("priority"), *tie_break)
    return ordered if n is None else ordered.limit(n)
