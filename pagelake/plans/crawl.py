"""The three flows, put together from the operators.

Each function returns the declared plan. Only :func:`retry_report`, by the job of
``running_count``, and :func:`crawl_rounds` run jobs when they are declared. Pages with a ``status`` column are read only
where it tells success.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelake.functions.outcomes import EVICT_AT, RETRY_CAP, reason_of
from pagelake.functions.urls import url_matches
from pagelake.operators.attempts import (
    ok_only,
    retry_decision,
    retry_priority,
    retry_stats,
)
from pagelake.operators.links import (
    LinkRule,
    dedup_requests,
    extract_links,
    frontier,
    keep_domains,
    new_links,
    route_links,
    union_requests,
    with_fingerprint,
)
from pagelake.operators.pool import endpoint_failures, endpoints_to_evict, evict
from pagelake.operators.records import BOOK_PICKS, Pick, extract_picks, extract_records
from pagelake.session import scratch_dir, written

FIRST_SEEN = ("page_id", "pos")


def _answered(pages: DataFrame) -> DataFrame:
    return ok_only(pages) if "status" in pages.columns else pages


def followed_links(
    pages: DataFrame, rules: Sequence[LinkRule], domains: list[str] | None = None
) -> DataFrame:
    """Links of the pages that a rule claims, each once per page. No shuffle.

    A page whose own url is claimed by a rule without ``follow`` gives none: it was
    fetched to be parsed only. Pages no rule claims (seeds) are followed.
    """
    answered = _answered(pages)
    if not all(rule.follow for rule in rules):
        own = route_links(answered, rules, col="url")
        ends = F.col("rule").isNotNull() & ~F.col("follow")
        answered = own.filter(~ends).select(*answered.columns)
    links = extract_links(answered, unique=True)
    if domains is not None:
        links = keep_domains(links, domains)
    return route_links(links, rules).filter(F.col("rule").isNotNull())


def unseen_links(
    pages: DataFrame,
    seen: DataFrame,
    rules: Sequence[LinkRule],
    domains: list[str] | None = None,
) -> DataFrame:
    """Which links not yet in ``seen(fp)`` do these pages lead to?"""
    return new_links(followed_links(pages, rules, domains), seen, FIRST_SEEN)


def unseen_by_rule(
    pages: DataFrame,
    seen: DataFrame,
    rules: Sequence[LinkRule],
    domains: list[str] | None = None,
) -> DataFrame:
    """How many unseen links does each rule claim?"""
    return (
        unseen_links(pages, seen, rules, domains)
        .groupBy("rule")
        .agg(F.count("*").alias("n_links"))
    )


def page_records(
    pages: DataFrame, rules: Sequence[LinkRule], picks: Sequence[Pick] = BOOK_PICKS
) -> DataFrame:
    """Records of the pages whose url a parsing rule claims.

    The url test comes before the page reader, so other pages are never parsed.
    """
    return extract_records(_parsed(pages, rules), picks)


def _parsed(pages: DataFrame, rules: Sequence[LinkRule]) -> DataFrame:
    """Answered pages whose url a parsing rule claims."""
    wanted = F.lit(False)
    for rule in rules:
        if rule.parse:
            wanted = wanted | url_matches(F.col("url"), rule.pattern)
    return _answered(pages).filter(wanted)


def next_requests(
    seen: DataFrame,
    *sources: DataFrame,
    order: Sequence[str] = ("first_seen", "link"),
    n: int | None = None,
) -> DataFrame:
    """Seeds, followed links, rejects and retries to the ordered frontier.

    Rows flagged ``dont_filter`` skip the seen test: retries
    (:func:`retries_as_requests`) and rejected records (:func:`rejects_as_requests`), which
    take ``first_seen`` from a column of their own.
    """
    fresh = new_links(union_requests(*sources), seen, order, force="dont_filter")
    return frontier(fresh, n)


def retry_report(attempts: DataFrame, cap: int = RETRY_CAP) -> tuple[DataFrame, DataFrame]:
    """Decisions with lowered priorities, and the counters over them by ``reason``.

    ``attempts`` has a ``priority``, and either a ``reason`` or the ``status`` and
    ``exception`` that :func:`reason_of` makes one from.
    """
    if "reason" not in attempts.columns:
        attempts = attempts.withColumn("reason", reason_of(F.col("status"), F.col("exception")))
    decisions = retry_priority(retry_decision(attempts, cap))
    return decisions, retry_stats(decisions)


def crawl_rounds(
    seeds: DataFrame,
    pages: DataFrame,
    rules: Sequence[LinkRule],
    domains: list[str] | None = None,
    picks: Sequence[Pick] = BOOK_PICKS,
    name: str = "book_name",
    cap: int = RETRY_CAP,
    max_rounds: int | None = None,
) -> DataFrame:
    """Replay a crawl over captured pages: ``(link, round, times, outcome)``.

    ``seeds(link)`` are round 0. A page that answers a request is read: its links that no
    round requested before are requested in the next round, and a record without a name
    sends its own request there again, past the seen test, up to ``cap`` times. The
    outcome is ``page``, ``record``, ``rejected`` or ``missing`` (no such page, or one
    whose status is no success, which is requested again likewise). Urls are known by
    their fingerprint; of pages with one fingerprint the smallest ``page_id`` answers.

    What pages hold does not change from round to round, so they are read once, before
    the first round: links and record of every page are written. A round joins its
    frontier, of narrow rows, with these and is written as one table; rounds end when one
    is empty, so cycles end too.
    """
    spark = pages.sparkSession

    def kept(df: DataFrame, label: str) -> DataFrame:
        return written(df, scratch_dir(spark, f"crawl-{label}"))

    first = kept(
        dedup_requests(pages.select("url", "page_id"), ["page_id"], col="url").select(
            "fp", "page_id", "url"
        ),
        "pages",
    )
    one = pages.join(first.select("page_id"), "page_id", "left_semi")
    links = followed_links(one, rules, domains).select("page_id", "link")
    links = kept(with_fingerprint(links).select("page_id", F.col("fp").alias("to"), "link"), "links")
    own = [pick for pick in picks if pick.name == name]
    named = extract_picks(_parsed(one, rules), own, keep=("url",))
    good = F.coalesce(F.col(name) != "", F.lit(False))
    named = named.select("url", F.when(good, "record").otherwise("rejected").alias("outcome"))
    ok = _answered(one).select("page_id", F.lit(True).alias("answered"))
    state = first.join(named, "url", "left").join(ok, "page_id", "left")
    state = kept(
        state.select(
            "fp", "page_id",
            F.when(F.col("answered").isNull(), "missing").otherwise(F.coalesce("outcome", F.lit("page"))).alias("outcome"),
        ),
        "state",
    )

    table = scratch_dir(spark, "crawl-rounds")
    schema = "fp string, link string, times int, page_id bigint, outcome string, round int"

    def done() -> DataFrame:
        return spark.read.schema(schema).parquet(table)

    def save(requests: DataFrame, number: int) -> bool:
        asked = requests.join(state, "fp", "left").select(
            "fp", "link", "times", F.col("page_id").cast("bigint").alias("page_id"),
            F.coalesce("outcome", F.lit("missing")).alias("outcome"),
        )
        asked.write.mode("overwrite").parquet(f"{table}/round={number}")
        return not done().filter(F.col("round") == number).isEmpty()

    # Requests of one fingerprint are one; any of its spellings stands for them.
    start = with_fingerprint(seeds.select("link")).groupBy("fp").agg(F.min("link").alias("link"))
    more = save(start.withColumn("times", F.lit(0)), 0)
    number = 0
    while more and (max_rounds is None or number < max_rounds):
        last = done().filter(F.col("round") == number)
        found = last.filter("outcome != 'missing' AND times = 0").select("page_id")
        new = found.join(links, "page_id").groupBy("to").agg(F.min("link").alias("link"))
        new = new.withColumnRenamed("to", "fp").join(done().select("fp"), "fp", "left_anti")
        failed = last.filter(F.col("outcome").isin("missing", "rejected") & (F.col("times") < cap))
        again = failed.select("fp", "link", (F.col("times") + 1).alias("times"))
        number += 1
        more = save(new.select("fp", "link", F.lit(0).alias("times")).unionByName(again), number)
    return done().select("link", "round", "times", "outcome")


def surviving_pool(
    attempts: DataFrame,
    pool: DataFrame,
    threshold: int = EVICT_AT,
    key: Sequence[str] = ("generation", "endpoint"),
) -> DataFrame:
    """The pool after all endpoints at the threshold are gone."""
    bad = endpoints_to_evict(endpoint_failures(attempts, key), threshold)
    return evict(pool, bad, key)
