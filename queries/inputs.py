"""The given tables in the shapes the operators expect, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelake.functions.outcomes import reason_of
from pagelake.functions.urls import split_endpoint
from pagelake.operators.links import LinkRule
from pagelake.sources.tables import read_pages

LAST_SEGMENT = r"/[À-ɏ][À-ɏa-z]*$"
URL_RULES = [
    LinkRule("category", r"/(?:fr|de|es)/[0-9]+$"),
    LinkRule("detail", r"\.html$", parse=True),
    LinkRule("next", r"\?page=[0-9]+&ref=x$"),
]
LINK_RULES = [
    LinkRule("accented", LAST_SEGMENT),
    LinkRule("sentence_end", r"[.]$", parse=True),
    LinkRule("plain", r"/[A-Za-z]+$", follow=False),
]

# Links of the pages, made absolute; every href there is '/segment'.
LINKS_SQL = r"""
    hrefs AS (
        SELECT page_id, url,
               unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href,
               generate_subscripts(
                   regexp_extract_all(html, '<a href="([^"]*)"', 1), 1) - 1 AS pos
        FROM pages
    ),
    links AS (
        SELECT page_id, url, CAST(pos AS INTEGER) AS pos,
               regexp_extract(url, '^([a-z]+://[^/?#]*)', 1)
                   || replace(href, '&amp;', '&') AS link
        FROM hrefs
    ),
    uniq AS (
        SELECT page_id, url, link FROM links GROUP BY ALL
    )"""

LINK_RULE_SQL = r"""CASE
        WHEN regexp_matches(link, '/[\x{00C0}-\x{024F}][\x{00C0}-\x{024F}a-z]*$')
            THEN 'accented'
        WHEN regexp_matches(link, '[.]$') THEN 'sentence_end'
        WHEN regexp_matches(link, '/[A-Za-z]+$') THEN 'plain' END"""

# The event log as attempts: who asks, over which endpoint, with what outcome.
ATTEMPTS_SQL = r"""
    keyed AS (
        SELECT *, CAST(floor(value) AS BIGINT) % 100 AS k FROM events
    ),
    attempts AS (
        SELECT event_id AS attempt_id, ts, user_id AS request,
               event_type = 'error' AS failed,
               CASE WHEN k % 10 <> 9 THEN
                   '10.0.' || (k // 16) || '.' || (k % 16) || ':' || (8000 + k)
               END AS endpoint,
               CASE WHEN event_type <> 'error' THEN 200
                    WHEN event_id % 10 = 3 THEN NULL
                    ELSE [500, 502, 503, 404, 599][1 + event_id % 5]
               END AS status,
               CASE WHEN event_type = 'error' AND event_id % 10 = 3
                    THEN 'net.TimeoutError' END AS exception,
               event_id % 13 = 0 AS dont_retry,
               CASE WHEN user_id % 5 = 0 THEN 4 END AS max_retry_times,
               (day(ts) - 1) // 10 AS generation,
               100 AS priority
        FROM keyed
    )"""


def pages(spark: SparkSession, sf: str) -> DataFrame:
    return read_pages(spark, f"{sf}/pages.parquet")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def attempts(spark: SparkSession, sf: str) -> DataFrame:
    k = F.floor("value") % 100
    failed = F.col("event_type") == "error"
    timed_out = failed & (F.col("event_id") % 10 == 3)
    proxy = F.when(
        k % 10 != 9,
        F.concat(
            *(F.lit(x) if isinstance(x, str) else x.cast("string") for x in (
                "http://10.0.", F.floor(k / 16), ".", k % 16, ":", k + F.lit(8000)
            ))
        ),
    )
    codes = F.array(*(F.lit(c) for c in (500, 502, 503, 404, 599)))
    status = (
        F.when(~failed, 200)
        .when(timed_out, None)
        .otherwise(F.get(codes, (F.col("event_id") % 5).cast("int")))
    )
    return table(spark, sf, "events").select(
        F.col("event_id").alias("attempt_id"),
        "ts",
        F.col("user_id").alias("request"),
        failed.alias("failed"),
        split_endpoint(proxy)["endpoint"].alias("endpoint"),
        status.alias("status"),
        F.when(timed_out, "net.TimeoutError").alias("exception"),
        (F.col("event_id") % 13 == 0).alias("dont_retry"),
        F.when(F.col("user_id") % 5 == 0, 4).alias("max_retry_times"),
        F.floor((F.dayofmonth("ts") - 1) / 10).alias("generation"),
        F.lit(100).alias("priority"),
    )


def with_reason(log: DataFrame) -> DataFrame:
    return log.withColumn("reason", reason_of(F.col("status"), F.col("exception")))


REASON_SQL = """coalesce(exception, CASE status WHEN 500 THEN '500 Internal Server Error'
        WHEN 502 THEN '502 Bad Gateway' WHEN 503 THEN '503 Service Unavailable'
        WHEN 404 THEN '404 Not Found' WHEN 200 THEN '200 OK'
        ELSE status || ' Unknown Status' END)"""
