"""Sources, url predicates, links, deduplication, frontier."""

import uuid

from pyspark.sql import functions as F

from pagelake.functions.urls import (
    canonical_url,
    in_domains,
    url_fingerprint,
    url_host,
    url_matches,
)
from pagelake.operators.attempts import (
    assign_worker,
    retries_as_requests,
    retry_decision,
    retry_priority,
    spread,
)
from pagelake.operators.links import (
    LinkRule,
    dedup_requests,
    extract_links,
    frontier,
    new_links,
    route_links,
    union_requests,
    unique_links,
    with_fingerprint,
)
from pagelake.operators.reach import reachable
from pagelake.operators.records import extract_picks, rejects_as_requests, split_valid
from pagelake.operators.skew import first_per_key
from pagelake.plans.crawl import FIRST_SEEN, followed_links, next_requests, unseen_by_rule
from pagelake.session import scratch_dir, written
from pagelake.sources.seen import add_seen, compact_seen, seen_table
from pagelake.sources.tables import read_pages, read_seeds, store_pages
from queries import query
from queries.inputs import (
    LAST_SEGMENT,
    LINK_RULE_SQL,
    LINK_RULES,
    LINKS_SQL,
    URL_RULES,
    pages,
    table,
)
from queries.records import NAMES_SQL, PAGE_PICKS


@query("SELECT page_id, url, length(html) AS n_chars FROM pages")
def a1_read_pages(spark, sf):
    return pages(spark, sf).select(
        "page_id", "url", F.length("html").cast("bigint").alias("n_chars")
    )


@query("SELECT url AS link, count(*) AS n FROM pages GROUP BY url")
def a2_read_seeds(spark, sf):
    lines = scratch_dir(spark, "seeds")
    pages(spark, sf).select(F.concat(F.lit("  "), "url")).write.text(lines)
    return read_seeds(spark, lines).groupBy("link").agg(F.count("*").alias("n"))


_IN_DOMAIN = r"""
    SELECT page_id, url FROM pages
    WHERE regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1) = 'example.net'
       OR regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1) LIKE '%.example.net'"""


@query(_IN_DOMAIN)
def b2_in_domains(spark, sf):
    return pages(spark, sf).select("page_id", "url").filter(
        in_domains(F.col("url"), ["example.net"])
    )


@query(_IN_DOMAIN)
def b2_in_domains_stored(spark, sf):
    path = scratch_dir(spark, "pages")
    store_pages(pages(spark, sf), path)
    return read_pages(spark, path, ["page_id", "url"], domains=["example.net"])


@query(r"SELECT page_id, url FROM pages WHERE regexp_matches(url, '/[0-9]+\.html$')")
def b3_url_matches(spark, sf):
    return pages(spark, sf).select("page_id", "url").filter(
        url_matches(F.col("url"), r"/[0-9]+\.html$")
    )


@query(rf"""WITH {LINKS_SQL}
    SELECT page_id, link FROM links
    WHERE regexp_matches(link, '/[\x{{00C0}}-\x{{024F}}][\x{{00C0}}-\x{{024F}}a-z]*$')""")
def b4_url_matches_script_range(spark, sf):
    return extract_links(pages(spark, sf)).filter(
        url_matches(F.col("link"), LAST_SEGMENT)
    ).select("page_id", "link")


@query(f"WITH {LINKS_SQL} SELECT page_id, url, pos, link FROM links")
def c1_extract_links(spark, sf):
    return extract_links(pages(spark, sf))


@query(r"""
    SELECT page_id, url, rule,
           coalesce(rule = 'detail', false) AS parse, rule IS NOT NULL AS follow
    FROM (SELECT page_id, url, CASE
            WHEN regexp_matches(url, '/(?:fr|de|es)/[0-9]+$') THEN 'category'
            WHEN regexp_matches(url, '\.html$') THEN 'detail'
            WHEN regexp_matches(url, '\?page=[0-9]+&ref=x$') THEN 'next' END AS rule
          FROM pages)""")
def c2_route_links(spark, sf):
    return route_links(pages(spark, sf).select("page_id", "url"), URL_RULES, col="url")


@query(f"WITH {LINKS_SQL} SELECT page_id, link FROM uniq")
def d1_unique_links_per_page(spark, sf):
    return extract_links(pages(spark, sf), unique=True).select("page_id", "link")


@query(f"""WITH {LINKS_SQL}
    SELECT page_id, link, min(pos) AS pos FROM links GROUP BY ALL""")
def d1_unique_links_of_a_table(spark, sf):
    return unique_links(extract_links(pages(spark, sf))).select("page_id", "link", "pos")


_CANONICAL = r"""
    parts AS (
        SELECT page_id, regexp_replace(url, '#.*$', '') AS bare FROM pages
    ),
    canon AS (
        SELECT page_id, CASE WHEN NOT contains(bare, '?') THEN bare ELSE
            split_part(bare, '?', 1) || '?' || array_to_string(
                list_sort(string_split(split_part(bare, '?', 2), '&')), '&')
            END AS canonical
        FROM parts
    )"""


@query(f"WITH {_CANONICAL} SELECT page_id, sha1(canonical) AS fp FROM canon")
def d2_fingerprint(spark, sf):
    return pages(spark, sf).select("page_id", url_fingerprint(F.col("url")).alias("fp"))


@query(f"WITH {_CANONICAL} SELECT page_id, canonical FROM canon")
def d3_canonical_url(spark, sf):
    return pages(spark, sf).select(
        "page_id", canonical_url(F.col("url")).alias("canonical")
    )


@query(rf"""WITH {LINKS_SQL}
    SELECT link,
           regexp_extract(link, '^([a-z]+://[^/]*)', 1)
           || replace(replace(url_encode(regexp_extract(link, '^[a-z]+://[^/]*(.*)$', 1)),
                      '%2F', '/'), '%2C', ',') AS canonical
    FROM (SELECT DISTINCT link FROM links)""")
def d3_canonical_links(spark, sf):
    return extract_links(pages(spark, sf)).select("link").distinct().select(
        "link", canonical_url(F.col("link")).alias("canonical")
    )


@query(r"""
    SELECT rtrim(split_part(split_part(url, '#', 1), '?', 1), '/') AS canonical,
           count(*) AS n_pages
    FROM pages GROUP BY 1""")
def d3_canonical_url_merged(spark, sf):
    merged = canonical_url(F.col("url"), drop_query=True, drop_slash=True)
    return pages(spark, sf).groupBy(merged.alias("canonical")).agg(
        F.count("*").alias("n_pages")
    )


@query("""
    SELECT sha1(text) AS fp, min(doc_id) AS doc_id FROM documents GROUP BY 1""")
def d4_dedup_documents(spark, sf):
    texts = table(spark, sf, "documents").select(
        F.sha1(F.col("text").cast("binary")).alias("fp"), "doc_id"
    )
    return first_per_key(texts, ["fp"], ["doc_id"])


_FIRST_SQL = f"""WITH {LINKS_SQL}
    SELECT link, page_id, pos FROM links
    QUALIFY row_number() OVER (PARTITION BY link ORDER BY page_id, pos) = 1"""


@query(_FIRST_SQL)
def d4_dedup_requests(spark, sf):
    links = extract_links(pages(spark, sf)).select("page_id", "pos", "link")
    return dedup_requests(links, FIRST_SEEN).select("link", "page_id", "pos")


@query(_FIRST_SQL)
def d4_dedup_requests_late(spark, sf):
    links = extract_links(pages(spark, sf))
    return dedup_requests(links, FIRST_SEEN, late=True).select("link", "page_id", "pos")


def _seen(spark, sf):
    """Fingerprints of the links on pages outside the English section."""
    other = pages(spark, sf).filter(~F.contains("url", F.lit("/en/")))
    return with_fingerprint(extract_links(other, unique=True)).select("fp").distinct()


_NEW_SQL = f"""WITH {LINKS_SQL},
    seen AS (SELECT DISTINCT link FROM links WHERE NOT contains(url, '/en/')),
    fresh AS (
        SELECT link, page_id, pos FROM links
        WHERE link NOT IN (SELECT link FROM seen)
        QUALIFY row_number() OVER (PARTITION BY link ORDER BY page_id, pos) = 1
    )"""


@query(f"{_NEW_SQL} SELECT link, page_id FROM fresh")
def d6_new_links(spark, sf):
    links = extract_links(pages(spark, sf), unique=True)
    return new_links(links, _seen(spark, sf), FIRST_SEEN).select("link", "page_id")


@query(f"{_NEW_SQL} SELECT link, page_id FROM fresh")
def d6_new_links_late(spark, sf):
    links = extract_links(pages(spark, sf), unique=True)
    late = new_links(links, _seen(spark, sf), FIRST_SEEN, late=True)
    return late.select("link", "page_id")


_FORCED_SQL = f"""{_NEW_SQL},
    forced AS (SELECT link, page_id FROM uniq WHERE regexp_matches(link, '[.]$'))
    SELECT link, page_id FROM forced UNION ALL
    SELECT link, page_id FROM fresh WHERE NOT regexp_matches(link, '[.]$')"""


def _bypassed(spark, sf, late):
    links = extract_links(pages(spark, sf), unique=True).withColumn(
        "dont_filter", F.col("link").endswith(".")
    )
    fresh = new_links(links, _seen(spark, sf), FIRST_SEEN, force="dont_filter", late=late)
    return fresh.select("link", "page_id")


@query(_FORCED_SQL)
def d7_bypass_dedup(spark, sf):
    return _bypassed(spark, sf, late=False)


@query(_FORCED_SQL)
def d7_bypass_dedup_late(spark, sf):
    return _bypassed(spark, sf, late=True)


@query(f"""WITH {LINKS_SQL}
    SELECT url AS link, 1000 AS priority, false AS dont_filter, 0 AS retry_times,
           CAST(NULL AS VARCHAR) AS rule FROM pages
    UNION ALL
    SELECT link, 0, false, 0, rule
    FROM (SELECT link, {LINK_RULE_SQL} AS rule FROM uniq) WHERE rule IS NOT NULL
    UNION ALL
    SELECT url, 0, true, 0, NULL FROM pages WHERE contains(url, '#')""")
def d8_union_sources(spark, sf):
    seeds = pages(spark, sf).select(
        F.col("url").alias("link"), F.lit(1000).alias("priority")
    )
    followed = followed_links(pages(spark, sf), LINK_RULES).select("link", "rule")
    again = pages(spark, sf).filter(F.contains("url", F.lit("#"))).select(
        F.col("url").alias("link"), F.lit(True).alias("dont_filter")
    )
    return union_requests(seeds, followed, again).select(
        "link", "priority", "dont_filter", "retry_times", "rule"
    )


@query(r"""WITH RECURSIVE edges AS (
        SELECT DISTINCT
               regexp_extract(url, '^[a-z]+://[^/]*/([a-z]+)', 1) AS src,
               lower(unnest(regexp_extract_all(html, '<a href="/([^"]*)"', 1))) AS dst
        FROM pages
    ),
    reach AS (
        SELECT 'fr' AS node
        UNION
        SELECT dst FROM reach JOIN edges ON src = node
    )
    SELECT node FROM reach""")
def d11_reachable_pages(spark, sf):
    section = F.regexp_extract("url", r"^[a-z]+://[^/]*/([a-z]+)", 1)
    target = F.regexp_extract("link", r"^[a-z]+://[^/]*/(.*)$", 1)
    edges = extract_links(pages(spark, sf), unique=True).select(
        section.alias("src"), F.lower(target).alias("dst")
    )
    seeds = pages(spark, sf).select(section.alias("node")).filter(F.col("node") == "fr")
    return reachable(seeds, edges).select("node")


@query(f"""WITH {LINKS_SQL}
    SELECT link, priority, first_seen FROM (
        SELECT link, min(page_id) AS first_seen,
               -CAST(count(*) % 7 AS INTEGER) AS priority
        FROM links GROUP BY link)
    ORDER BY priority DESC, first_seen, link LIMIT 100""")
def g6_frontier_order(spark, sf):
    requests = (
        extract_links(pages(spark, sf))
        .groupBy("link")
        .agg(
            F.min("page_id").alias("first_seen"),
            (-(F.count("*") % 7)).cast("int").alias("priority"),
        )
        .select("link", "priority", "first_seen")
    )
    return frontier(requests, 100)


@query("""
    SELECT page_id, CAST(CAST('0x' || substr(sha1(CAST(page_id AS VARCHAR)), 1, 8)
        AS BIGINT) % 7 AS INTEGER) AS worker
    FROM pages""")
def g9_assign_worker(spark, sf):
    return assign_worker(pages(spark, sf).select("page_id"), ["page_id"], 7)


@query(r"""
    SELECT page_id, CAST(CAST('0x' || substr(sha1(CAST(page_id AS VARCHAR)), 1, 8)
        AS BIGINT) % 7 AS INTEGER) AS partition FROM pages""")
def g9_spread_to_workers(spark, sf):
    # The partition that a row is in, not the worker it was given.
    shared = spread(pages(spark, sf).select("page_id"), ["page_id"], 7)
    return shared.select("page_id", F.spark_partition_id().alias("partition"))


@query(f"""{_NEW_SQL}
    SELECT rule, count(*) AS n_links
    FROM (SELECT {LINK_RULE_SQL} AS rule FROM fresh)
    WHERE rule IS NOT NULL GROUP BY rule""")
def flow_unseen_by_rule(spark, sf):
    return unseen_by_rule(pages(spark, sf), _seen(spark, sf), LINK_RULES)


@query(f"""{_NEW_SQL},
    every AS (
        SELECT link, page_id AS first_seen, 0 AS priority FROM fresh
        WHERE {LINK_RULE_SQL} IS NOT NULL
        UNION ALL SELECT url, page_id, 5 FROM pages WHERE contains(url, '#')
    )
    SELECT link, first_seen, priority FROM every
    ORDER BY priority DESC, first_seen, link LIMIT 200""")
def flow_next_requests(spark, sf):
    followed = (
        followed_links(pages(spark, sf), LINK_RULES)
        .select("link", F.col("page_id").alias("first_seen"))
    )
    again = pages(spark, sf).filter(F.contains("url", F.lit("#"))).select(
        F.col("url").alias("link"),
        F.col("page_id").alias("first_seen"),
        F.lit(5).alias("priority"),
        F.lit(True).alias("dont_filter"),
    )
    return next_requests(_seen(spark, sf), followed, again, n=200).select(
        "link", "first_seen", "priority"
    )


@query(f"""WITH {LINKS_SQL}
    SELECT page_id, link, {LINK_RULE_SQL} AS rule FROM uniq
    WHERE {LINK_RULE_SQL} IS NOT NULL AND page_id % 7 <> 3""")
def flow_answered_links(spark, sf):
    # Every seventh page is stored as one that failed; its links do not count.
    path = scratch_dir(spark, "answers")
    status = F.when(F.col("page_id") % 7 == 3, 503).otherwise(200)
    pages(spark, sf).withColumn("status", status).write.parquet(path)
    return followed_links(read_pages(spark, path), LINK_RULES).select("page_id", "link", "rule")


@query(f"""WITH {LINKS_SQL}
    SELECT page_id, link FROM uniq
    WHERE {LINK_RULE_SQL} IS NOT NULL AND NOT regexp_matches(url, '[.]html$')""")
def u3_pages_not_followed(spark, sf):
    # Pages of the first rule are parsed only, so their links are no requests.
    rules = [LinkRule("detail", r"\.html$", parse=True, follow=False), *LINK_RULES]
    return followed_links(pages(spark, sf), rules).select("page_id", "link")


@query(f"""{_NEW_SQL},
    attempts AS (
        SELECT event_id AS attempt_id, 'https://example.org/user/' || user_id AS link,
               event_type = 'error' AS failed, user_id, ts
        FROM events
    ),
    numbered AS (
        SELECT *, sum(CAST(failed AS INTEGER)) OVER (
                   PARTITION BY user_id ORDER BY ts, attempt_id
                   ROWS UNBOUNDED PRECEDING) AS n
        FROM attempts
    ),
    records AS ({NAMES_SQL}),
    every AS (
        SELECT link, page_id AS first_seen, 0 AS priority, 'followed' AS why FROM fresh
        WHERE {LINK_RULE_SQL} IS NOT NULL
        UNION ALL
        SELECT link, attempt_id, CAST(-n AS INTEGER), 'retry' FROM numbered WHERE failed AND n <= 2
        UNION ALL
        SELECT url, page_id, 0, 'rejected' FROM records
        WHERE coalesce(name, '') = '' OR page_id % 5 = 2
    )
    SELECT link, first_seen, priority, why FROM every""")
def flow_requests_of_every_kind(spark, sf):
    """The next frontier: followed links, rejected records and failed attempts."""
    followed = followed_links(pages(spark, sf), LINK_RULES).select(
        "link", F.col("page_id").alias("first_seen"), F.lit("followed").alias("why")
    )
    named = extract_picks(pages(spark, sf), PAGE_PICKS, keep=("url", "page_id"))
    # Every fifth page is taken as one whose record lost its name.
    name = F.when(F.col("page_id") % 5 != 2, F.col("book_name"))
    named = named.withColumn("book_name", name)
    rejected = rejects_as_requests(split_valid(named)[1], url="url", first_seen="page_id")
    log = table(spark, sf, "events").select(
        F.col("event_id").alias("attempt_id"), "ts", F.col("user_id").alias("request"),
        (F.col("event_type") == "error").alias("failed"), F.lit(0).alias("priority"),
    )
    decisions = retry_priority(retry_decision(log)).withColumn(
        "link", F.concat(F.lit("https://example.org/user/"), F.col("request").cast("string"))
    )
    retries = retries_as_requests(decisions, url="link", first_seen="attempt_id")
    return next_requests(
        _seen(spark, sf), followed, rejected.withColumn("why", F.lit("rejected")),
        retries.withColumn("why", F.lit("retry")),
    ).select("link", "first_seen", F.col("priority").cast("int").alias("priority"), "why")


@query(r"""
    SELECT lower(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1)) AS host,
           count(*) AS n_pages
    FROM pages GROUP BY 1""")
def s7_host(spark, sf):
    return pages(spark, sf).groupBy(url_host(F.col("url")).alias("host")).agg(
        F.count("*").alias("n_pages")
    )


@query(r"""
    SELECT page_id, rule FROM (SELECT page_id, CASE
            WHEN regexp_matches(url, '^https:') THEN 'secure'
            WHEN regexp_matches(url, '/en/') THEN 'english' END AS rule
          FROM pages) WHERE rule IS NOT NULL""")
def u3_declared_rules(spark, sf):
    rules = [LinkRule("secure", "^https:"), LinkRule("english", "/en/", parse=True)]
    routed = route_links(pages(spark, sf).select("page_id", "url"), rules, col="url")
    return routed.filter(F.col("rule").isNotNull()).select("page_id", "rule")


@query(r"""
    SELECT page_id, len(parts) AS n_parts, parts[3] AS host, parts[-1] AS last,
           'p' || CAST(page_id AS VARCHAR) || ':' || substr(url, 1, 5) AS label,
           substr(parts[1], 1, len(parts[1]) - 1) AS scheme
    FROM (SELECT page_id, url, string_split(url, '/') AS parts FROM pages)""")
def s4_to_s10_scalars(spark, sf):
    parts = F.split("url", "/")
    scheme = F.element_at(parts, 1)
    return pages(spark, sf).select(
        "page_id",
        F.size(parts).cast("bigint").alias("n_parts"),
        F.get(parts, F.lit(2)).alias("host"),
        F.element_at(parts, -1).alias("last"),
        F.concat(
            F.lit("p"), F.col("page_id").cast("string"), F.lit(":"), F.substring("url", 1, 5)
        ).alias("label"),
        F.substring(scheme, F.lit(1), F.length(scheme) - 1).alias("scheme"),
    )


@query(f"{_NEW_SQL} SELECT link FROM fresh")
def d6_new_links_bucketed(spark, sf):
    name = f"seen_{uuid.uuid4().hex}"
    seen = seen_table(spark, name, scratch_dir(spark, "seen"), 8)
    add_seen(_seen(spark, sf), name)
    links = extract_links(pages(spark, sf), unique=True)
    found = written(new_links(links, seen, FIRST_SEEN).select("link"), scratch_dir(spark, "new"))
    spark.sql(f"DROP TABLE {name}")
    return found


@query(f"""WITH {LINKS_SQL} SELECT sha1(link) AS fp, 1 AS n FROM links GROUP BY link""")
def d6_seen_set_compacted(spark, sf):
    # Three rounds of inserts, each made twice, as by a job that is run again.
    name, path = f"seen_{uuid.uuid4().hex}", scratch_dir(spark, "seen")
    seen_table(spark, name, path, 8)
    links = written(
        extract_links(pages(spark, sf), unique=True)
        .select(F.sha1(F.col("link").cast("binary")).alias("fp"), "page_id"),
        scratch_dir(spark, "links"),
    )
    for part in range(3):
        some = links.filter(F.col("page_id") % 3 == part)
        add_seen(some, name)
        add_seen(some, name)
        seen = compact_seen(spark, name, path)
    found = written(seen.groupBy("fp").agg(F.count("*").cast("int").alias("n")), scratch_dir(spark, "set"))
    spark.sql(f"DROP TABLE {name}")
    return found
