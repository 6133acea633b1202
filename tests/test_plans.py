"""The plans are the ones wanted, not just their results."""

import pytest
from pyspark.sql import functions as F

from pagelake.functions.urls import in_domains
from pagelake.operators.links import (
    LinkRule,
    dedup_requests,
    extract_links,
    new_links,
    route_links,
    with_fingerprint,
)
from pagelake.operators.pool import attach_pool, endpoint_failures, evicted_at
from pagelake.plans.crawl import FIRST_SEEN, followed_links, next_requests, page_records
from pagelake.session import scratch_dir
from pagelake.sources.seen import add_seen, compact_seen, seen_table
from pagelake.sources.tables import read_pages, store_pages
from queries.inputs import LINK_RULES, attempts

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def pages(spark):
    return read_pages(spark, f"{SF}/pages.parquet")


def test_url_only_work_does_not_read_the_pages_text(pages):
    p = plan(route_links(pages.select("page_id", "url"), LINK_RULES, col="url"))
    assert "html" not in p.split("ReadSchema")[1]


def test_links_of_pages_need_no_shuffle(pages):
    p = plan(followed_links(pages, LINK_RULES))
    assert "Exchange" not in p
    assert p.count("regexp_extract_all(html") == 1


def test_url_rule_is_tested_before_the_page_reader(pages):
    p = plan(page_records(pages, [LinkRule("d", r"\.html$", parse=True)]))
    assert p.count("ArrowEvalPython") == 1
    assert p.index("ArrowEvalPython") < p.index("RLIKE(url")
    # Only the page's text crosses to Python.
    node = next(line for line in p.splitlines() if "ArrowEvalPython" in line)
    assert node.count("html#") == 1 and "url#" not in node.split("[")[1]


def test_new_links_merge_copies_before_the_shuffle(spark, pages):
    links = extract_links(pages, unique=True)
    seen = with_fingerprint(links).select("fp").distinct()
    p = plan(new_links(links, seen, FIRST_SEEN))
    # Both sides aggregate on fp before and after one exchange each; the join
    # takes that partitioning as it is.
    assert p.count("Exchange hashpartitioning") == 2
    assert "partial_min_by" in p


def test_small_pool_is_broadcast_without_a_hint(spark, tmp_path):
    log = attempts(spark, SF)
    endpoint_failures(log).write.parquet(str(tmp_path / "pool"))
    pool = spark.read.parquet(str(tmp_path / "pool"))
    joined = attach_pool(log, pool, key=["generation", "endpoint"])
    assert "BroadcastHashJoin" in plan(joined)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        assert "SortMergeJoin" in plan(attach_pool(log, pool, ["generation", "endpoint"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rank_limit_is_applied_before_the_shuffle(spark):
    p = plan(evicted_at(attempts(spark, SF)))
    assert "WindowGroupLimit" in p.split("Exchange")[1]


def test_tallies_combine_before_the_shuffle(spark):
    p = plan(endpoint_failures(attempts(spark, SF)))
    assert "partial_count" in p.split("Exchange")[1]


def test_filters_reach_the_scan(spark):
    df = attempts(spark, SF).filter(F.col("failed"))
    assert "EqualTo(event_type,error)" in plan(df)


@pytest.mark.parametrize("buckets", [8, 16])
def test_the_stored_seen_set_is_not_shuffled(spark, pages, tmp_path, buckets):
    name = f"seen_{buckets}"
    seen = seen_table(spark, name, str(tmp_path / name), buckets)
    links = extract_links(pages, unique=True)
    first = new_links(links, seen, FIRST_SEEN)
    n = first.count()
    assert n > 0
    add_seen(first, name)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        again = new_links(links, spark.table(name), FIRST_SEEN)
        p = plan(again)
        # The set is scanned last, and no exchange comes after the pages' own.
        assert p.rindex("html#") < p.rindex("Bucketed: true")
        assert p.rindex("Exchange") < p.rindex("html#")
        assert again.count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert spark.table(name).count() == n
    spark.sql(f"DROP TABLE {name}")


def test_a_compacted_set_is_neither_shuffled_nor_sorted(spark, pages, tmp_path):
    name, path = "seen_rounds", str(tmp_path / "rounds")
    seen_table(spark, name, path, 8)
    links = extract_links(pages, unique=True)
    fps = with_fingerprint(links).select("fp", "page_id")
    for part in range(3):
        for _ in range(2):  # the same insert again adds nothing
            add_seen(fps.filter(F.col("page_id") % 3 == part), name)
        seen = compact_seen(spark, name, path)
        n = fps.filter(F.col("page_id") % 3 <= part).select("fp").distinct().count()
        assert seen.count() == n == seen.distinct().count()
    files = list((tmp_path / "rounds" / "generation=3").glob("*.parquet"))
    assert len(files) <= 8
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(new_links(links, spark.table(name), FIRST_SEEN))
        assert p.rindex("Sort ") < p.rindex("html#") and p.rindex("Exchange") < p.rindex("html#")
        assert p.rindex("html#") < p.rindex("Bucketed: true")
        assert new_links(links, spark.table(name), FIRST_SEEN).count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # A generation that was never finished does not count.
    (tmp_path / "rounds" / "generation=4").mkdir()
    assert seen_table(spark, name, path, 8).count() == n
    spark.sql(f"DROP TABLE {name}")


def test_late_rows_are_aggregated_by_hash(spark, pages):
    links = extract_links(pages, unique=True)
    seen = with_fingerprint(links.filter("page_id % 2 = 0")).select("fp").distinct()
    for late in (
        dedup_requests(links, FIRST_SEEN, late=True),
        new_links(links, seen, FIRST_SEEN, late=True),
    ):
        p = plan(late)
        assert "SortAggregate" not in p and "partial_min" in p
        assert "regexp_extract_all(html" not in p.split("LeftAnti")[0]
    want = new_links(links, seen, FIRST_SEEN)
    assert sorted(late.select(want.columns).collect()) == sorted(want.collect())


def test_forced_requests_take_the_same_pass(spark, pages):
    links = extract_links(pages, unique=True).withColumn("force", F.col("link").endswith("."))
    seen = spark.createDataFrame([("x",)], "fp string")
    p = plan(new_links(links, seen, FIRST_SEEN, force="force"))
    assert p.count("regexp_extract_all(html") == 1 and p.count("LeftAnti") == 1


def test_sources_without_the_flag_are_not_read_twice(spark, pages):
    followed = followed_links(pages, LINK_RULES).withColumn("first_seen", F.col("page_id"))
    seen = spark.createDataFrame([("x",)], "fp string")
    retries = pages.select(
        F.col("url").alias("link"), F.col("page_id").alias("first_seen"),
        F.lit(True).alias("dont_filter"),
    )
    p = plan(next_requests(seen, followed, retries))
    assert p.count("regexp_extract_all(html") == 1
    assert p.count("FileScan parquet") == 2


def test_a_hot_pool_key_is_split_at_run_time(spark, tmp_path):
    # Two stored tables and a join too big to broadcast: the hot endpoint's
    # attempts are read by several tasks.
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    hot = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 5000)
    spark.range(60_000).repartition(8).select(
        hot.alias("endpoint"), F.sha1(F.col("id").cast("string").cast("binary")).alias("note")
    ).write.parquet(str(tmp_path / "log"))
    spark.range(5000).select(F.col("id").alias("endpoint"), F.lit(1).alias("n")).write.parquet(
        str(tmp_path / "pool")
    )
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        joined = attach_pool(
            spark.read.parquet(str(tmp_path / "log")), spark.read.parquet(str(tmp_path / "pool"))
        )
        assert len(joined.collect()) == 60_000
        assert "SortMergeJoin(skew=true)" in plan(joined)
    finally:
        for k in keys:
            spark.conf.unset(k)


def test_scratch_goes_where_the_session_says(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    a, b = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert a.startswith(root + "/x-") and a != b


def test_domains_prune_stored_pages(spark, pages, tmp_path):
    path = str(tmp_path / "pages")
    store_pages(pages, path)
    some = read_pages(spark, path, ["url"], domains=["example.net"])
    assert "StringStartsWith(host_key,net.example.)" in plan(some)
    assert "html" not in plan(some).split("ReadSchema")[1]
    want = pages.filter(in_domains(F.col("url"), ["example.net"])).select("url")
    assert sorted(some.collect()) == sorted(want.collect())
