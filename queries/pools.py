"""Endpoint pools: loading, tallies, eviction, size."""

from pyspark.sql import functions as F

from pagelake.functions.urls import endpoint_url
from pagelake.operators.pool import (
    attach_pool,
    endpoint_failures,
    endpoints_to_evict,
    evict,
    evict_immediate,
    evicted_at,
    pool_limit,
    pool_status,
)
from pagelake.plans.crawl import surviving_pool
from pagelake.session import scratch_dir, written
from pagelake.sources.tables import load_endpoints
from queries import query
from queries.inputs import ATTEMPTS_SQL, attempts, table

_FAILURES = f"""WITH {ATTEMPTS_SQL},
    failures AS (
        SELECT generation, endpoint, count(*) FILTER (failed) AS failures
        FROM attempts WHERE endpoint IS NOT NULL GROUP BY ALL
    )"""


def _payloads(spark, sf):
    """Per supplier one pool answer with an entry of its own, one that all
    suppliers of the nation share, and one that is not usable."""
    def entry(second, third, port):
        ip = F.format_string("10.%s.%s", second, third)
        return F.array(ip, port.cast("string"))

    key, nation = F.col("s_suppkey"), F.col("s_nationkey")
    return table(spark, sf, "supplier").select(
        key.alias("generation"),
        F.to_json(F.array(
            entry(nation, key, key % 100 + F.lit(8000)),
            entry(nation, F.lit("0"), F.lit(3128)),
            F.array(F.lit("no port")),
        )).alias("payload"),
    )


_POOL_SQL = """
    pool AS (
        SELECT s_suppkey AS generation, '10.' || s_nationkey || '.' || s_suppkey AS ip,
               CAST(8000 + s_suppkey % 100 AS INTEGER) AS port FROM supplier
        UNION ALL
        SELECT s_suppkey, '10.' || s_nationkey || '.0', 3128 FROM supplier
    )"""


@query(f"""WITH {_POOL_SQL}
    SELECT generation, ip, port, ip || ':' || port AS endpoint, 0 AS failures FROM pool""")
def a6_load_endpoints(spark, sf):
    return load_endpoints(_payloads(spark, sf))


@query(f"""WITH {_POOL_SQL}
    SELECT 'http://' || ip || ':' || port AS proxy, count(*) AS n FROM pool GROUP BY 1""")
def c17_join_endpoint(spark, sf):
    proxy = endpoint_url(F.col("ip"), F.col("port"))
    return load_endpoints(_payloads(spark, sf)).groupBy(proxy.alias("proxy")).agg(
        F.count("*").alias("n")
    )


@query(f"{_FAILURES} SELECT generation, endpoint, failures FROM failures")
def f1_endpoint_failures(spark, sf):
    return endpoint_failures(attempts(spark, sf))


@query(f"{_FAILURES} SELECT generation, endpoint FROM failures WHERE failures >= 8")
def f2_endpoints_to_evict(spark, sf):
    return endpoints_to_evict(endpoint_failures(attempts(spark, sf))).select(
        "generation", "endpoint"
    )


@query(f"""WITH {ATTEMPTS_SQL}
    SELECT DISTINCT generation, endpoint FROM attempts
    WHERE status <> 200 AND endpoint IS NOT NULL""")
def f3_evict_on_status(spark, sf):
    return evict_immediate(attempts(spark, sf))


@query(f"""{_FAILURES}
    SELECT generation, count(*) AS pool_size, count(*) < 30 AS needs_refill,
           count(*) < 20 AS pause_request, count(*) < 30 AS pause_failure
    FROM failures WHERE failures < 8 GROUP BY generation""")
def f5_pool_status(spark, sf):
    log = attempts(spark, sf)
    pool = log.filter(F.col("endpoint").isNotNull()).select("generation", "endpoint")
    return pool_status(surviving_pool(log, pool.distinct()))


@query(f"""WITH {ATTEMPTS_SQL}
    SELECT generation, endpoint, attempt_id FROM attempts
    WHERE failed AND endpoint IS NOT NULL
    QUALIFY row_number() OVER (
        PARTITION BY generation, endpoint ORDER BY ts, attempt_id) = 8""")
def g4_evicted_at(spark, sf):
    return evicted_at(attempts(spark, sf)).select("generation", "endpoint", "attempt_id")


@query(f"""{_FAILURES}
    SELECT generation, endpoint FROM failures WHERE failures < 7""")
def d9_evict_endpoints(spark, sf):
    log = attempts(spark, sf)
    pool = log.filter(F.col("endpoint").isNotNull()).select("generation", "endpoint")
    bad = endpoints_to_evict(endpoint_failures(log), 7)
    return evict(pool.distinct(), bad, key=["generation", "endpoint"])


@query(f"""{_FAILURES}
    SELECT attempt_id, a.generation, a.endpoint, failures
    FROM attempts a JOIN failures f
      ON a.generation = f.generation AND a.endpoint = f.endpoint""")
def d10_lookup_endpoint(spark, sf):
    log = attempts(spark, sf)
    # A pool is a stored table: its size then decides how Spark joins it.
    pool = written(endpoint_failures(log), scratch_dir(spark, "pool"))
    return attach_pool(log, pool, key=["generation", "endpoint"]).select(
        "attempt_id", "generation", "endpoint", "failures"
    )


@query(f"""{_FAILURES}
    SELECT generation, endpoint FROM failures
    ORDER BY failures, endpoint, generation LIMIT 40""")
def g8_pool_limit(spark, sf):
    pool = endpoint_failures(attempts(spark, sf))
    return pool_limit(pool, 40, order=["failures", "endpoint", "generation"]).select(
        "generation", "endpoint"
    )
